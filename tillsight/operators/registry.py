"""Model registry: fitted models as documents, versions that follow the champion.

A model is saved as JSON text (trees, coefficients, scaling) in a table row, with the forests of a calibrated model in
folders beside it, and loaded again with the same scores. A version is raised only when the champion changes; one record
is active, the newest champion's.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillsight.operators import boosting
from tillsight.operators import models as M
from tillsight.operators.logistic import Coefficients


def to_document(fitted, folder: str) -> str:
    """The model as text; ``folder`` takes what is no text (forests)."""
    if isinstance(fitted, M.FittedBoosted):
        t = fitted.trees
        return json.dumps({"kind": "boosted", "segments": fitted.segments, "names": t.names, "params": dataclasses.asdict(t.params),
                           "nodes": [dataclasses.astuple(n) for n in t.nodes]})
    if isinstance(fitted, M.FittedLogistic):
        m = fitted.model
        return json.dumps({"kind": "logistic", "segments": m.segments, "group": m.group, "schema": m.moments.schema.json(), "moments": [list(r) for r in m.moments.collect()],
                           "terms": m.coefficients.terms, "steps": m.coefficients.steps, "values": [[g, list(map(float, b))] for g, b in m.coefficients.values.items()]})
    if isinstance(fitted, M.CalibratedFitted):
        parts = []
        for k, (pipeline, slope, intercept) in enumerate(fitted.parts):
            pipeline.write().overwrite().save(f"{folder}/part-{k}")
            parts.append([f"{folder}/part-{k}", slope, intercept])
        return json.dumps({"kind": "calibrated", "parts": parts})
    raise TypeError(f"no document for {type(fitted).__name__}")


def from_document(spark: SparkSession, text: str):
    d = json.loads(text)
    if d["kind"] == "boosted":
        return M.FittedBoosted(boosting.Trees(d["names"], boosting.Params(**d["params"]), [boosting.Node(*n) for n in d["nodes"]]), d["segments"])
    if d["kind"] == "logistic":
        moments = spark.createDataFrame([tuple(r) for r in d["moments"]], StructType.fromJson(json.loads(d["schema"])))
        return M.FittedLogistic(M.GroupedLogistic(d["group"], d["segments"], moments, Coefficients(d["group"], d["terms"], {g: b for g, b in d["values"]}, d["steps"])))
    return M.CalibratedFitted([(PipelineModel.load(p), a, b) for p, a, b in d["parts"]])


RECORD = "registered_for string, model_name string, model_version int, roc_auc double, is_active boolean, document string"


def registered(spark: SparkSession, records: DataFrame | None, registered_for: str, model_name: str, roc_auc: float, document: str) -> DataFrame:
    """The registry (one row a version) after a selection: a new active version where the champion changed, else the active
    record with its new figures and document."""
    new = spark.createDataFrame([(registered_for, model_name, 1, roc_auc, True, document)], RECORD)
    if records is None:
        return new
    active = records.where("is_active").select("model_name", "model_version").first()  # one row
    if active is None:
        return new
    if active["model_name"] == model_name:
        return records.where("NOT is_active").unionByName(new.withColumn("model_version", F.lit(active["model_version"])))
    old = records.withColumn("is_active", F.lit(False))
    return old.unionByName(new.withColumn("model_version", F.lit(active["model_version"] + 1)))


def active_model(spark: SparkSession, records: DataFrame):
    return from_document(spark, records.where("is_active").select("document").first()[0])


def versions(champions: DataFrame) -> DataFrame:
    """The version history of champions by selection date (``selected_on, model_name``, one row a date): ``model_version``
    rises when the champion differs from the one before; ``is_active`` marks the last selection. One row a date, few dates."""
    order = Window.orderBy("selected_on")
    changed = F.coalesce((F.lag("model_name").over(order) != F.col("model_name")).cast("int"), F.lit(1))
    numbered = champions.withColumn("_new", changed)
    return numbered.withColumn("model_version", F.sum("_new").over(order).cast("int")).withColumn(
        "is_active", F.lead("selected_on").over(order).isNull()).drop("_new")
