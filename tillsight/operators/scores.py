"""Score staging, the score fact and unknown-customer rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.functions.columns import trim_unicode
from tillsight.operators.warehouse import EtlError, newest_per_key, upsert
from tillsight.sources.sales import require_columns

SCORE_KEYS = ["snapshot_date", "customer_key", "model_name", "model_version"]


def stage_scores(raw: DataFrame, snapshot_date, model_name: str = K.ACTIVE_MODEL_NAME,
                 model_version: str = K.ACTIVE_MODEL_VERSION, batch_id: str | None = None) -> DataFrame:
    """Normalise a score file: trimmed name, double probability, constant snapshot/model.

    A missing ``risk_score`` column is filled with prob x 10.
    """
    require_columns(raw, ["customer_name", "churn_prob"], "score input")
    prob = F.col("churn_prob").cast("double")
    rs = F.col("risk_score").cast("double") if "risk_score" in raw.columns else prob * 10
    return raw.select(
        F.lit(batch_id).cast("string").alias("load_batch_id"),
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        trim_unicode(F.col("customer_name").cast("string")).alias("customer_name"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        prob.alias("churn_prob"),
        rs.alias("risk_score"),
    )


def resolve_customers(staged: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Score rows with a known customer, keyed by customer_key (inner join)."""
    return staged.join(dim_customer.select("customer_key", "customer_name"), "customer_name")


def unknown_customers(staged: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Score rows whose customer is not in the dimension (reject table)."""
    return staged.join(dim_customer.select("customer_name"), "customer_name", "left_anti")


def require_known(staged: DataFrame, dim_customer: DataFrame) -> None:
    """Raise error 50003 when any score names an unknown customer."""
    if unknown_customers(staged, dim_customer).limit(1).count():
        raise EtlError(50003, "Customer name not found in the customer dimension.")


def merge_scores(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Upsert on (snapshot, customer_key, model, version); the source wins, of several source rows the largest score."""
    src = newest_per_key(source.select(*SCORE_KEYS, "churn_prob", "risk_score", "load_batch_id"), SCORE_KEYS,
                         ["churn_prob", "risk_score"])
    if target is None:
        return src
    return upsert(target.select(*src.columns), src, SCORE_KEYS)
