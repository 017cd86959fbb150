"""End-to-end warehouse pipeline on Parquet tables under one base folder.

    base/staging            sales lines, partitioned by load_batch_id (append)
    base/dim_date           one row per day
    base/dim_customer       customers with kept surrogate keys
    base/dim_product        products with kept surrogate keys
    base/fact_sales         partitioned by sale_month (yyyyMM)
    base/customer_snapshot  partitioned by snapshot_date
    base/churn_score        partitioned by snapshot_date, model_name, model_version
    base/score_rejects      scores naming unknown customers
    base/reports/<name>     report tables; selection summary as JSON

Every rewrite goes through ``replace``: the new content is written once,
to a folder beside the tables, which then takes the target's place by
rename, so a job never overwrites a path it is reading and a lost executor
only repeats tasks. Partitioned tables replace only the partitions present
in the new content: an upsert of one batch rewrites the months that batch
touches, not the whole fact.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight import constants as K
from tillsight.operators import cleaning as CL
from tillsight.operators import features as FE
from tillsight.operators import reports as RP
from tillsight.operators import warehouse as WH
from tillsight.operators.rules import Thresholds, apply_rules
from tillsight.operators.scores import (SCORE_KEYS, resolve_customers, stage_scores,
                                        unknown_customers)
from tillsight.session import CODEC, materialize, shuffles_dropped
from tillsight.sources.sales import SALES_SCHEMA, require_columns, with_lineage


def _path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the table is there; anything but a missing path (an unreadable table, say) raises."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    p = _path(base, name)
    return spark.read.parquet(p) if exists(spark, p) else None


def replace(df: DataFrame, base: str, name: str, partition_by: Sequence[str] = (),
            sort_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as the new content of table ``name`` (only its partitions, if partitioned); returns that content."""
    spark, aside, target = df.sparkSession, _path(base, f"_new/{name}-{uuid.uuid4().hex}"), _path(base, name)
    # one sort: the writer asks for rows in order of the partition columns
    w = (df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df).write.option("compression", CODEC)
    with shuffles_dropped(spark):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(aside)
    folders = _partitions(spark, aside, len(partition_by))
    for f in folders:
        _move(spark, f"{aside}{f}", f"{target}{f}")
    if partition_by:
        _delete(spark, aside)
    if not folders:
        return spark.createDataFrame([], df.schema)
    parts = [c for c in df.schema.fields if c.name in partition_by]
    schema = T.StructType([c for c in df.schema.fields if c not in parts] + parts)
    return spark.read.schema(schema).option("basePath", target).parquet(*[f"{target}{f}" for f in folders]).select(*df.columns)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _partitions(spark: SparkSession, path: str, levels: int) -> list[str]:
    """The partition folders of a written table, from ``path`` on; without levels the table itself."""
    found = [""]
    for _ in range(levels):
        found = [f"{f}/{s.getPath().getName()}" for f in found for fs, p in [_fs(spark, f"{path}{f}")] for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()]
    return sorted(found)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one."""
    (fs, a), (_, b) = _fs(spark, source), _fs(spark, target)
    fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be renamed to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def partition_folder(spark: SparkSession, **values) -> str:
    """The folder of a partition as Spark names it: values escaped, so none can name another folder."""
    esc = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None or v == '' else esc(str(v))}" for k, v in values.items())


def drop_partition(spark: SparkSession, base: str, name: str, **values) -> None:
    """Delete one partition folder: dynamic overwrite leaves a partition that the new content no longer has."""
    _delete(spark, f"{_path(base, name)}/{partition_folder(spark, **values)}")


# ------------------------------------------------------------------- staging

def stage_batch(raw: DataFrame, base: str, batch_id: str, source_file: str | None = None,
                category_map: Mapping[str, str] = K.CATEGORY_MAP) -> None:
    """Clean one source batch and put it into staging with lineage columns; incomplete rows go to ``sale_rejects``."""
    require_columns(raw, [f.name for f in SALES_SCHEMA.fields if f.name != "load_batch_id"], "sales batch")
    write_staged(CL.clean_sales(raw.drop("load_batch_id"), category_map), base, batch_id, source_file)


def staged_parts(clean: DataFrame, batch_id: str, source_file: str | None = None) -> dict[str, DataFrame]:
    """``staging`` and ``sale_rejects`` rows of a cleaned batch, with lineage: rows without a key field are kept apart, not lost."""
    staged = with_lineage(clean, batch_id, source_file)
    staged = staged.withColumn("row_hash", CL.row_hash([f.name for f in SALES_SCHEMA.fields
                                                        if f.name != "load_batch_id"]))
    return {"staging": CL.drop_incomplete(staged), "sale_rejects": CL.incomplete(staged)}


def write_staged(clean: DataFrame, base: str, batch_id: str, source_file: str | None = None) -> None:
    """Put a cleaned batch into its partitions of staging and rejects; staging a batch again replaces it."""
    for name, part in staged_parts(clean, batch_id, source_file).items():
        drop_partition(clean.sparkSession, base, name, load_batch_id=batch_id)
        # sorted within each file by date, then customer: Parquet min/max statistics let
        # date-window scans skip row groups (no shuffle: a per-task sort)
        (part.sortWithinPartitions("sale_date", "customer_name")
         .write.mode("append").option("compression", CODEC).partitionBy("load_batch_id").parquet(_path(base, name)))


# ----------------------------------------------------------------------- ETL

# The newest of several staged rows with one source id: by load time, then a total tie-break.
NEWEST = ("loaded_at", "load_batch_id", "row_hash")


def newest_staged(staging: DataFrame) -> DataFrame:
    """The newest row of every source id, with the columns that the fact is made of."""
    used = [c for c in staging.columns if c in {"source_row_id", "customer_name", "product_code", "sale_date", "segment_name", *WH.FACT_MEASURES, *NEWEST}]
    return WH.newest_of_stored(staging.select(*used), ["source_row_id"], NEWEST)


# Fact files are sorted by customer and date inside each month partition.
FACT_SORT = ("customer_key", "date_key")

def run_etl(spark: SparkSession, base: str, batch_id: str | None = None,
            date_scope: str = "segment") -> None:
    """Date dimension, dimensions and fact for one staged batch (or all when None)."""
    staging = spark.read.parquet(_path(base, "staging"))
    first, last = WH.batch_date_range(staging, batch_id)          # 50002 on an empty batch
    dd = WH.dim_date(spark, first, last)                            # 50001 on a bad range
    old_dd = read(spark, base, "dim_date")
    replace(WH.merge_dim_date(old_dd, dd), base, "dim_date")

    dc = WH.merge_dim_customer(read(spark, base, "dim_customer"),
                               WH.customer_candidates(staging, batch_id, date_scope))
    dc = replace(dc, base, "dim_customer")
    dp = WH.merge_dim_product(read(spark, base, "dim_product"), WH.product_candidates(staging, batch_id))
    dp = replace(dp, base, "dim_product")

    rows = newest_staged(WH.only_batch(staging, batch_id))
    new = (WH.fact_rows(rows, dc, dp)
           .withColumn("sale_month", (F.col("date_key") / 100).cast("int")))
    old = read(spark, base, "fact_sales")
    if old is None:
        replace(new, base, "fact_sales", ["sale_month"], FACT_SORT)
        return
    new = materialize(new, "fact_new")
    # months touched by the batch: bounded by the calendar
    months = {r[0] for r in new.select("sale_month").distinct().collect()}
    # a re-loaded row may move to another month: drop it wherever it was. This
    # semi join reads only the two key columns and the partition column of the
    # fact (column pruning), not the rows themselves.
    moved = old.join(new.select("source_system", "source_row_id"), ["source_system", "source_row_id"],
                     "left_semi").select("sale_month").distinct().collect()
    months |= {r[0] for r in moved}
    touched = old.filter(F.col("sale_month").isin(*months))         # partition pruning
    merged = replace(WH.upsert(touched.select(*new.columns), new, ["source_system", "source_row_id"]),
                     base, "fact_sales", ["sale_month"], FACT_SORT)
    for month in months - {r[0] for r in merged.select("sale_month").distinct().collect()}:
        drop_partition(spark, base, "fact_sales", sale_month=month)


def _key(d) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def sales_from_warehouse(spark: SparkSession, base: str, first=None, last=None) -> DataFrame:
    """Fact rows with customer name and sale date: the input of the feature pipeline.

    With ``first``/``last`` only the month partitions in range are listed
    and the date-key range is pushed into the Parquet scan.
    """
    fact = spark.read.parquet(_path(base, "fact_sales"))
    if first is not None and last is not None:
        fact = fact.filter(F.col("sale_month").between(_key(first) // 100, _key(last) // 100)
                           & F.col("date_key").between(_key(first), _key(last)))
    dc = spark.read.parquet(_path(base, "dim_customer")).select("customer_key", "customer_name")
    dd = spark.read.parquet(_path(base, "dim_date")).select("date_key", F.col("full_date").alias("sale_date"))
    return (fact.join(dd, "date_key").join(dc, "customer_key")
            .select("customer_name", "sale_date", "revenue", "profit", "promo_pct",
                    F.col("segment_at_sale").alias("segment_name"), "source_row_id"))


def build_snapshots(spark: SparkSession, base: str, snapshots: Sequence, lookback: int = K.LOOKBACK_DAYS,
                    label_windows=None) -> DataFrame:
    """Features + labels for the snapshot dates; each snapshot partition is replaced whole."""
    snaps = sorted(FE._as_date(x) for x in snapshots)
    first = snaps[0] - dt.timedelta(days=lookback - 1)
    last = max(b for _, _, b in FE._label_windows(snaps, label_windows))
    s = sales_from_warehouse(spark, base, first, last)
    f = FE.with_churn_label(FE.customer_features(s, snaps, lookback), s, snaps, label_windows)
    f = f.withColumn("lookback_days", F.lit(lookback))
    out = replace(f, base, "customer_snapshot", ["snapshot_date"])
    for gone in set(snaps) - {r[0] for r in out.select("snapshot_date").distinct().collect()}:
        drop_partition(spark, base, "customer_snapshot", snapshot_date=gone)
    return out


def model_input(spark: SparkSession, base: str) -> DataFrame:
    """The model-input view: snapshot rows of known customers."""
    cs = spark.read.parquet(_path(base, "customer_snapshot"))
    dc = spark.read.parquet(_path(base, "dim_customer")).select("customer_name")
    return cs.join(dc, "customer_name")


# --------------------------------------------------------------------- scores

def load_scores(spark: SparkSession, base: str, scores: DataFrame, snapshot_date,
                model_name: str = K.ACTIVE_MODEL_NAME, model_version: str = K.ACTIVE_MODEL_VERSION,
                batch_id: str | None = None, thresholds: Thresholds | None = None,
                vip_segment: str = K.VIP_SEGMENT) -> DataFrame:
    """Stage a score file, reject unknown customers, upsert, apply the business rules."""
    staged = stage_scores(scores, snapshot_date, model_name, model_version, batch_id)
    dc = spark.read.parquet(_path(base, "dim_customer"))
    rejects = unknown_customers(staged, dc)
    key = {"snapshot_date": snapshot_date, "model_name": model_name, "model_version": model_version}
    drop_partition(spark, base, "score_rejects", **key, load_batch_id=batch_id)
    rejects.write.mode("append").partitionBy(*key, "load_batch_id").parquet(_path(base, "score_rejects"))
    # one row per key: of several scores for a customer the largest, so a customer at risk is not missed
    src = WH.newest_per_key(resolve_customers(staged, dc), SCORE_KEYS, ["churn_prob", "risk_score"])
    old = read(spark, base, "churn_score")
    part = (F.col("snapshot_date") == F.lit(snapshot_date)) & (F.col("model_name") == model_name) \
        & (F.col("model_version") == model_version)
    cols = SCORE_KEYS + ["customer_name", "churn_prob", "risk_score", "load_batch_id"]
    src = src.select(*cols)
    merged = src if old is None else WH.upsert(old.filter(part).select(*cols), src, SCORE_KEYS)
    snap = spark.read.parquet(_path(base, "customer_snapshot")).filter(
        F.col("snapshot_date") == F.lit(snapshot_date))
    ruled = apply_rules(merged, snap, thresholds or Thresholds(), vip_segment, clip_score=False)
    ruled = ruled.select(*cols, "segment", "recency", "risk_level", "sales_action")
    return replace(ruled, base, "churn_score", ["snapshot_date", "model_name", "model_version"])


# -------------------------------------------------------------------- reports

def write_reports(spark: SparkSession, base: str, snapshot_date,
                  model_name: str = K.ACTIVE_MODEL_NAME, model_version: str = K.ACTIVE_MODEL_VERSION,
                  top_n: int = 20) -> dict[str, str]:
    """Churn list, churn by segment, RFM summary, monthly sales, top customers, reconciliation."""
    cs = spark.read.parquet(_path(base, "customer_snapshot")).filter(
        F.col("snapshot_date") == F.lit(snapshot_date))
    sc = spark.read.parquet(_path(base, "churn_score")).filter(
        (F.col("snapshot_date") == F.lit(snapshot_date)) & (F.col("model_name") == model_name)
        & (F.col("model_version") == model_version))
    scored = sc.drop("segment", "recency").join(
        cs.select("customer_name", "segment", "recency", "frequency", "aov", "margin", "trend",
                  "active_months"), "customer_name", "left")
    fact = spark.read.parquet(_path(base, "fact_sales"))
    dd = spark.read.parquet(_path(base, "dim_date"))
    dc = spark.read.parquet(_path(base, "dim_customer"))
    staging = spark.read.parquet(_path(base, "staging"))
    out = {
        "churn_list": RP.churn_list(scored),
        "churn_by_segment": RP.churn_by_segment(scored),
        "rfm_summary": RP.rfm_summary(cs),
        "monthly_sales": RP.monthly_sales(fact, dd),
        "top_customers": RP.top_customers(fact, dc, top_n),
        "reconciliation": RP.reconciliation(staging, fact),
        "reconciliation_by_batch": RP.reconciliation_by_batch(staging, fact),
        "load_audit": RP.load_audit(staging),
    }
    paths = {}
    for name, df in out.items():
        p = _path(base, f"reports/{name}")
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def write_summary(summary: DataFrame, base: str) -> str:
    """Selection summary document (one JSON record)."""
    p = _path(base, "reports/model_selection_summary")
    summary.coalesce(1).write.mode("overwrite").json(p)
    return p
