"""Queries that run through the Parquet warehouse pipeline itself, over the whole tables.

The load order is meant to hurt: the first load covers two staged batches whose ids sort the wrong way
(``batch_9`` before ``batch_10``), and the last batch re-dates the whole first month, which must vanish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.plans import fixtures as FX
from tillsight.plans import params as P
from tillsight.plans import pipeline as PL
from tillsight.session import checkpoint_dir, materialize
from tillsight.sources.sales import sales_from_tables

# The month that the last batch moves away, and by how many days.
MOVED_BEFORE, MOVED_DAYS = "1995-02-01", 31


def _day(x: str):
    return F.lit(x).cast("date")


def _warehouse(spark: SparkSession, sf_dir: str) -> str:
    base = f"{checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex}"
    raw = materialize(sales_from_tables(spark, sf_dir, P.BATCH_CUT), "sales")  # the source files of all batches: joined once
    first = raw.filter(F.col("load_batch_id") == "batch_a")
    again = (first.filter(F.col("sale_date") >= F.lit(P.RELOAD_FROM))
             .withColumn("revenue", (F.col("revenue") + 1).cast("decimal(18,4)")))
    moved = (first.filter(F.col("sale_date") < _day(MOVED_BEFORE))
             .withColumn("sale_date", F.date_add("sale_date", MOVED_DAYS)))
    PL.stage_batch(first, base, "batch_9", "9.parquet", P.TEST_CATEGORY_MAP)
    PL.stage_batch(again, base, "batch_10", "10.parquet", P.TEST_CATEGORY_MAP)
    PL.run_etl(spark, base)
    last = raw.filter(F.col("load_batch_id") == "batch_b").unionByName(moved)
    PL.stage_batch(last, base, "batch_11", "11.parquet", P.TEST_CATEGORY_MAP)
    PL.run_etl(spark, base, "batch_11")
    return base


def q_pipeline_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows after the three loads, names resolved through the surrogate keys."""
    base = _warehouse(spark, sf_dir)
    fact, dc, dp = (spark.read.parquet(f"{base}/{t}") for t in ("fact_sales", "dim_customer", "dim_product"))
    return (fact.join(dc.select("customer_key", "customer_name"), "customer_key")
            .join(dp.select("product_key", "product_code"), "product_key")
            .select("source_row_id", "load_batch_id", "date_key", "sale_month", "customer_name", "product_code",
                    F.col("revenue").cast("double").alias("revenue"), F.col("profit").cast("double").alias("profit")))


def q_pipeline_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored scores after a file with every customer twice and an unknown one, then a second file for half of them."""
    base = _warehouse(spark, sf_dir)
    PL.build_snapshots(spark, base, [P.TEST_SNAPSHOT], P.LOOKBACK)
    scores = materialize(FX.score_file(spark, sf_dir, P.TEST_SNAPSHOT), "score_file")  # a file that three loads read
    half = scores.withColumn("churn_prob", F.col("churn_prob") / 2)
    unknown = spark.createDataFrame([("nobody", 0.5)], "customer_name string, churn_prob double")
    PL.load_scores(spark, base, half.unionByName(scores).unionByName(unknown), P.TEST_SNAPSHOT, batch_id="s9", vip_segment=P.TEST_VIP_SEGMENT)
    second = scores.filter(F.col("customer_name").endswith("7")).withColumn("churn_prob", F.col("churn_prob") / 4)
    for _ in range(2):  # a repeated load changes nothing
        PL.load_scores(spark, base, second, P.TEST_SNAPSHOT, batch_id="s10", vip_segment=P.TEST_VIP_SEGMENT)
    stored = spark.read.parquet(f"{base}/churn_score").select("customer_name", "load_batch_id", "churn_prob", "risk_score")
    rejected = spark.read.parquet(f"{base}/score_rejects").select("customer_name", F.concat(F.lit("rejected "), "load_batch_id").alias("load_batch_id"),
                                                                  "churn_prob", "risk_score")
    return stored.unionByName(rejected)


def registry() -> dict:
    return {f.__name__: f for f in (q_pipeline_fact, q_pipeline_scores)}
