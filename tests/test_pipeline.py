"""End-to-end warehouse pipeline on sf0.001: batches, re-load, snapshots, scores, reports."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillsight.operators import features as FE
from tillsight.plans import fixtures as FX
from tillsight.plans import params as P
from tillsight.plans import pipeline as PL
from tillsight.sources.sales import sales_from_tables


def test_pipeline_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="tillsight-wh-")
    raw = sales_from_tables(spark, SF_SMALL, P.BATCH_CUT)
    a = raw.filter(F.col("load_batch_id") == "batch_a")
    b = raw.filter(F.col("load_batch_id") == "batch_b")
    reload = a.filter(F.col("sale_date") >= F.lit(P.RELOAD_FROM)) \
              .withColumn("revenue", (F.col("revenue") + 1).cast("decimal(18,4)"))
    total = raw.count()
    n_reload = reload.count()
    rev_total = raw.agg(F.sum("revenue")).first()[0]

    PL.stage_batch(a, base, "batch_a", "a.parquet", P.TEST_CATEGORY_MAP)
    PL.run_etl(spark, base, "batch_a")
    PL.stage_batch(b, base, "batch_b", "b.parquet", P.TEST_CATEGORY_MAP)
    PL.run_etl(spark, base, "batch_b")
    PL.stage_batch(reload, base, "batch_c", "c.parquet", P.TEST_CATEGORY_MAP)
    PL.run_etl(spark, base, "batch_c")

    fact = spark.read.parquet(f"{base}/fact_sales")
    assert fact.count() == total
    assert fact.agg(F.sum("revenue")).first()[0] == rev_total + n_reload
    assert fact.filter(F.col("load_batch_id") == "batch_c").count() == n_reload
    before = sorted(map(tuple, fact.select("source_row_id", "load_batch_id", "revenue").collect()))
    PL.run_etl(spark, base, "batch_c")   # same batch again: no change
    after = sorted(map(tuple, spark.read.parquet(f"{base}/fact_sales")
                       .select("source_row_id", "load_batch_id", "revenue").collect()))
    assert before == after

    dc = spark.read.parquet(f"{base}/dim_customer")
    assert dc.select("customer_key").distinct().count() == dc.count() == dc.select("customer_name").distinct().count()

    snap = PL.build_snapshots(spark, base, P.SNAPSHOTS, P.LOOKBACK)
    direct = FE.customer_features(FX.sales(spark, SF_SMALL), P.SNAPSHOTS, P.LOOKBACK)
    assert snap.count() == direct.count()

    scores = FX.score_file(spark, SF_SMALL, P.FORECAST_SNAPSHOT).unionByName(
        spark.createDataFrame([("nobody", 0.5)], "customer_name string, churn_prob double"))
    ruled = PL.load_scores(spark, base, scores, P.FORECAST_SNAPSHOT, batch_id="s1",
                           vip_segment=P.TEST_VIP_SEGMENT)
    assert ruled.count() == scores.count() - 1
    assert spark.read.parquet(f"{base}/score_rejects").count() == 1
    assert ruled.filter(F.col("risk_level").isNull()).count() == 0

    paths = PL.write_reports(spark, base, P.FORECAST_SNAPSHOT)
    rec = {r["source_name"]: r for r in spark.read.parquet(paths["reconciliation"]).collect()}
    assert rec["staging"]["row_count"] == total + n_reload and rec["fact"]["row_count"] == total
    assert spark.read.parquet(paths["churn_list"]).count() == ruled.count()
