"""Queries of the one-pass dashboard, growth, sketches, collations, load checks, versions and bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import checks as CK
from tillsight.operators import dashboard as DB
from tillsight.operators import evaluation as EV
from tillsight.operators import features as FE
from tillsight.operators import registry as RG
from tillsight.operators import scores as SC
from tillsight.operators import warehouse as WH
from tillsight.plans import fixtures as FX
from tillsight.plans import params as P
from tillsight.session import checkpoint_dir, materialize
from tillsight.sources.bucketed import write_bucketed

#: A month whose sales the growth query leaves out, so that the calendar has a gap.
EMPTY_MONTH = "1996-02"


def q_dashboard_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DB.dashboard_cube(FX.cleaned(spark, sf_dir))


def q_customers_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DB.customers_pivot(DB.dashboard_cube(FX.cleaned(spark, sf_dir), [("year_month", "segment", "customer_name")]), P.SEGMENTS)


def q_monthly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = FX.sales(spark, sf_dir).where(F.date_format("sale_date", "yyyy-MM") != EMPTY_MONTH)
    return DB.monthly_growth(sales).withColumn("growth", F.round("growth", 9))


def q_customer_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers by month: exact, and whether the estimate from merged day sketches lies within its bound."""
    sales = FX.cleaned(spark, sf_dir)
    month = F.date_format("sale_date", "yyyy-MM").alias("year_month")
    guess = DB.customers_from_sketches(DB.customer_sketches(sales), month).withColumnRenamed("customers", "guess")
    exact = sales.groupBy(month).agg(F.count_distinct("customer_name").alias("customers"))
    return exact.join(guess, "year_month").select("year_month", "customers", (F.abs(F.col("guess") - F.col("customers")) <= DB.error_bound(F.col("customers"))).alias("within_bound"))


def q_collated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by customer where every third line spells the name in capitals and every fifth in small letters."""
    n = F.crc32(F.col("source_row_id").cast("string").cast("binary"))
    name = F.when(n % 3 == 0, F.upper("customer_name")).when(n % 5 == 0, F.lower("customer_name")).otherwise(F.col("customer_name"))
    sales = FX.sales(spark, sf_dir).withColumn("customer_name", name)
    return DB.customer_revenue(DB.merged_names(sales)).withColumn("customer_name", F.lower("customer_name"))


def q_load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the written staging and fact tables, one aggregate a table."""
    money = ("revenue", "profit")
    st = materialize(FX.staged(spark, sf_dir), "staging")
    dc = WH.merge_dim_customer(None, WH.customer_candidates(st))
    dp = WH.merge_dim_product(None, WH.product_candidates(st))
    fact = materialize(WH.fact_rows(st, dc, dp), "fact")
    wrong = {"date_key": ~F.col("date_key").between(19000101, 20991231)}
    return CK.Checks("staging", FX.NOT_NULL_COLUMNS, money).report(st).unionByName(
        CK.Checks("fact_sales", ("date_key", "customer_key", "product_key"), money, wrong).report(fact))


def q_score_date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of date and score keys: a score file with every customer twice, the stored scores, the date dimension."""
    # dates and customers need four columns of staging; the file and the resolved scores are read several times
    st = materialize(FX.staged(spark, sf_dir).select("customer_name", "segment_name", "sale_date", "load_batch_id"), "staging")
    dates, dc = WH.dim_date_for(st), FX.dim_customer(spark, sf_dir, st)
    file = materialize(FX.score_file(spark, sf_dir, P.TEST_SNAPSHOT), "score_file")
    source = materialize(SC.resolve_customers(SC.stage_scores(file.unionByName(file.withColumn("churn_prob", F.col("churn_prob") / 2)), P.TEST_SNAPSHOT), dc),
                         "score_source")
    stored = SC.merge_scores(SC.merge_scores(None, source), source)
    return (WH.duplicate_keys(dates, ["date_key"], "dim_date.date_key").unionByName(WH.duplicate_keys(dates, ["full_date"], "dim_date.full_date"))
            .unionByName(WH.duplicate_keys(source, SC.SCORE_KEYS, "score_file.key")).unionByName(WH.duplicate_keys(stored, SC.SCORE_KEYS, "churn_score.key")))


def q_model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the champion among the stand-in models, selected at every month end."""
    labeled = materialize(FE.labeled_features(FX.sales(spark, sf_dir), P.ALL_MONTH_ENDS, P.LOOKBACK), "labeled")
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model_name"), F.expr(P.pseudo_prob_sql().replace("* 37", f"* {a}").replace("* 11", f"* {b}")).alias("churn_prob"))
                                 for m, (a, b) in FX.PSEUDO_MODELS.items()])).alias("m")
    scored = labeled.select("snapshot_date", "churn_label", models).select("snapshot_date", "churn_label", "m.*")
    metrics = EV.ranking_metrics_by(scored, ["snapshot_date", "model_name"]).where("roc_auc IS NOT NULL").withColumn("roc_auc", F.round("roc_auc", 9))
    best = metrics.groupBy(F.col("snapshot_date").alias("selected_on")).agg(F.min(F.struct((-F.col("roc_auc")).alias("down"), "model_name")).alias("b"))
    champions = best.select("selected_on", F.col("b.model_name").alias("model_name"), (-F.col("b.down")).alias("roc_auc"))
    return RG.versions(champions)


def q_bucketed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features joined to scores from tables in equal buckets of the customer: no exchange after the two writes."""
    base, tag = f"{checkpoint_dir(spark).rstrip('/')}/bucketed", uuid.uuid4().hex
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sales = write_bucketed(FX.sales(spark, sf_dir).where("customer_name IS NOT NULL"), f"sales_{tag}", f"{base}/sales_{tag}", "customer_name", n, ("sale_date",))
    scores = write_bucketed(FX.score_file(spark, sf_dir, P.TEST_SNAPSHOT), f"scores_{tag}", f"{base}/scores_{tag}", "customer_name", n)
    return FE.customer_features(sales, [P.TEST_SNAPSHOT], P.LOOKBACK).join(scores, "customer_name", "left")


def registry() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("q_") and callable(v)}
