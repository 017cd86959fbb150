"""Fixtures built from the driver tables for the registered queries.

* load batches: lines shipped before 1998-07-01 are ``batch_a``, later ones
  ``batch_b``; each batch is one source "file".
* re-load: the ``batch_a`` lines shipped from 1998-06-01 on are loaded again
  as ``batch_c`` with revenue + 1 (the newest batch wins the upsert).
* scores: a deterministic integer score stands in for a model where the
  SQL oracle must reproduce the value exactly (``params.pseudo_prob_sql``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import cleaning as CL
from tillsight.operators import daystates as DS
from tillsight.operators import evaluation as EV
from tillsight.operators import features as FE
from tillsight.operators import warehouse as WH
from tillsight.operators.rules import Thresholds, apply_rules
from tillsight.plans import params as P
from tillsight.session import materialize
from tillsight.sources.sales import sales_from_tables

HASH_COLUMNS = ("source_row_id", "product_code", "product_name", "unit_name", "customer_name",
                "segment_name", "sale_date")
CHANGE_COLUMNS = HASH_COLUMNS + ("revenue", "profit", "sales_quantity")
# Columns the staging contract declares NOT NULL.
NOT_NULL_COLUMNS = ("source_row_id", "product_code", "revenue", "sale_date", "customer_name", "profit")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_tables(spark, sf_dir, P.BATCH_CUT)


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that features and labels need, joined once and written: both read them."""
    return materialize(sales(spark, sf_dir).select(*DS.LINE_COLUMNS), "sales")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.clean_sales(sales(spark, sf_dir), P.TEST_CATEGORY_MAP)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cleaned(spark, sf_dir)
    return c.withColumn("source_file_name", F.concat(F.col("load_batch_id"), F.lit(".parquet")))


def staged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows computed once per query (they feed every dimension and the fact), written as a table like the pipeline's."""
    return materialize(staged(spark, sf_dir), "staging")


#: Staging columns that keys, dimensions and the order of loads need, whatever the fact measures.
LOAD_COLUMNS = ("source_row_id", "load_batch_id", "source_file_name", "sale_date", "customer_name", "segment_name", "product_code", "product_name",
                "unit_name", "category_name")


def load_table(spark: SparkSession, sf_dir: str, measures: Sequence[str]) -> DataFrame:
    """``staged_table`` with the given measures only: no column is written that the query does not read."""
    return materialize(staged(spark, sf_dir).select(*LOAD_COLUMNS, *measures), "staging")


def reload_rows(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    st = staged_table(spark, sf_dir) if st is None else st
    return (st.filter((F.col("load_batch_id") == "batch_a") & (F.col("sale_date") >= F.lit(P.RELOAD_FROM)))
              .withColumn("revenue", (F.col("revenue") + 1).cast("decimal(18,4)"))
              .withColumn("load_batch_id", F.lit("batch_c"))
              .withColumn("source_file_name", F.lit("batch_c.parquet")))


def staged_with_reload(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    st = staged_table(spark, sf_dir) if st is None else st
    return st.unionByName(reload_rows(spark, sf_dir, st))


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old version = batch_a; new version = batch_a from March on (June on re-priced) + batch_b."""
    st = staged(spark, sf_dir)
    old = st.filter(F.col("load_batch_id") == "batch_a")
    a = old.filter(F.col("sale_date") >= F.lit("1998-03-01").cast("date"))
    a = a.withColumn("revenue", F.when(F.col("sale_date") >= F.lit(P.RELOAD_FROM),
                                       (F.col("revenue") + 1).cast("decimal(18,4)"))
                     .otherwise(F.col("revenue")))
    new = a.unionByName(st.filter(F.col("load_batch_id") == "batch_b"))
    return old, new


def dim_customer(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Customer dimension loaded batch by batch: batch_a, then batch_b merged in."""
    st = staged_table(spark, sf_dir) if st is None else st
    d = WH.merge_dim_customer(None, WH.customer_candidates(st, "batch_a")).persist(StorageLevel.MEMORY_AND_DISK)
    return WH.merge_dim_customer(d, WH.customer_candidates(st, "batch_b"))


def dim_customer_june(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension of batch_a restricted to June 1998 (unknown-customer fixture)."""
    st = staged(spark, sf_dir).filter(F.col("sale_date") >= F.lit(P.RELOAD_FROM))
    return WH.merge_dim_customer(None, WH.customer_candidates(st, "batch_a"))


def dim_product(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    st = staged_table(spark, sf_dir) if st is None else st
    d = WH.merge_dim_product(None, WH.product_candidates(st, "batch_a")).persist(StorageLevel.MEMORY_AND_DISK)
    return WH.merge_dim_product(d, WH.product_candidates(st, "batch_b"))


def fact(spark: SparkSession, sf_dir: str, st: DataFrame | None = None,
         dc: DataFrame | None = None, dp: DataFrame | None = None) -> DataFrame:
    st = staged_table(spark, sf_dir) if st is None else st
    dc = dim_customer(spark, sf_dir, st) if dc is None else dc
    dp = dim_product(spark, sf_dir, st) if dp is None else dp
    return WH.fact_rows(st, dc, dp)


def upserted_fact(spark: SparkSession, sf_dir: str, st: DataFrame | None = None) -> DataFrame:
    """Fact of batch_a, then batch_b + batch_c + the original June rows upserted (newest batch wins)."""
    st = staged_table(spark, sf_dir) if st is None else st
    dc, dp = dim_customer(spark, sf_dir, st), dim_product(spark, sf_dir, st)
    target = WH.fact_rows(st, dc, dp, "batch_a")
    june_again = st.filter((F.col("load_batch_id") == "batch_a")
                           & (F.col("sale_date") >= F.lit(P.RELOAD_FROM)))
    src_rows = st.filter(F.col("load_batch_id") == "batch_b").unionByName(reload_rows(spark, sf_dir, st)) \
        .unionByName(june_again)
    # read several times: made once, with the columns of the staged rows only
    source = materialize(WH.fact_rows(src_rows, dc, dp), "fact_source")
    newest = WH.newest_of_stored(source, ["source_system", "source_row_id"], ["load_batch_id"])
    return WH.upsert(target, newest, ["source_system", "source_row_id"])


def labeled(spark: SparkSession, sf_dir: str, snapshots) -> DataFrame:
    s = sales(spark, sf_dir)
    return FE.with_churn_label(FE.customer_features(s, snapshots, P.LOOKBACK), s, snapshots)


def pseudo_scores(feats: DataFrame, a: int = 37, b: int = 11, name: str = "churn_prob") -> DataFrame:
    expr = P.pseudo_prob_sql().replace("* 37", f"* {a}").replace("* 11", f"* {b}")
    return feats.withColumn(name, F.expr(expr))


def score_file(spark: SparkSession, sf_dir: str, snapshot) -> DataFrame:
    """A score file for every customer of a snapshot: (customer_name, churn_prob)."""
    f = FE.customer_features(sales(spark, sf_dir), [snapshot], P.LOOKBACK)
    return pseudo_scores(f).select("customer_name", "churn_prob")


def scored_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast snapshot features with the stand-in score and the business rules applied."""
    f = FE.customer_features(sales(spark, sf_dir), [P.FORECAST_SNAPSHOT], P.LOOKBACK)
    scored = pseudo_scores(f)
    return apply_rules(scored, None, Thresholds(), P.TEST_VIP_SEGMENT, clip_score=True)


def scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test snapshot with labels and the stand-in score."""
    return pseudo_scores(labeled(spark, sf_dir, [P.TEST_SNAPSHOT]))


# Stand-in models: name -> (recency factor, frequency factor)
PSEUDO_MODELS = {"recency_rule": (1, 0), "mix_a": (37, 11), "mix_b": (5, 3)}


def champion_of_pseudo_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = labeled(spark, sf_dir, [P.TEST_SNAPSHOT])
    rows = None
    t = Thresholds().urgent
    for name, (a, b) in PSEUDO_MODELS.items():
        sc = pseudo_scores(base, a, b)
        r = EV.ranking_metrics(sc, threshold=t).select(
            F.lit(name).alias("model_name"), "roc_auc",
            F.round("average_precision", 12).alias("average_precision"), "f2", "precision")
        rows = r if rows is None else rows.unionByName(r)
    return EV.champion(rows)
