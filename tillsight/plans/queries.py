"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query starts from the driver's whole tables; parameters (snapshot
dates, thresholds, maps) come from ``plans.params``. The fixtures behind
them (load batches, a re-load, scores) are described in ``plans.fixtures``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import cleaning as CL
from tillsight.operators import evaluation as EV
from tillsight.operators import features as FE
from tillsight.operators import reports as RP
from tillsight.operators import warehouse as WH
from tillsight.operators.rules import Thresholds, apply_rules
from tillsight.operators.scores import stage_scores, unknown_customers
from tillsight.plans import fixtures as FX
from tillsight.plans import params as P

# ---------------------------------------------------------------- cleaning


def q_clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = FX.cleaned(spark, sf_dir)
    return c.select("source_row_id", "product_code", "category_name", "sale_date", "year_number",
                    "month_number", F.col("revenue").cast("double").alias("revenue"),
                    F.col("profit").cast("double").alias("profit"),
                    F.col("sales_quantity").cast("double").alias("sales_quantity"),
                    "margin_pct", "revenue_per_unit")


def q_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = FX.cleaned(spark, sf_dir)
    return c.groupBy("product_code", "category_name").agg(F.count(F.lit(1)).alias("lines"))


def q_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.kpis(FX.cleaned(spark, sf_dir))


def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = FX.sales(spark, sf_dir)
    return s.select("source_row_id", CL.row_hash(FX.HASH_COLUMNS).alias("row_hash"))


def q_row_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = FX.versions(spark, sf_dir)
    return CL.row_changes(old, new, "source_row_id", FX.CHANGE_COLUMNS)


# --------------------------------------------------------------- warehouse


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WH.dim_date_for(FX.staged(spark, sf_dir))


def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.dim_customer(spark, sf_dir).drop("customer_key", "is_active")


def q_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.dim_product(spark, sf_dir).drop("product_key")


def q_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FX.fact(spark, sf_dir, FX.load_table(spark, sf_dir, ["revenue", "profit", "promo_pct"]))
    return f.select("source_system", "source_row_id", "load_batch_id", "date_key", "segment_at_sale",
                    *[F.col(c).cast("double").alias(c) for c in ("revenue", "profit", "promo_pct")])


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FX.upserted_fact(spark, sf_dir, FX.load_table(spark, sf_dir, ["revenue"]))
    return f.select("source_row_id", "load_batch_id", F.col("revenue").cast("double").alias("revenue"))


def q_unknown_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = FX.score_file(spark, sf_dir, P.TEST_SNAPSHOT)
    staged = stage_scores(scores, P.TEST_SNAPSHOT)
    dim = FX.dim_customer_june(spark, sf_dir)
    return unknown_customers(staged, dim).select("snapshot_date", "customer_name", "churn_prob")


def q_dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.staged_table(spark, sf_dir)
    feats = FE.customer_features(st, P.SNAPSHOTS, P.LOOKBACK)
    dc, dp = FX.dim_customer(spark, sf_dir, st), FX.dim_product(spark, sf_dir, st)
    parts = [
        WH.duplicate_keys(st, ["source_row_id"], "staging.source_row_id"),
        WH.duplicate_keys(st, ["customer_name", "sale_date", "product_code"], "staging.customer_day_product"),
        WH.duplicate_keys(dc, ["customer_name"], "dim_customer.customer_name"),
        WH.duplicate_keys(dp, ["product_code"], "dim_product.product_code"),
        WH.duplicate_keys(FX.fact(spark, sf_dir, st, dc, dp), ["source_system", "source_row_id"],
                          "fact.source_row"),
        WH.duplicate_keys(feats, ["snapshot_date", "customer_name"], "snapshot.snapshot_customer"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.staged(spark, sf_dir)
    dc = WH.customer_candidates(st, "batch_a")
    dp = WH.product_candidates(st, "batch_a")
    return (WH.orphans(st, dc, "customer_name", "staging.customer_name")
            .unionByName(WH.orphans(st, dp, "product_code", "staging.product_code")))


# ---------------------------------------------------------------- features


def q_customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.customer_features(FX.sales(spark, sf_dir), [P.TEST_SNAPSHOT], P.LOOKBACK)


def q_trend_both_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.customer_features(FX.sales(spark, sf_dir), [P.TEST_SNAPSHOT], P.LOOKBACK,
                                trend_mode="both_windows")


def q_segment_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FE.customer_features(FX.sales(spark, sf_dir), P.SNAPSHOTS, P.LOOKBACK, segment_scope="history")
    return f.select("snapshot_date", "customer_name", "segment")


def q_multi_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.customer_features(FX.sales(spark, sf_dir), P.ALL_MONTH_ENDS, P.LOOKBACK)


def q_model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = FX.labeled(spark, sf_dir, P.SNAPSHOTS)
    dim = FX.dim_customer(spark, sf_dir).select("customer_name")
    return lab.join(dim, "customer_name")


def q_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.labeled(spark, sf_dir, [P.TRAIN_SNAPSHOT, P.TEST_SNAPSHOT])


# ------------------------------------------------------------------ labels


def q_churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.labeled(spark, sf_dir, P.SNAPSHOTS).select("snapshot_date", "customer_name", "churn_label")


def q_retained_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = FX.sales(spark, sf_dir)
    f = FE.customer_features(s, P.SNAPSHOTS, P.LOOKBACK)
    return FE.retained(f, s, P.SNAPSHOTS).select("snapshot_date", "customer_name")


def q_churned_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = FX.sales(spark, sf_dir)
    f = FE.customer_features(s, P.SNAPSHOTS, P.LOOKBACK)
    return FE.churned(f, s, P.SNAPSHOTS).select("snapshot_date", "customer_name")


# ------------------------------------------------------------------- rules


def q_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = FX.sales(spark, sf_dir)
    feats = FE.customer_features(s, P.SNAPSHOTS, P.LOOKBACK)
    scores = FX.pseudo_scores(feats)
    r = apply_rules(scores.select("snapshot_date", "customer_name", "churn_prob"), feats,
                    Thresholds(), P.TEST_VIP_SEGMENT, clip_score=True)
    return r.select("snapshot_date", "customer_name", "churn_prob", "risk_score", "risk_level",
                    "sales_action")


def q_churn_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.churn_list(FX.scored_forecast(spark, sf_dir))


def q_churn_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.churn_by_segment(FX.scored_forecast(spark, sf_dir))


# ----------------------------------------------------------------- reports


def q_rfm_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.rfm_summary(FE.customer_features(FX.sales(spark, sf_dir), [P.TEST_SNAPSHOT], P.LOOKBACK))


def q_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.staged_table(spark, sf_dir)
    return RP.monthly_sales(FX.fact(spark, sf_dir, st), WH.dim_date_for(st))


def q_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.staged_table(spark, sf_dir)
    dc = FX.dim_customer(spark, sf_dir, st)
    return RP.top_customers(FX.fact(spark, sf_dir, st, dc), dc, 20)


def q_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.load_table(spark, sf_dir, ["revenue", "profit"])
    return RP.reconciliation(FX.staged_with_reload(spark, sf_dir, st), FX.upserted_fact(spark, sf_dir, st))


def q_reconciliation_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = FX.load_table(spark, sf_dir, ["revenue"])
    return RP.reconciliation_by_batch(FX.staged_with_reload(spark, sf_dir, st), FX.upserted_fact(spark, sf_dir, st))


def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WH.null_counts(FX.staged(spark, sf_dir), FX.NOT_NULL_COLUMNS)


def q_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.column_profile(FX.cleaned(spark, sf_dir))


def q_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.load_audit(FX.staged_with_reload(spark, sf_dir))


def q_sales_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.sales_by_segment(FX.cleaned(spark, sf_dir))


def q_customer_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.customer_share(FX.dim_customer(spark, sf_dir))


def q_customers_month_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.customers_month_segment(FX.cleaned(spark, sf_dir))


def q_top_products_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.top_products_by_margin(FX.cleaned(spark, sf_dir), 5)


def q_top_products_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.top_products_by_revenue(FX.cleaned(spark, sf_dir), 10)


def q_revenue_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.revenue_share(FX.cleaned(spark, sf_dir))


def q_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.revenue_by_category(FX.cleaned(spark, sf_dir))


# ----------------------------------------------------------------- metrics


def q_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.threshold_sweep(FX.scored_test(spark, sf_dir))


def q_choose_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.choose_threshold(EV.threshold_sweep(FX.scored_test(spark, sf_dir)))


def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.confusion(FX.scored_test(spark, sf_dir), Thresholds().urgent)


def q_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.ranking_metrics(FX.scored_test(spark, sf_dir)).select("roc_auc", "positives", "negatives")


def q_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = EV.ranking_metrics(FX.scored_test(spark, sf_dir))
    return m.select(F.round("average_precision", 12).alias("average_precision"), "positives")


def q_champion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.champion_of_pseudo_models(spark, sf_dir)


def registry() -> dict:
    from tillsight.plans import dashboard_queries as DQ
    from tillsight.plans import model_queries as MQ
    from tillsight.plans import pipeline_queries as PQ
    from tillsight.plans import published_queries as WQ
    out = {k: v for k, v in globals().items() if k.startswith("q_") and callable(v)}
    out.update(MQ.registry())
    out.update(PQ.registry())
    out.update(WQ.registry())
    out.update(DQ.registry())
    return out
