"""One-pass dashboard, growth, sketches, collations, observed checks, model registry, bucketed tables."""

import datetime as dt
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillsight.operators import checks as CK
from tillsight.operators import dashboard as DB
from tillsight.operators import features as FE
from tillsight.operators import models as M
from tillsight.operators import registry as RG
from tillsight.operators import reports as RP
from tillsight.plans import churn as CH
from tillsight.plans import fixtures as FX
from tillsight.plans import params as P
from tillsight.sources import bucketed as BK

SALE = "sale_date date, segment_name string, category_name string, product_code string, customer_name string, revenue decimal(18,4), profit decimal(18,4)"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cube_levels_are_the_single_reports(spark):
    sales = FX.cleaned(spark, SF_SMALL)
    cube = DB.dashboard_cube(sales)
    assert exchanges(cube) == 1 + exchanges(sales)
    cube = cube.cache()
    assert rows(DB.at_level(cube, "segment")) == rows(RP.sales_by_segment(sales).select("segment", "transaction_count", "revenue", "profit"))
    assert rows(DB.at_level(cube, "category_name")) == rows(RP.revenue_by_category(sales))
    assert rows(DB.at_level(cube, "product_code")) == rows(RP.product_totals(sales).drop("margin"))
    share = RP.revenue_share(sales).select("segment", "customer_name", "revenue", "profit")
    assert rows(DB.at_level(cube, "segment", "customer_name").drop("transaction_count")) == rows(share)
    counted = {(r["year_month"], r["segment"]): r["customers"] for r in RP.customers_month_segment(sales).collect()}
    for r in DB.customers_pivot(cube, P.SEGMENTS).collect():
        assert all(r[s] == counted.get((r["year_month"], s), 0) for s in P.SEGMENTS)


def test_cube_tells_null_values_from_totals(spark):
    one = (dt.date(2024, 1, 2), None, None, "p", "c", D(1), D(1))
    cube = DB.dashboard_cube(spark.createDataFrame([one, (*one[:1], "s", *one[2:])], SALE))
    assert rows(DB.at_level(cube, "segment")) == [("s", 1, 1.0, 1.0), (None, 1, 1.0, 1.0)] and rows(DB.at_level(cube)) == [(2, 2.0, 2.0)]
    assert DB.at_level(DB.dashboard_cube(spark.createDataFrame([], SALE)), "segment").count() == 0


def test_growth_fills_months_without_sales(spark):
    def sale(day, revenue):
        return (dt.date.fromisoformat(day), "s", "k", "p", "c", D(revenue), D(0))
    got = DB.monthly_growth(spark.createDataFrame([sale("2023-11-30", 10), sale("2024-02-01", 5), sale("2024-02-29", 5), sale("2024-03-01", 15), (None, *sale("2024-02-01", 1)[1:])], SALE))
    assert [tuple(r) for r in got.orderBy("year_month").collect()] == [
        ("2023-11", 1, 10.0, None, None), ("2023-12", 0, 0.0, 10.0, -1.0), ("2024-01", 0, 0.0, 0.0, None), ("2024-02", 2, 10.0, 0.0, None), ("2024-03", 1, 15.0, 10.0, 0.5)]
    assert DB.monthly_growth(spark.createDataFrame([], SALE)).count() == 0


def test_sketches_merge_within_their_bound(spark):
    sales = FX.cleaned(spark, "/root/testdata/sf0.1")
    day = DB.customer_sketches(sales)
    for by in ([], [F.col("segment")], [F.trunc("sale_date", "year").alias("year")]):
        names = [c._jc.toString().split(" AS ")[-1].strip("`") for c in by]
        exact = sales.withColumnRenamed("segment_name", "segment").groupBy(*by).agg(F.count_distinct("customer_name").alias("exact"))
        both = DB.customers_from_sketches(day, *by).join(exact, names) if by else DB.customers_from_sketches(day).crossJoin(exact)
        got = both.select("customers", "exact", DB.error_bound(F.col("exact")).alias("bound")).collect()
        assert got and all(abs(r["customers"] - r["exact"]) <= r["bound"] for r in got)


def test_collations_merge_spellings(spark):
    one = (dt.date(2024, 1, 2), "s", "k", "p")
    sales = spark.createDataFrame([(*one, n, D(1), D(0)) for n in ("An", "AN", "an", "Ấn", "ẤN", "Bo", None, None)], SALE)
    got = {r["customer_name"]: r["transaction_count"] for r in DB.customer_revenue(DB.merged_names(sales)).collect()}
    assert got == {"AN": 3, "ẤN": 2, "Bo": 1, None: 2}
    assert DB.merged_names(sales, None) is sales and DB.merged_names(sales).columns == sales.columns
    blind = {r["customer_name"]: r["transaction_count"] for r in DB.customer_revenue(DB.merged_names(sales, "UNICODE_CI_AI")).collect()}
    assert blind == {"AN": 5, "Bo": 1, None: 2}


def test_checks_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, D(2)), (None, D(3)), (7, None)], "k int, revenue decimal(18,4)").repartition(3)
    checks = CK.Checks("t", ["k"], ["revenue"], {"k": F.col("k") > 5})
    assert checks.measure(df).first().asDict() == {"row_count": 3, "sum_revenue": 5.0, "null_k": 1, "wrong_k": 1}
    assert exchanges(checks.report(df)) == 1 + exchanges(df)
    assert {(r["table_name"], r["metric"], r["value"]) for r in checks.report(df).collect()} >= {("t", "row_count", 3.0), ("t", "null_k", 1.0)}
    with pytest.raises(CK.CheckFailed, match="null_k"):
        checks.require(df)
    assert CK.Checks("e", ["k"], ["revenue"]).require(df.limit(0)) == {"row_count": 0, "sum_revenue": None, "null_k": 0}


@pytest.fixture(scope="module")
def labeled(spark):
    return CH.labeled_snapshots(FX.sales(spark, SF_SMALL), P.SNAPSHOTS, P.LOOKBACK)


@pytest.mark.parametrize("spec", [M.LogisticSpec(), M.BoostedSpec(rounds=4), M.CalibratedForestSpec(forest=M.ForestSpec(num_trees=3))], ids=lambda s: s.name)
def test_a_reloaded_model_gives_the_same_scores(spark, labeled, spec):
    train, test = CH._at(labeled, P.TRAIN_SNAPSHOT), CH._at(labeled, P.TEST_SNAPSHOT)
    fitted = spec.fit(train)
    again = RG.from_document(spark, RG.to_document(fitted, tempfile.mkdtemp()))
    want = rows(fitted.transform(test).select("customer_name", "churn_prob"))
    assert rows(again.transform(test).select("customer_name", "churn_prob")) == want and want


def test_versions_rise_with_the_champion_only(spark):
    records = None
    for month, model in (("1", "a"), ("2", "a"), ("3", "b"), ("4", "a"), ("5", "a")):
        records = RG.registered(spark, records, month, model, 0.5, "{}")
    got = sorted((r["model_version"], r["model_name"], r["is_active"], r["registered_for"]) for r in records.collect())
    assert got == [(1, "a", False, "2"), (2, "b", False, "3"), (3, "a", True, "5")]
    champions = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", "a")], "selected_on string, model_name string")
    assert [(r["model_version"], r["is_active"]) for r in RG.versions(champions).orderBy("selected_on").collect()] == [(1, False), (1, False), (2, False), (3, True)]


def test_bucketed_tables_join_without_exchange(spark):
    base = tempfile.mkdtemp()
    sales, scores = FX.sales(spark, SF_SMALL).where("customer_name IS NOT NULL"), FX.score_file(spark, SF_SMALL, P.TEST_SNAPSHOT)
    stored = BK.write_bucketed(sales, "t_sales", f"{base}/sales", "customer_name", 8, ("sale_date",))
    BK.write_bucketed(scores, "t_scores", f"{base}/scores", "customer_name", 8)
    again = BK.attach(spark, "t_scores", f"{base}/scores", "customer_name", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = FE.customer_features(stored, [P.TEST_SNAPSHOT], P.LOOKBACK).join(again, "customer_name")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
        want = FE.customer_features(sales, [P.TEST_SNAPSHOT], P.LOOKBACK).join(scores, "customer_name")
        assert "Exchange hashpartitioning" in want._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(stored) == rows(sales)
