"""Smaller operator paths: merge rules, parameters, null counts, load errors, profile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.operators import cleaning as CL
from tillsight.operators import scores as SC
from tillsight.operators import warehouse as WH
from tillsight.operators.rules import Thresholds, default_params, thresholds_from_params


def test_upsert_with_merge_rules(spark):
    t = spark.createDataFrame([("a", 5, dt.date(2023, 1, 5)), ("b", 1, dt.date(2023, 1, 1))],
                              "k string, n int, first date")
    s = spark.createDataFrame([("a", 2, dt.date(2022, 12, 1)), ("c", 7, dt.date(2023, 2, 1))], t.schema)
    out = {r["k"]: r for r in WH.upsert(t, s, ["k"], rules={
        "n": F.col("t.n") + F.col("s.n"), "first": F.least("t.first", "s.first")}).collect()}
    assert out["a"]["n"] == 7 and out["a"]["first"] == dt.date(2022, 12, 1)
    assert out["b"]["n"] == 1 and out["c"]["n"] == 7


def test_thresholds_from_params(spark):
    assert thresholds_from_params(default_params(spark)) == Thresholds()
    bad = spark.createDataFrame([("UrgentThreshold", "0.7"), ("HighThreshold", "x")],
                                "parameter_name string, parameter_value string")
    t = thresholds_from_params(bad)
    assert (t.urgent, t.high, t.medium) == (0.7, K.HIGH_THRESHOLD, K.MEDIUM_THRESHOLD)


def test_null_counts_and_profile(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", 1)], "x string, y int")
    r = WH.null_counts(df, ["x", "y"]).first()
    assert (r["null_x"], r["null_y"]) == (1, 2)
    s = spark.createDataFrame([("A", 1, 0.5, dt.date(2023, 9, 1)), ("B", 2, 0.25, dt.date(2023, 10, 2))],
                              "category_name string, month_number int, margin_pct double, sale_date date")
    p = CL.column_profile(s).first()
    assert (p["categories"], p["months"], p["avg_margin_pct"]) == (2, 2, 0.375)


def test_load_errors(spark):
    empty = spark.createDataFrame([], "load_batch_id string, sale_date date")
    with pytest.raises(WH.EtlError) as e:
        WH.batch_date_range(empty, "nothing")
    assert e.value.code == 50002
    scores = SC.stage_scores(spark.createDataFrame([(" ann ", 0.4)], "customer_name string, churn_prob double"),
                             dt.date(2023, 11, 30))
    assert scores.first()["customer_name"] == "ann" and scores.first()["risk_score"] == 4.0
    dim = spark.createDataFrame([(1, "bob")], "customer_key long, customer_name string")
    with pytest.raises(WH.EtlError) as e:
        SC.require_known(scores, dim)
    assert e.value.code == 50003
    assert SC.unknown_customers(scores, dim).count() == 1


def test_merge_scores_newest_wins(spark):
    cols = "snapshot_date date, customer_key long, model_name string, model_version string, " \
           "churn_prob double, risk_score double, load_batch_id string"
    d = dt.date(2023, 11, 30)
    t = spark.createDataFrame([(d, 1, "m", "v", 0.1, 1.0, "b1"), (d, 2, "m", "v", 0.2, 2.0, "b1")], cols)
    s = spark.createDataFrame([(d, 2, "m", "v", 0.9, 9.0, "b2")], cols)
    out = {r["customer_key"]: r["churn_prob"] for r in SC.merge_scores(t, s).collect()}
    assert out == {1: 0.1, 2: 0.9}
