"""Hand-written edge rows for the semantic decisions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.operators import cleaning as CL
from tillsight.operators import features as FE
from tillsight.operators import warehouse as WH
from tillsight.operators.rules import Thresholds, apply_rules, risk_score

S = dt.date(2023, 9, 30)
COLS = "source_row_id string, customer_name string, sale_date date, revenue decimal(18,4), " \
       "profit decimal(18,4), promo_pct decimal(18,8), segment_name string"


def day(n):
    return S + dt.timedelta(days=n)


def sales(spark, rows):
    full = [(r[0], r[1], r[2], r[3], r[4] if len(r) > 4 else 0, None, r[5] if len(r) > 5 else "S")
            for r in rows]
    from decimal import Decimal
    full = [(a, b, c, Decimal(str(d)), Decimal(str(e)), f, g) for a, b, c, d, e, f, g in full]
    return spark.createDataFrame(full, COLS)


def feats(spark, rows, **kw):
    df = FE.customer_features(sales(spark, rows), [S], 90, **kw)
    return {r["customer_name"]: r for r in df.collect()}


def test_trend_zero_fill_and_both_windows(spark):
    rows = [("1", "A", day(-10), 100), ("2", "B", day(-45), 100),
            ("3", "C", day(-10), 100), ("4", "C", day(-45), 40)]
    z = feats(spark, rows)
    b = feats(spark, rows, trend_mode="both_windows")
    assert [z[c]["trend"] for c in "ABC"] == [100.0, -100.0, 60.0]
    assert [b[c]["trend"] for c in "ABC"] == [0.0, 0.0, 60.0]


def test_trend_window_bounds(spark):
    rows = [("1", "A", day(-29), 1), ("2", "A", day(-30), 10), ("3", "A", day(-59), 100),
            ("4", "A", day(-60), 1000)]
    f = feats(spark, rows)["A"]
    assert f["trend"] == 1 - 110
    assert f["frequency"] == 4  # -60 is still inside the 90-day lookback


def test_lookback_bounds(spark):
    rows = [("1", "A", day(-90), 1), ("2", "A", day(-89), 2), ("3", "A", day(0), 3), ("4", "A", day(1), 4)]
    f = feats(spark, rows)["A"]
    assert f["frequency"] == 2 and f["recency"] == 0 and f["days_since_first"] == 89
    assert f["aov"] == 2.5


def test_segment_scope_window_vs_history(spark):
    rows = [("1", "A", day(-200), 1, 0, "VIP"), ("2", "A", day(-5), 1, 0, None)]
    assert feats(spark, rows)["A"]["segment"] is None
    assert feats(spark, rows, segment_scope="history")["A"]["segment"] == "VIP"


def test_segment_same_day_tie_takes_larger_key(spark):
    rows = [("1", "A", day(-5), 1, 0, "X"), ("2", "A", day(-5), 1, 0, "Y")]
    assert feats(spark, rows)["A"]["segment"] == "Y"


def test_margin_zero_revenue_and_active_months(spark):
    rows = [("1", "A", day(-40), 0, 5), ("2", "A", day(-5), 0, 5)]
    f = feats(spark, rows)["A"]
    assert f["margin"] == 0.0 and f["active_months"] == 2


def test_label_window(spark):
    s = sales(spark, [("1", "A", day(-1), 1), ("2", "B", day(-1), 1), ("3", "C", day(-1), 1),
                      ("4", "D", day(-1), 1),
                      ("5", "A", day(0), 1), ("6", "B", day(1), 1), ("7", "C", day(31), 1),
                      ("8", "D", day(32), 1)])
    f = FE.customer_features(s, [S], 90)
    lab = {r["customer_name"]: r["churn_label"] for r in FE.with_churn_label(f, s, [S]).collect()}
    assert lab == {"A": 1, "B": 0, "C": 0, "D": 1}
    ret = {r["customer_name"] for r in FE.retained(f, s, [S]).collect()}
    gone = {r["customer_name"] for r in FE.churned(f, s, [S]).collect()}
    assert ret == {"B", "C"} and gone == {"A", "D"}


def test_multi_snapshot_equals_single(spark):
    rows = [(str(i), "AB"[i % 2], day(-i * 7), i + 1) for i in range(30)]
    snaps = [S, day(-31), day(-61)]
    multi = FE.customer_features(sales(spark, rows), snaps, 90)
    for sn in snaps:
        one = FE.customer_features(sales(spark, rows), [sn], 90)
        a = sorted(map(tuple, multi.filter(F.col("snapshot_date") == sn).collect()))
        b = sorted(map(tuple, one.collect()))
        assert a == b


def test_cutoffs_derived():
    t = Thresholds.derived(0.538)
    assert (t.high, t.medium) == (0.35, 0.2)
    t = Thresholds.derived(0.70)
    assert abs(t.high - 0.5) < 1e-12 and abs(t.medium - 0.3) < 1e-12


def test_risk_score(spark):
    df = spark.createDataFrame([(0.02,), (0.5,), (1.0,)], "p double")
    clipped = [r[0] for r in df.select(risk_score("p")).collect()]
    raw = [r[0] for r in df.select(risk_score("p", clip=False)).collect()]
    assert clipped == [1.0, 5.0, 10.0]
    assert [round(x, 9) for x in raw] == [0.2, 5.0, 10.0]


def test_rules_order_and_null_recency(spark):
    scores = spark.createDataFrame(
        [(S, "v", 0.9), (S, "c", 0.1), (S, "o", 0.1), (S, "f", 0.1), (S, "n", 0.1)],
        "snapshot_date date, customer_name string, churn_prob double")
    snap = spark.createDataFrame(
        [(S, "v", K.VIP_SEGMENT, 5), (S, "c", "x", 61), (S, "o", "x", 31), (S, "f", "x", 30)],
        "snapshot_date date, customer_name string, segment string, recency int")
    out = {r["customer_name"]: (r["risk_level"], r["sales_action"])
           for r in apply_rules(scores, snap, Thresholds()).collect()}
    assert out["v"] == (K.LEVEL_URGENT, K.ACTION_VISIT)
    assert out["c"][1] == K.ACTION_CALL
    assert out["o"][1] == K.ACTION_OFFER
    assert out["f"][1] == K.ACTION_FOLLOW_UP
    assert out["n"] == (K.LEVEL_LOW, K.ACTION_FOLLOW_UP)


def test_dim_customer_date_scope(spark):
    s = spark.createDataFrame([("c", "X", dt.date(2023, 1, 5)), ("c", "Y", dt.date(2023, 3, 5)),
                               ("c", "Y", dt.date(2023, 5, 5))],
                              "customer_name string, segment_name string, sale_date date")
    seg = WH.customer_candidates(s, date_scope="segment").first()
    cus = WH.customer_candidates(s, date_scope="customer").first()
    assert seg["current_segment"] == "Y" and seg["first_purchase_date"] == dt.date(2023, 3, 5)
    assert cus["first_purchase_date"] == dt.date(2023, 1, 5)


def test_upsert_newest_batch_wins(spark):
    t = spark.createDataFrame([("1", "a", 10), ("2", "a", 20)], "k string, b string, v int")
    s = spark.createDataFrame([("2", "b", 21), ("2", "c", 22), ("3", "b", 30)], "k string, b string, v int")
    once = WH.upsert(t, s, ["k"], order=["b"])
    twice = WH.upsert(once, s, ["k"], order=["b"])
    assert sorted(map(tuple, once.collect())) == [("1", "a", 10), ("2", "c", 22), ("3", "b", 30)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_dimension_keys_kept_and_new_numbered(spark):
    c1 = spark.createDataFrame([("a", "S", dt.date(2023, 1, 1), dt.date(2023, 1, 2)),
                                ("b", "S", dt.date(2023, 1, 1), dt.date(2023, 1, 2))],
                               "customer_name string, current_segment string, first_purchase_date date, "
                               "last_purchase_date date")
    d1 = WH.merge_dim_customer(None, c1)
    c2 = spark.createDataFrame([("b", "T", dt.date(2022, 12, 1), dt.date(2023, 2, 1)),
                                ("c", "S", dt.date(2023, 2, 1), dt.date(2023, 2, 2))], c1.schema)
    d2 = {r["customer_name"]: r for r in WH.merge_dim_customer(d1, c2).collect()}
    k1 = {r["customer_name"]: r["customer_key"] for r in d1.collect()}
    assert sorted(k1.values()) == [1, 2]
    assert d2["b"]["customer_key"] == k1["b"] and d2["c"]["customer_key"] == 3
    assert d2["b"]["current_segment"] == "T"
    assert d2["b"]["first_purchase_date"] == dt.date(2022, 12, 1)
    assert d2["b"]["last_purchase_date"] == dt.date(2023, 2, 1)


def test_dim_date_weekend_and_bad_range(spark):
    d = WH.dim_date(spark, dt.date(2023, 9, 1), dt.date(2023, 9, 4)).orderBy("full_date").collect()
    assert [r["is_weekend"] for r in d] == [False, True, True, False]
    assert d[0]["date_key"] == 20230901 and d[0]["month_name"] == "September"
    with pytest.raises(WH.EtlError):
        WH.dim_date(spark, dt.date(2023, 9, 4), dt.date(2023, 9, 1))


def test_cleaning_numbers_dates_codes(spark):
    raw = spark.createDataFrame(
        [("KV12", "12", "05/09/2023", " a "), ("KVK3", " 7 ", "2023-09-05", "\tb"),
         ("kv1", "x", "x", "c"), ("12", None, None, "d"), (None, "1", None, "e"), ("T9", "1", None, "f"),
         (None, None, None, None)],
        "product_code string, revenue string, sale_date string, customer_name string")
    raw = (raw.withColumn("profit", F.when(F.col("customer_name").isNotNull(), F.lit("1")))
              .withColumn("sales_quantity", F.when(F.col("customer_name").isNotNull(), F.lit("0"))))
    rows = CL.clean_sales(raw).collect()
    assert len(rows) == 6
    assert [r["revenue"] for r in rows[:4]] == [12, 7, 0, 0]
    assert [r["sale_date"] for r in rows[:3]] == [dt.date(2023, 9, 5), dt.date(2023, 9, 5), None]
    assert [r["category_name"] for r in rows] == ["Khăn Giấy", "Khăn Giấy", K.DEFAULT_CATEGORY,
                                                   K.DEFAULT_CATEGORY, K.DEFAULT_CATEGORY, "Chăm Sóc Nhà Cửa"]
    assert [r["customer_name"] for r in rows[:2]] == ["a", "b"]
    assert rows[3]["margin_pct"] == 0.0 and rows[0]["revenue_per_unit"] == 0.0


def test_margin_pct_half_even(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("1.0"), Decimal("8.0"), Decimal("2.0"))],
                               "profit decimal(18,4), revenue decimal(18,4), sales_quantity decimal(18,4)")
    r = CL.clean_sales(df.withColumn("product_code", F.lit("A"))).first()
    assert r["margin_pct"] == 0.125  # 0.125 exactly: 4 decimals keep it
    df2 = spark.createDataFrame([(Decimal("1.0"), Decimal("5.0"), Decimal("2.0"))], df.schema)
    r2 = CL.clean_sales(df2.withColumn("product_code", F.lit("A"))).first()
    assert r2["revenue_per_unit"] == 2.0  # 2.5 rounds half to even


def test_row_changes(spark):
    old = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "k string, v int")
    new = spark.createDataFrame([("2", 2), ("3", 30), ("4", 4)], "k string, v int")
    out = {r["k"]: r["change_status"] for r in CL.row_changes(old, new, "k", ["k", "v"]).collect()}
    assert out == {"1": "gone", "2": "same", "3": "changed", "4": "new"}


def test_require_columns():
    from tillsight.sources.sales import MissingColumnsError, require_columns

    class Fake:
        columns = ["a"]
    with pytest.raises(MissingColumnsError, match=r"\['b', 'c'\]"):
        require_columns(Fake(), ["c", "b", "a"])
