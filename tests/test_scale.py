"""Queries over the large tables join them once, keep only what they read and shuffle lines before copying them."""

import datetime as dt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillsight.operators import boosting, features, logistic
from tillsight.operators import daystates as DS
from tillsight.plans import dashboard_queries as DQ
from tillsight.plans import fixtures as FX
from tillsight.plans import pipeline_queries as PQ
from tillsight.plans import published_queries as WQ
from tillsight.plans import queries as Q


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Seen(Exception):
    pass


def test_histograms_of_a_task(spark):
    """F1, F8, F10: sums by node and bin without a row for each feature, margins brought up to date."""
    y, m = np.array([1.0, 0.0, 1.0, 0.0]), np.array([0.0, 0.5, -1.0, 2.0])
    b = np.array([[0, 1], [1, 1], [2, 0], [0, 0]])
    tree = {1: boosting.Node(1, 1, 1.0, 0, 0, 0.5, 1.0), 2: boosting.Node(1, 2, 1.0, value=0.25), 3: boosting.Node(1, 3, 1.0, value=-0.5)}
    nodes = {1: boosting.Node(2, 1, 1.0, 1, 0, 0.5, 1.0), 2: boosting.Node(2, 2, 1.0), 3: boosting.Node(2, 3, 1.0)}
    whole = pa.record_batch([pa.array(y), pa.array(m), pa.array(b.tolist(), pa.list_(pa.int32()))], names=["y", "m", "b"])
    run = boosting.partial_hists([tree], nodes, [2, 3], [0, 1], 3)
    got = {}
    for out in run(iter([whole.slice(0, 3), whole.slice(3), whole.slice(4)])):
        got |= {(r["node"], r["f"], r["v"]): (r["g"], r["h"]) for r in out.to_pylist()}
    want = {}
    for k in range(4):
        p = 1 / (1 + np.exp(-(m[k] + (0.25 if b[k, 0] <= 0 else -0.5))))
        g, h = int(np.floor((p - y[k]) * boosting.UNIT + 0.5)), int(np.floor(p * (1 - p) * boosting.UNIT + 0.5))
        for f in (0, 1):
            key = (2 if b[k, 1] <= 0 else 3, f, int(b[k, f]))
            old = want.get(key, (0, 0))
            want[key] = (old[0] + g, old[1] + h)
    assert got == want


def test_newton_sums_of_a_task():
    """X'(w(y-p)) and X'WX by group, whatever the batches."""
    rng = np.random.default_rng(5)
    g, y, w, X = rng.integers(0, 3, 50), rng.integers(0, 2, 50).astype(float), rng.random(50), rng.normal(size=(50, 2))
    beta = rng.normal(size=(4, 3))
    whole = pa.record_batch([pa.array(g.astype(np.int32)), pa.array(y), pa.array(w), pa.array(X[:, 0]), pa.array(X[:, 1])], names=["_at", "y", "w", "x1", "x2"])
    out = [r for part in logistic.partial_sums(beta)(iter([whole.slice(0, 7), whole.slice(7, 0), whole.slice(7)])) for r in part.to_pylist()]
    assert [r["g"] for r in out] == [0, 1, 2]                 # group 3 has no rows
    for r in out:
        k = g == r["g"]
        Z = np.column_stack([np.ones(k.sum()), X[k]])
        p = 1 / (1 + np.exp(-Z @ beta[r["g"]]))
        hess = (Z.T * (w[k] * p * (1 - p))) @ Z
        assert np.allclose(r["s"], [*(Z.T @ (w[k] * (y[k] - p))), *hess[np.triu_indices(3)]])


def lines(spark):
    rows = [(c, dt.date(2020, 1, 1) + dt.timedelta(days=(7 * k + n * 31) % 1200), f"{c}-{n}-{k}", "ab"[k % 2], k % 5) for n, c in enumerate(["x", "y", None]) for k in range(120)]
    df = spark.createDataFrame(rows, "customer_name string, sale_date date, source_row_id string, segment_name string, k int")
    money = [F.col("k").cast("decimal(18,4)").alias(c) for c in ("revenue", "profit")]
    return df.select("customer_name", "sale_date", "source_row_id", "segment_name", *money, F.col("k").cast("decimal(18,8)").alias("promo_pct"))


@pytest.mark.parametrize("states", [False, True])
def test_many_snapshots_shuffle_lines_before_they_are_copied(spark, monkeypatch, states):
    """one exchange, by customer and block, below the copies; same rows as by copies first."""
    snaps = features.month_ends("2020-01-01", "2023-06-30")
    assert len(snaps) >= features.MANY_SNAPSHOTS
    s = lines(spark)
    make = (lambda: DS.features_from_states(DS.day_states(s), snaps, 90)) if states else (lambda: features.customer_features(s, snaps, 90))
    got = make()
    text = plan(got)
    assert "hashpartitioning(customer_name" in text and "hashpartitioning(snapshot_date" not in text
    monkeypatch.setattr(features, "MANY_SNAPSHOTS", 10**9)
    want = make()
    assert "hashpartitioning(snapshot_date" in plan(want)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and got.count() > 50


def test_line_items_are_not_shuffled_by_customer(spark, monkeypatch):
    """F3 to F14: orders meet customers before line items do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = FX.sales(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = text.split("\n")
    join = next(k for k, x in enumerate(at) if "Join Inner" in x and "o_custkey" in x)
    depth = at[join].index("Join")
    below = [x for x in at[join + 1:] if len(x) - len(x.lstrip(" :+-")) > depth]
    assert below and not any("l_orderkey" in x for x in below)


def test_late_days_are_not_joined_by_a_shuffle(spark):
    """states and lines meet the asked days, a calendar, without a shuffle by day."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = lines(spark)
        text = plan(DS.refreshed(DS.day_states(s), s.where("revenue = 1"), s))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_loads_read_joined_lines_that_were_written_once(spark, monkeypatch):
    """the batches of a warehouse come from one written table."""
    def seen(*args, **kw):
        raw = next(a for a in args if hasattr(a, "inputFiles"))
        assert raw.inputFiles() and all("/tables/sales-" in f for f in raw.inputFiles())
        raise Seen
    monkeypatch.setattr(PQ.PL, "stage_batch", seen)
    monkeypatch.setattr(WQ, "load_batch", seen)
    for make in (PQ._warehouse, WQ.warehouse_with_failures):
        with pytest.raises(Seen):
            make(spark, SF_SMALL)


def test_keys_and_features_read_written_tables(spark):
    """figures that are read several times do not join the source tables again."""
    assert not any("lineitem" in f for f in DQ.q_score_date_keys(spark, SF_SMALL).inputFiles())
    assert all("/tables/sales-" in f for f in FX.sales_lines(spark, SF_SMALL).inputFiles())


def test_kept_staging_holds_only_what_the_query_reads(spark):
    """F12, F13, F14."""
    for q in (Q.q_upsert, Q.q_reconciliation, Q.q_reconciliation_by_batch):
        kept = [x for x in plan(q(spark, SF_SMALL)).split("\n") if "InMemoryRelation" in x]
        assert kept and not any("import_amount" in x or "promo_quantity" in x for x in kept)
