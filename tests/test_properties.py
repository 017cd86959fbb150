"""Property checks: distributed metrics against brute force, invariants."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.operators import evaluation as EV
from tillsight.operators.ordering import number_rows, running_sums_desc


def brute(probs, labels, t):
    pred = probs >= t
    tp = int(np.sum(pred & (labels == 1)))
    fp = int(np.sum(pred & (labels == 0)))
    fn = int(np.sum(~pred & (labels == 1)))
    prec = tp / (tp + fp) if tp + fp else 0.0
    rec = tp / (tp + fn) if tp + fn else 0.0
    f2 = 5 * tp / (5 * tp + 4 * fn + fp) if (5 * tp + 4 * fn + fp) else 0.0
    return tp, fp, fn, prec, rec, f2


def brute_auc(probs, labels):
    pos, neg = probs[labels == 1], probs[labels == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(probs, labels):
    order = np.argsort(-probs, kind="stable")
    ps, ls = probs[order], labels[order]
    P = ls.sum()
    ap, tp, fp, i = 0.0, 0, 0, 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            j += 1
        dtp = int(ls[i:j].sum())
        tp += dtp
        fp += (j - i) - dtp
        ap += (dtp / P) * (tp / (tp + fp))
        i = j
    return ap


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        y = rng.random() < 0.4
        p = round(min(1.0, max(0.0, rng.gauss(0.6 if y else 0.4, 0.2))), 2)  # ties on purpose
        rows.append((f"c{i}", p, int(y)))
    df = spark.createDataFrame(rows, "customer_name string, churn_prob double, churn_label int")
    probs = np.array([r[1] for r in rows])
    labels = np.array([r[2] for r in rows])
    return df, probs, labels


def test_sweep_matches_brute_force(scored):
    df, probs, labels = scored
    sweep = EV.threshold_sweep(df, buckets=7).collect()
    grid = set(EV.threshold_grid()) | set(probs.tolist())
    assert len(sweep) == len(grid)
    for r in sweep:
        tp, fp, fn, prec, rec, f2 = brute(probs, labels, r["threshold"])
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn)
        assert r["precision"] == pytest.approx(prec) and r["recall"] == pytest.approx(rec)
        assert r["f2"] == pytest.approx(f2)


def test_auc_ap_match_brute_force(scored):
    df, probs, labels = scored
    m = EV.ranking_metrics(df, buckets=5).first()
    assert m["roc_auc"] == pytest.approx(brute_auc(probs, labels), abs=1e-12)
    assert m["average_precision"] == pytest.approx(brute_ap(probs, labels), abs=1e-12)


def test_auc_invariant_under_monotone_transform(scored):
    df, _, _ = scored
    a = EV.ranking_metrics(df).first()["roc_auc"]
    b = EV.ranking_metrics(df.withColumn("churn_prob", F.col("churn_prob") * 0.5 + 0.1)).first()["roc_auc"]
    assert a == pytest.approx(b, abs=1e-12)


def test_choose_threshold_feasible_and_fallback(scored):
    df, _, _ = scored
    sweep = EV.threshold_sweep(df)
    best = EV.choose_threshold(sweep, max_urgent=1000, min_recall=0.5).first()
    assert best["feasible"] and best["recall"] >= 0.5
    rows = [r for r in sweep.collect() if r["recall"] >= 0.5]
    top = max(rows, key=lambda r: (r["f2"], r["precision"], r["threshold"]))
    assert best["threshold"] == top["threshold"]
    none = EV.choose_threshold(sweep, min_recall=1.1).first()
    assert not none["feasible"]
    top2 = max(sweep.collect(), key=lambda r: (r["f2"], r["recall"], r["precision"], -r["threshold"]))
    assert none["threshold"] == top2["threshold"]


def test_confusion_no_positive_predictions(scored):
    df, _, _ = scored
    c = EV.confusion(df, 2.0).first()
    assert (c["tp"], c["fp"], c["precision"], c["recall"], c["f2"]) == (0, 0, 0.0, 0.0, 0.0)


def test_running_sums_equal_single_window(spark):
    rng = random.Random(3)
    rows = [(float(i) + rng.random() / 2, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k double, v long")
    got = {r["k"]: r["cum_v"] for r in running_sums_desc(df, "k", ["v"], buckets=9).collect()}
    acc, want = 0, {}
    for k, v in sorted(rows, key=lambda x: -x[0]):
        acc += v
        want[k] = acc
    assert got == want


def test_number_rows_unique_consecutive(spark):
    df = spark.createDataFrame([(f"n{i}",) for i in range(300)], "name string")
    ids = sorted(r["row_index"] for r in number_rows(df, ["name"], 11, buckets=13).collect())
    assert ids == list(range(11, 311))
