"""Newton logistic, calibration, stratified folds and boosted trees against plain numpy."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.operators import boosting, folds, logistic


def newton_by_hand(X, y, w, C, penalty, steps=40, start=None):
    X = np.column_stack([np.ones(len(y)), X])
    beta = np.array(start if start is not None else np.zeros(X.shape[1]), float)
    pen = np.diag([0.0] + [penalty] * (X.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-X @ beta))
        beta = beta + np.linalg.solve(C * (X.T * (w * p * (1 - p))) @ X + pen, C * X.T @ (w * (y - p)) - pen @ beta)
    return beta


def test_newton_fits_every_group_at_once(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for g, n in (("a", 400), ("b", 37), (None, 60)):
        X = rng.normal(size=(n, 2)) * [1, 50] + [0, 10]
        y = (rng.random(n) < 1 / (1 + np.exp(-X[:, 0]))).astype(int)
        w = np.where(y == 1, 2.0, 1.0)
        want[g] = newton_by_hand(X, y, w, 0.5, 1.0)
        rows += [(g, float(a), float(b), int(t)) for (a, b), t in zip(X, y)]
    rows += [("a", 1.0, 2.0, None)]                        # a row without a label takes no part
    df = spark.createDataFrame(rows, "g string, u double, v double, y int").repartition(5)
    got = logistic.newton(df, {"u": F.col("u"), "v": F.col("v")}, F.col("y"), "g", F.when(F.col("y") == 1, 2.0).otherwise(1.0), C=0.5)
    assert set(got.values) == set(want)
    for g in want:
        assert np.allclose(got.values[g], want[g], atol=1e-7)
    p = logistic.with_margin(df, got, [F.col("u"), F.col("v")], "m").where("g = 'b'").select("u", "v", "m").first()
    assert math.isclose(p.m, want["b"] @ [1, p.u, p.v], abs_tol=1e-6)
    assert logistic.newton(df.limit(0), {"u": F.col("u")}, F.col("y"), "g").values == {}


def test_a_group_without_a_model_gets_no_score(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 1), ("a", 0.5, 1), ("b", 1.0, 1)], "g string, x double, y int")
    fitted = logistic.newton(df.where("g = 'a'"), {"x": F.col("x")}, F.col("y"), "g")
    got = logistic.with_margin(df, fitted, [F.col("x")], "m").select("g", logistic.probability(F.col("m")).alias("p")).collect()
    assert all((r["p"] is None) == (r["g"] == "b") for r in got)


def test_platt_by_fold(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for g in range(3):
        s = np.round(rng.random(80), 2)
        y = (rng.random(80) < s).astype(int)
        p, q = y.sum(), 80 - y.sum()
        t = np.where(y == 1, (p + 1) / (p + 2), 1 / (q + 2))
        want[g] = newton_by_hand(s[:, None], t, np.ones(80), 1.0, 0.0, start=[math.log((p + 1) / (q + 1)), 0.0])
        rows += [(g, float(a), int(b)) for a, b in zip(s, y)]
    got = logistic.platt(spark.createDataFrame(rows, "g int, s double, y int"), F.col("s"), F.col("y"), "g")
    assert all(np.allclose(got.values[g], want[g], atol=1e-7) for g in want)


@pytest.mark.parametrize("n,k", [(0, 3), (1, 3), (2, 3), (100, 3), (101, 5), (102, 7)])
def test_folds_are_exact_and_stratified(spark, n, k):
    rng = random.Random(n)
    rows = [(f"c{rng.randrange(10**9):010d}", rng.choice([0, 1, 1])) for _ in range(n)] + [("none", None)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "key string, y int, fold string").repartition(4)
    got = {r["key"]: r["f"] for r in folds.stratified_folds(df, "y", ["key"], k, "f").collect()}
    assert got.pop("none") is None
    ordered = sorted(b for _, b in rows[:-1])
    for c in {0, 1}:
        mine = sorted(a for a, b in rows[:-1] if b == c)
        sizes = [sum(1 for x in ordered[i::k] if x == c) for i in range(k)]
        want = [f for f, m in enumerate(sizes) for _ in range(m)]
        assert [got[a] for a in mine] == want
        assert max(sizes) - min(sizes) <= 1


def boosted_by_hand(X, y, keys, names, p):
    U, n = boosting.UNIT, len(y)
    cuts = [sorted({sorted(X[:, f])[max(0, math.ceil(n * i / p.bins) - 1)] for i in range(1, p.bins)}) for f in range(X.shape[1])]
    m, trees = np.zeros(n), []

    def shrink(g):
        return math.copysign(max(abs(g) - p.l1, 0.0), g)

    for t in range(1, p.rounds + 1):
        use = sorted(sorted(range(len(names)), key=lambda k: hashlib.md5(f"{p.seed}:{t}:{names[k]}".encode()).hexdigest())[:max(1, int(p.columns * len(names)))])
        drawn = np.array([int(hashlib.md5(f"{p.seed}:{t}:{k}".encode()).hexdigest()[:7], 16) < int(p.rows * 16**7) for k in keys])
        prob = 1 / (1 + np.exp(-m))
        g, h = np.floor((prob - y) * U + 0.5) / U, np.floor(prob * (1 - prob) * U + 0.5) / U
        add = np.zeros(n)

        def grow(rows, depth, k):
            G, H = g[rows & drawn].sum(), h[rows & drawn].sum()
            best = (boosting.LEAST_GAIN, None)
            for f in use if depth < p.depth else []:
                for c in cuts[f]:
                    left = rows & drawn & (X[:, f] <= c)
                    a, b = g[left].sum(), h[left].sum()
                    if b >= p.min_weight and H - b >= p.min_weight:
                        gain = shrink(a) ** 2 / (b + p.l2) + shrink(G - a) ** 2 / (H - b + p.l2) - shrink(G) ** 2 / (H + p.l2)
                        if gain > best[0] + 1e-12:
                            best = (gain, f, c)
            if best[1] is None:
                trees.append((t, k, None, -p.rate * shrink(G) / (H + p.l2)))
                add[rows] = trees[-1][3]
                return
            trees.append((t, k, names[best[1]], best[2]))
            grow(rows & (X[:, best[1]] <= best[2]), depth + 1, 2 * k)
            grow(rows & (X[:, best[1]] > best[2]), depth + 1, 2 * k + 1)

        grow(np.ones(n, bool), 0, 1)
        m = m + add
    return trees, 1 / (1 + np.exp(-m))


@pytest.mark.parametrize("depth", [2, 3])
def test_boosted_trees_equal_plain_numpy(spark, depth):
    rng = np.random.default_rng(7)
    X = np.column_stack([rng.normal(size=300), rng.integers(0, 4, 300), rng.random(300) * 1e6, rng.integers(0, 2, 300)]).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(X[:, 0] + X[:, 1] - 1.5)))).astype(int)
    keys, names = [f"k{i}" for i in range(300)], ["a", "b", "c", "d"]
    p = boosting.Params(rounds=14, depth=depth, bins=8, columns=0.8, stride=5)
    df = spark.createDataFrame([(k, int(t), *map(float, x)) for k, t, x in zip(keys, y, X)], "k string, y int, a double, b double, c double, d double")
    cols = [F.col(n) for n in names]
    model = boosting.fit(df.repartition(3), cols, names, F.col("y"), F.col("k"), p)
    trees, prob = boosted_by_hand(X, y, keys, names, p)
    got = sorted((n.round, n.node, None if n.feature < 0 else names[n.feature], n.value if n.feature < 0 else n.cut) for n in model.nodes)
    want = sorted(trees, key=lambda r: r[:2])
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-9)
    out = {r["k"]: r["churn_prob"] for r in model.transform(df, cols).collect()}
    assert np.allclose([out[k] for k in keys], prob, atol=1e-9)
    again = boosting.fit(df.repartition(7), cols, names, F.col("y"), F.col("k"), p)
    assert again.nodes == model.nodes                         # fixed-point sums: the same whatever the partitions


def test_boosting_on_odd_rows(spark):
    rows = [(f"k{i}", i % 2, float(i % 2)) for i in range(60)] + [("n", 1, None), ("z", 0, math.nan), ("i", 0, math.inf), (None, 1, 1.0), ("u", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, y int, x double")
    model = boosting.fit(df, [F.col("x")], ["x"], F.col("y"), F.col("k"), boosting.Params(rounds=3, columns=1.0))
    out = {r["k"]: r["churn_prob"] for r in model.transform(df, [F.col("x")]).collect()}
    assert out["k1"] > 0.5 > out["k0"] and out["n"] == out["z"] == out["i"] == out["k0"]
    empty = boosting.fit(df.limit(0), [F.col("x")], ["x"], F.col("y"), F.col("k"), boosting.Params(rounds=2))
    assert {r["churn_prob"] for r in empty.transform(df, [F.col("x")]).collect()} == {0.5}
