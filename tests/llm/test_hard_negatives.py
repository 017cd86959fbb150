"""Hard negatives against brute force on edge rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tillsight.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, key long, block string, n long, q string, slot string, held string, limits string"


def brute(rows):
    def take(x):
        return math.floor(x * 256) if abs(x) < 2.0**900 else int(x) * 256
    held = [(i, y, [take(x) for x in v]) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, v in held:
        if i % 100:
            continue
        score = [(max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j, z) for j, z, w in held if j != i]
        score.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in score if s[2] == y][:5]:
            near = [s for s in score if s[2] != y and 80 * p <= 100 * s[0] <= 100 * p][:5]
            out += [(i, pid, r, n[1], p, n[0]) for r, n in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(i, y, v, 1, "b", 2, "q", "s", "h", "l") for i, y, v in rows], SCHEMA).repartition(3)
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, F.col("vec_id"), F.col("label"), F.col("embedding"))
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def points(rng, n, dims=6):
    return [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(n)]


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(k, rng.randrange(3), v) for k, v in enumerate(points(rng, 500))]
    rows += [(1000 + k, k % 3, rows[100][2]) for k in range(300)]                       # one vector in a third of all rows
    rows += [rows[7], rows[7], (100, 2, rows[3][2])]                                    # repeated rows, two unlike rows under an anchor's id
    rows += [(None, 1, [1.0] * 6), (2000, None, [1.0] * 6), (2001, 1, None), (2002, 1, [1.0, None]), (2003, 1, [math.nan] * 6),
             (2100, 1, [math.inf] * 6), (2200, 1, []), (2300, 2, [1.0, 2.0]), (2301, 2, [-1.0]), (2400, 0, [0.0] * 6), (-100, 1, [-3.0] * 6)]
    assert mined(spark, rows) == brute(rows)


def test_wide_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, k % 2, [x * 10.0**rng.randrange(0, 7) for x in v]) for k, v in enumerate(points(rng, 220))]
    rows += [(900, 1, [1e300, 1e308, 1.0, 0.0, 0.0, 0.0]), (901, 0, [1e3] * 6)]
    assert mined(spark, rows) == brute(rows)


def test_few_rows_and_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.9]), (3, 2, [0.1])]
    assert mined(spark, rows) == brute(rows) != []


def test_blocks_do_not_change_results(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, rng.randrange(4), v) for k, v in enumerate(points(rng, 900))]
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    monkeypatch.setattr(hard_negatives, "TILE", 64)
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("k", [1, 3])
def test_first_of_each_group(k):
    import numpy as np
    g, s, i = np.array([0, 0, 1, 0, 1]), np.array([5, 5, 1, 9, 2]), np.array([4, 3, 1, 9, 7])
    assert sorted(hard_negatives.first(g, s, i, k)) == ([3, 4] if k == 1 else [0, 1, 2, 3, 4])
