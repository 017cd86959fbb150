"""Bottom-k near copies against brute force on edge rows."""

import random
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import bottom_k

from . import brute
from .conftest import SCHEMA, prose


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    sets = [(i, brute.shingles(lowered(t), 3)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, s) in enumerate(known):
        for j, t in known[:a]:
            both = len(s & t)
            if 100 * both >= 85 * (len(s) + len(t) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return sorted((-1 if i is None else i, len(s), None if i is None else root(i), None if i is None else root(i) == i) for i, s in sets)


def found(df):
    got = bottom_k.near_copies(df).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", "k", 1, "c", "n") for i, t in rows], SCHEMA).repartition(3)


def test_edge_rows(docs, rows, no_docs):
    assert found(docs) == expected(rows)
    assert bottom_k.near_copies(no_docs).count() == 0


@pytest.fixture(scope="module")
def crowd():
    """A chain in which only neighbours link, a large group around one base, boilerplate in all, small sets, cases, one id for two texts."""
    rng = random.Random(11)
    boiler, base, words, rows = prose(rng, 40, 9000), prose(rng, 300, 9000), prose(rng, 260, 9000), []
    for k in range(30):
        words = words[4:] + [f"n{k}a", f"n{k}b", f"n{k}c", f"n{k}d"]
        rows.append((500 - k, " ".join(words)))
    for k in range(90):
        near = list(base)
        for _ in range(rng.randrange(1, 12)):
            near[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((600 + k, " ".join(near)))
    for k in range(60):
        rows.append((800 + k, " ".join(boiler + prose(rng, rng.choice([5, 20, 200]), 9000))))
    for k in range(40):
        rows.append((900 + k, " ".join(prose(rng, rng.randrange(1, 9), 3))))
    rows += [(1000, "ALPHA Beta gamma É"), (1001, "alpha beta GAMMA É"), (1002, "alpha beta gamma é"), (1003, "solo"), (1004, "SOLO solo")]
    rows += [(1100, rows[0][1]), (1100, rows[40][1]), (3, rows[70][1])]
    return rows


def test_chains_crowds_and_boilerplate(spark, crowd):
    assert found(frame(spark, crowd)) == expected(crowd)


def test_block_sizes_do_not_change_results(spark, crowd, monkeypatch):
    monkeypatch.setattr(bottom_k, "BLOCK", 7)
    monkeypatch.setattr(bottom_k, "SLICE", 64)
    assert found(frame(spark, crowd)) == expected(crowd)


def test_needed_values_keep_the_miss_rate():
    t = bottom_k.seen_of_union()
    assert sum(comb(64, k) * .85**k * .15**(64 - k) for k in range(t)) <= 1e-9 < sum(comb(64, k) * .85**k * .15**(64 - k) for k in range(t + 1))


def test_estimate_agrees_in_and_out_of_spark(spark):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, n, n, dtype=np.uint64)) for n in (1, 5, 60, 64, 100, 400) for _ in range(4)]
    inside = bottom_k.possible(sets, sets)
    rows = [(i, j, [int(x) for x in a[:64]], [int(x) for x in b[:64]]) for i, a in enumerate(sets) for j, b in enumerate(sets)]
    got = spark.createDataFrame(rows, "i int, j int, a array<long>, b array<long>").select("i", "j", bottom_k.may_link(F.col("a"), F.col("b")).alias("ok")).collect()
    assert all(inside[r.i, r.j] or not r.ok for r in got)      # a tile keeps at least those
    assert 0 < sum(r.ok for r in got) <= inside.sum() < inside.size
    both = bottom_k.overlaps(sets, sets)
    assert all(both[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets))
    sizes = np.array([len(s) for s in sets])
    assert not (~inside & (100 * both >= 85 * (sizes[:, None] + sizes[None, :] - both))).any()
