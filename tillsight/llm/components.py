"""Connected components of an edge table by alternating large-star and small-star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = down.join(_least(down), "u")
    return (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(u - v)")).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, v``: every node but the least of its component, with that least node.

    ``edges`` has long columns ``u`` and ``v``; null ends and loops are dropped. Each round is written to
    the shared checkpoint folder, so a lost executor repeats one round at most.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    mark = _mark(now)
    for _ in range(rounds):
        now = written(_small_star(_large_star(now)), "stars")
        before, mark = mark, _mark(now)
        if mark == before:
            return now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
