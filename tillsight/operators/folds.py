"""Exact stratified folds in row order, without a one-task sort.

Of ``n`` rows sorted by class, fold *i* owns the places *i*, *i* + folds, ...; so each fold's share of a class is known
from the class counts, and within a class the first rows in key order get fold 0, the next fold 1 and so on. Sizes differ
by at most one a class. The rank of a row within its class comes from range buckets of the key and their offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.session import materialize


def allocation(counts: Sequence[int], folds: int) -> list[list[int]]:
    """``[class][fold]``: rows of the class in the fold."""
    out, start = [], 0
    for n in counts:
        out.append([len(range(start + (i - start) % folds, start + n, folds)) for i in range(folds)])
        start += n
    return out


def rank_within(df: DataFrame, group: Column, key: Sequence[str], name: str = "rank") -> DataFrame:
    """Exact rank (from 0) in ``key`` order within ``group``; (group, key) must be unique for a fixed result.

    Rows are range-partitioned by (group, key) into a written table; each partition learns how many rows of the group lie
    in those before it (a table of partitions x groups) and numbers its own.
    """
    ordered = df.withColumn("_group", group).repartitionByRange("_group", *[F.col(c) for c in key])
    dealt = materialize(ordered.withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_group").alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_group", "_part").orderBy(*key))
    # one row a group and partition of the range shuffle: bounded by the session's partition count
    joined = dealt.withColumn("_place", place).join(F.broadcast(offsets), F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(name, (F.col("_before") + F.col("_place") - 1).cast("long")).drop("_group", "_part", "_g", "_p", "_before", "_place")


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], folds: int = 3, name: str = "fold") -> DataFrame:
    """``df`` with its fold (0 to ``folds`` - 1); rows without a label get none."""
    counts = {r[0]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(counts)
    ranked = rank_within(df, F.col(label), key, "_rank")
    fold = F.lit(None).cast("int")
    for c, sizes in zip(classes, allocation([counts[c] for c in classes], folds)):
        end, at = 0, F.lit(folds - 1)
        cuts = []
        for n in sizes:
            end += n
            cuts.append(end)
        for i in reversed(range(folds - 1)):
            at = F.when(F.col("_rank") < cuts[i], F.lit(i)).otherwise(at)
        fold = F.when(F.col(label) == F.lit(c), at).otherwise(fold)
    return ranked.withColumn(name, fold.cast("int")).drop("_rank")
