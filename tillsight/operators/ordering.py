"""Global running totals and numbering without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` pulls every row into one
task. Here rows are first assigned to ordered buckets (value quantiles for
numeric keys, hash buckets for numbering), each bucket gets the total of
all buckets before it (a window over at most ``n`` rows, broadcast back),
and the running value inside a bucket is an ordinary partitioned window.
The result is exact and deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile_bounds(df: DataFrame, key: str, buckets: int, rel_error: float = 0.001) -> list[float]:
    """Up to ``buckets - 1`` distinct cut points of ``key`` (small driver result)."""
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    qs = df.approxQuantile(key, probs, rel_error)
    return sorted({float(q) for q in qs if q is not None})


def desc_bucket(key: Column, bounds: Sequence[float]) -> Column:
    """Bucket index such that a larger key never lands in a later bucket."""
    if not bounds:
        return F.lit(0)
    if len(bounds) > 64:
        return F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b > key))
    # number of cut points above the key; plain comparisons stay in codegen
    terms = [(F.lit(float(b)) > key).cast("int") for b in bounds]
    return sum(terms[1:], terms[0])


def running_sums(df: DataFrame, bucket: Column, order: Sequence[Column],
                 sum_cols: Sequence[str], prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows up to this one in (bucket, order).

    ``bucket`` must be consistent with ``order`` (rows of bucket i come
    before rows of bucket i+1). Rows with equal order keys are summed in an
    unspecified but fixed order; callers pass unique order keys.
    """
    d = df.withColumn("_bkt", bucket)
    tot = d.groupBy("_bkt").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sum_cols)])
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_bkt", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
                               for i in range(len(sum_cols))])
    upto = (Window.partitionBy("_bkt").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # ``off`` has one row per bucket: its size is bounded by the bucket count.
    j = d.join(F.broadcast(off), "_bkt")
    return j.select(*df.columns, *[(F.sum(c).over(upto) + F.col(f"_o{i}")).alias(prefix + c)
                                   for i, c in enumerate(sum_cols)])


def running_sums_desc(df: DataFrame, key: str, sum_cols: Sequence[str], buckets: int | None = None,
                      prefix: str = "cum_") -> DataFrame:
    """Running sums in descending ``key`` order (``key`` unique per row), in as many buckets as the
    session has shuffle partitions."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = quantile_bounds(df, key, buckets)
    return running_sums(df, desc_bucket(F.col(key), bounds), [F.col(key).desc()], sum_cols, prefix)


def number_rows(df: DataFrame, order: Sequence[str], start: int | Column = 1,
                buckets: int | None = None, name: str = "row_index") -> DataFrame:
    """Distinct consecutive integers ``start, start+1, ...`` for unique rows.

    Rows are numbered in (hash bucket of ``order``, ``order``) order: stable
    for the same input and bucket count, spread over ``buckets`` tasks (the
    session's shuffle partitions by default, so it follows the cluster).
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets))
    one = df.withColumn("_one", F.lit(1))
    out = running_sums(one, bucket, [F.col(c) for c in order], ["_one"], prefix="_n")
    s = start if isinstance(start, Column) else F.lit(start)
    return out.withColumn(name, (F.col("_n_one") - 1 + s).cast("long")).drop("_one", "_n_one")
