"""Point-in-time customer features and churn labels for many snapshots at once.

A sale on day ``d`` belongs to snapshot ``s`` when ``s - L < d <= s``,
i.e. ``d <= s < d + L``. Each sale is exploded only to the snapshots whose
lookback holds it (at most ceil(L / snapshot spacing) copies), then one
``groupBy(snapshot_date, customer_name)`` computes every feature. For few
snapshots partial aggregation runs map-side, so a customer holding a third
of all rows costs one partial row per map task, not a hot reducer. For many
(``MANY_SNAPSHOTS``) lines are shuffled once by customer and block of
snapshots and copied to snapshots only behind the shuffle; that customer is
then spread over as many tasks as there are blocks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.functions.columns import safe_ratio

DateLike = str | dt.date


def _as_date(d: DateLike) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def month_ends(first: DateLike, last: DateLike) -> list[dt.date]:
    """Every month end from the month of ``first`` to the month of ``last``."""
    a, b = _as_date(first), _as_date(last)
    out, y, m = [], a.year, a.month
    while (y, m) <= (b.year, b.month):
        ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
        out.append(dt.date(ny, nm, 1) - dt.timedelta(days=1))
        y, m = ny, nm
    return out


def default_label_window(snapshot: DateLike) -> tuple[dt.date, dt.date]:
    """Day after the snapshot through the end of that day's month."""
    start = _as_date(snapshot) + dt.timedelta(days=1)
    nxt = dt.date(start.year + (start.month == 12), start.month % 12 + 1, 1)
    return start, nxt - dt.timedelta(days=1)


# Largest (snapshot, day) calendar table that is broadcast; beyond it the
# join is left to AQE (shuffle join on the sale date).
MAX_BROADCAST_DAYS = 2_000_000


def snapshot_days(spark, windows: Sequence[tuple]) -> DataFrame:
    """One row per (snapshot_date, _day) for ``_day`` in each snapshot's [first, last] window.

    The size is the sum of window lengths: fixed by the parameters, never
    by the data.
    """
    base = spark.createDataFrame([(s, a, b) for s, a, b in windows],
                                 "snapshot_date date, _a date, _b date")
    return base.select("snapshot_date", F.explode(F.sequence("_a", "_b")).alias("_day"))


def _join_days(sales: DataFrame, windows: Sequence[tuple]) -> DataFrame:
    """Sales joined to every window holding their date (equi-join on the day)."""
    n_days = sum((b - a).days + 1 for _, a, b in windows)
    days = snapshot_days(sales.sparkSession, windows)
    if n_days <= MAX_BROADCAST_DAYS:
        days = F.broadcast(days)
    lo, hi = min(a for _, a, _ in windows), max(b for _, _, b in windows)
    d = F.col("sale_date")
    return (sales.filter((d >= F.lit(lo)) & (d <= F.lit(hi)))
            .join(days, d == F.col("_day")).drop("_day"))


def explode_to_snapshots(sales: DataFrame, snapshots: Sequence[DateLike],
                         lookback: int = K.LOOKBACK_DAYS) -> DataFrame:
    """One row per (sale, snapshot whose lookback window holds the sale).

    A range condition ``s - L < d <= s`` becomes an equi-join on the sale
    date against the (snapshot, day) calendar: whole-stage codegen, no
    per-row loop over the snapshot list, and a filter on the date range
    that reaches the Parquet scan.
    """
    snaps = sorted({_as_date(s) for s in snapshots})
    wins = [(s, s - dt.timedelta(days=lookback - 1), s) for s in snaps]
    return _join_days(sales, wins)


# From this many snapshots on, lines are shuffled before they are copied to snapshots.
MANY_SNAPSHOTS = 24
# Snapshots of a block: a line goes to each block whose windows hold it.
BLOCK = 12


def snapshot_lines(lines: DataFrame, snapshots: Sequence[DateLike], lookback: int = K.LOOKBACK_DAYS,
                   labels: Sequence[tuple] = ()) -> tuple[DataFrame, list[str]]:
    """``explode_to_snapshots`` and the columns to group its rows by: snapshot, customer and, with many snapshots, ``_block``.

    A (snapshot, customer) group holds few lines of a customer, so partial sums save nothing there, and copied lines with
    their sums would make a multiple of the lines' own shuffle. Rows come shuffled by customer and block, which the
    grouping needs no further shuffle for.

    With ``labels`` (``_label_windows``) a line also goes to the snapshots whose label window holds it, without its date,
    as ``_label_day``; that needs many snapshots.
    """
    snaps = sorted({_as_date(s) for s in snapshots})
    keys = ["snapshot_date", "customer_name"]
    if len(snaps) < MANY_SNAPSHOTS:
        return explode_to_snapshots(lines, snaps, lookback), keys
    spark, back = lines.sparkSession, dt.timedelta(days=lookback - 1)
    wins = [(s, s - back, s, i // BLOCK) for i, s in enumerate(snaps)]
    wins = [(*w, False) for w in wins] + [(s, a, b, snaps.index(s) // BLOCK, True) for s, a, b in labels if a <= b]
    held = spark.createDataFrame(wins, "snapshot_date date, _a date, _b date, _block int, _is_label boolean").select(
        "snapshot_date", "_block", "_is_label", F.explode(F.sequence("_a", "_b")).alias("_day"))
    days = spark.createDataFrame(_spans((block, a, b) for _, a, b, block, _ in wins), "_block int, _a date, _b date").select(
        "_block", F.explode(F.sequence("_a", "_b")).alias("_day"))
    if sum((b - a).days + 1 for _, a, b, *_ in wins) <= MAX_BROADCAST_DAYS:
        days, held = F.broadcast(days), F.broadcast(held)
    d = F.col("sale_date")
    blocked = (lines.filter((d >= F.lit(min(a for _, a, *_ in wins))) & (d <= F.lit(max(b for _, _, b, *_ in wins))))
               .join(days, d == F.col("_day")).drop("_day").repartition("customer_name", "_block"))
    copies = blocked.join(held.withColumnRenamed("_block", "_b"), (F.col("_block") == F.col("_b")) & (d == F.col("_day"))).drop("_b", "_day")
    if not labels:
        return copies.drop("_is_label"), [*keys, "_block"]
    is_label = F.col("_is_label")
    return copies.withColumn("_label_day", F.when(is_label, d)).withColumn("sale_date", F.when(~is_label, d)).drop("_is_label"), [*keys, "_block"]


def _spans(windows: Iterable[tuple]) -> list[tuple]:
    """(block, first, last) windows with those of a block that meet or overlap made one: no day of a block comes twice."""
    out: list[tuple] = []
    for block, a, b in sorted(windows):
        if out and out[-1][0] == block and a <= out[-1][2] + dt.timedelta(days=1):
            out[-1] = (block, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((block, a, b))
    return out


def active_months(d: Column, s: Column, lookback: int) -> Column:
    """Distinct calendar months with a sale in the lookback window (exact).

    Months are counted as bits of a long: a sale sets the bit of its month
    offset from the snapshot month (0 .. lookback/28 + 1), ``bit_or``
    merges map-side and ``bit_count`` reads the result. This keeps the
    whole feature aggregate to one partial aggregation and one exchange; a
    ``count_distinct`` would add a second shuffle on (key, month). Longer
    lookbacks than 63 months fall back to ``count_distinct``.
    """
    if lookback // 28 + 2 > 63:
        return F.count_distinct(F.year(d) * 100 + F.month(d))
    offset = (F.year(s) * 12 + F.month(s)) - (F.year(d) * 12 + F.month(d))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), offset.cast("int"))
    return F.bit_count(F.bit_or(bit)).cast("long")


def customer_features(sales: DataFrame, snapshots: Sequence[DateLike],
                      lookback: int = K.LOOKBACK_DAYS, trend_mode: str = "zero_fill",
                      segment_scope: str = "window") -> DataFrame:
    """Customer snapshot table: one row per (snapshot_date, customer_name).

    trend_mode: ``zero_fill`` = recent minus older revenue with a missing
    side counted as 0; ``both_windows`` = 0 unless the customer bought in
    both the recent and the older window.
    segment_scope: ``window`` = segment of the latest sale in the lookback
    (ties by source_row_id); ``history`` = latest non-null segment over all
    history up to the snapshot.
    """
    if trend_mode not in ("zero_fill", "both_windows"):
        raise ValueError(f"unknown trend_mode {trend_mode!r}")
    if segment_scope not in ("window", "history"):
        raise ValueError(f"unknown segment_scope {segment_scope!r}")
    base = (sales
            .select("customer_name", "sale_date", "revenue", "profit", "promo_pct",
                    "segment_name", "source_row_id")
            .filter(F.col("customer_name").isNotNull() & F.col("sale_date").isNotNull()))
    return _features(*snapshot_lines(base, snapshots, lookback), sales, snapshots, lookback, trend_mode, segment_scope)


def labeled_features(sales: DataFrame, snapshots: Sequence[DateLike], lookback: int = K.LOOKBACK_DAYS,
                     windows: Mapping[DateLike, tuple[DateLike, DateLike]] | None = None) -> DataFrame:
    """``with_churn_label`` of ``customer_features``; for many snapshots both come from one shuffle of the lines, which are read once."""
    snaps = sorted({_as_date(x) for x in snapshots})
    if len(snaps) < MANY_SNAPSHOTS:
        return with_churn_label(customer_features(sales, snaps, lookback), sales, snaps, windows)
    base = (sales
            .select("customer_name", "sale_date", "revenue", "profit", "promo_pct",
                    "segment_name", "source_row_id")
            .filter(F.col("customer_name").isNotNull() & F.col("sale_date").isNotNull()))
    x, keys = snapshot_lines(base, snaps, lookback, _label_windows(snaps, windows))
    return _features(x, keys, sales, snaps, lookback)


def _features(x: DataFrame, keys: Sequence[str], sales: DataFrame, snapshots: Sequence[DateLike], lookback: int,
              trend_mode: str = "zero_fill", segment_scope: str = "window") -> DataFrame:
    """Features of the groups of ``snapshot_lines``. Lines of a label window have no date, so they count for the label alone."""
    labels = "_label_day" in x.columns
    s, d = F.col("snapshot_date"), F.col("sale_date")
    money = (lambda c: F.when(d.isNotNull(), F.col(c))) if labels else F.col
    recent = d > F.date_sub(s, K.TREND_RECENT_DAYS)
    older = (d <= F.date_sub(s, K.TREND_RECENT_DAYS)) & (d > F.date_sub(s, K.TREND_OLDER_DAYS))
    zero = F.lit(0).cast("decimal(18,4)")
    agg = x.groupBy(*keys).agg(
        F.max(d).alias("_last"),
        F.min(d).alias("_first"),
        F.count(d).alias("frequency"),
        F.sum(money("revenue")).alias("_rev"),
        F.sum(money("profit")).alias("_profit"),
        F.sum(F.coalesce(money("promo_pct"), F.lit(0))).alias("_promo"),
        F.sum(F.when(recent, F.col("revenue")).otherwise(zero)).alias("_recent"),
        F.sum(F.when(older, F.col("revenue")).otherwise(zero)).alias("_older"),
        F.count_if(recent).alias("_n_recent"),
        F.count_if(older).alias("_n_older"),
        active_months(d, s, lookback).alias("active_months"),
        F.max_by("segment_name", F.struct(d, F.col("source_row_id"))).alias("segment"),
        *([F.max("_label_day").alias("_bought")] if labels else []),
    )
    if labels:
        agg = agg.where("frequency > 0")
    trend = (F.col("_recent") - F.col("_older")).cast("double")
    if trend_mode == "both_windows":
        trend = F.when((F.col("_n_recent") > 0) & (F.col("_n_older") > 0), trend).otherwise(F.lit(0.0))
    out = agg.select(
        "snapshot_date", "customer_name", "segment",
        F.datediff(s, F.col("_last")).alias("recency"),
        "frequency",
        safe_ratio(F.col("_rev"), F.col("frequency")).alias("aov"),
        safe_ratio(F.col("_promo"), F.col("frequency")).alias("promo_rate"),
        safe_ratio(F.col("_profit"), F.col("_rev")).alias("margin"),
        trend.alias("trend"),
        F.datediff(s, F.col("_first")).alias("days_since_first"),
        "active_months",
        *([F.when(F.col("_bought").isNull(), F.lit(1)).otherwise(F.lit(0)).alias("churn_label")] if labels else []),
    )
    if segment_scope == "history":
        hist = segment_as_of(sales, out.select("snapshot_date", "customer_name"), snapshots)
        out = out.drop("segment").join(hist, ["snapshot_date", "customer_name"], "left")
        out = out.select("snapshot_date", "customer_name", "segment", *K.NUMERIC_FEATURES)
    return out


def segment_as_of(sales: DataFrame, keys: DataFrame, snapshots: Sequence[DateLike]) -> DataFrame:
    """Latest non-null segment at or before each (snapshot_date, customer_name) key.

    Sales are bucketed to the first snapshot on or after their date and
    reduced to one row per (customer, bucket) with ``max_by``; a window per
    customer over buckets and keys then carries the last non-null value
    forward. Window partitions hold at most 2 x snapshots rows, whatever
    the number of sales of a customer. ``keys`` must be small per customer
    (one row per snapshot) and its dates must be among ``snapshots``.
    """
    snaps = sorted({_as_date(x) for x in snapshots})
    d = F.col("sale_date")
    base = (sales.select("customer_name", "sale_date", "segment_name", "source_row_id")
            .filter(F.col("segment_name").isNotNull() & F.col("customer_name").isNotNull()
                    & (d <= F.lit(snaps[-1]))))
    # bucket = first snapshot on or after the sale: everything up to the first
    # snapshot goes to it, later days through the bounded (snapshot, day) calendar
    early = base.filter(d <= F.lit(snaps[0])).withColumn("snapshot_date", F.lit(snaps[0]))
    wins = [(s, p + dt.timedelta(days=1), s) for p, s in zip(snaps, snaps[1:])]
    later = _join_days(base.filter(d > F.lit(snaps[0])), wins) if wins else None
    both = early if later is None else early.unionByName(later)
    bucketed = (both.withColumnRenamed("snapshot_date", "bucket")
                .groupBy("customer_name", "bucket")
                .agg(F.max_by("segment_name", F.struct(d, F.col("source_row_id"))).alias("segment"))
                .withColumn("_is_key", F.lit(0)))
    k = keys.select("customer_name", F.col("snapshot_date").alias("bucket"),
                    F.lit(None).cast("string").alias("segment"), F.lit(1).alias("_is_key"))
    w = (Window.partitionBy("customer_name").orderBy("bucket", "_is_key")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (bucketed.unionByName(k)
            .withColumn("segment", F.last("segment", ignorenulls=True).over(w))
            .filter(F.col("_is_key") == 1)
            .select(F.col("bucket").alias("snapshot_date"), "customer_name", "segment"))


def _label_windows(snapshots: Sequence[DateLike],
                   windows: Mapping[DateLike, tuple[DateLike, DateLike]] | None) -> list:
    out = []
    for s in sorted({_as_date(x) for x in snapshots}):
        w = None
        if windows:
            w = windows.get(s) or windows.get(s.isoformat())
        a, b = (default_label_window(s) if w is None else (_as_date(w[0]), _as_date(w[1])))
        out.append((s, a, b))
    return out


def label_buyers(sales: DataFrame, snapshots: Sequence[DateLike],
                 windows: Mapping[DateLike, tuple[DateLike, DateLike]] | None = None) -> DataFrame:
    """Distinct (snapshot_date, customer_name) that bought inside the label window."""
    wins = _label_windows(snapshots, windows)
    x = _join_days(sales.select("customer_name", "sale_date")
                   .filter(F.col("customer_name").isNotNull()), wins)
    return x.select("snapshot_date", "customer_name").distinct()


def with_churn_label(features: DataFrame, sales: DataFrame, snapshots: Sequence[DateLike],
                     windows: Mapping[DateLike, tuple[DateLike, DateLike]] | None = None) -> DataFrame:
    """Add ``churn_label``: 0 if the customer bought in the label window, else 1.

    Both sides are hash partitioned on (snapshot_date, customer_name) by
    their own aggregates, so the left join adds no exchange.
    """
    buyers = label_buyers(sales, snapshots, windows).withColumn("_bought", F.lit(1))
    return (features.join(buyers, ["snapshot_date", "customer_name"], "left")
            .withColumn("churn_label",
                        F.when(F.col("_bought").isNull(), F.lit(1)).otherwise(F.lit(0)))
            .drop("_bought"))


def retained(features: DataFrame, sales: DataFrame, snapshots: Sequence[DateLike],
             windows=None) -> DataFrame:
    """Snapshot customers that bought again (left semi join)."""
    return features.join(label_buyers(sales, snapshots, windows),
                         ["snapshot_date", "customer_name"], "left_semi")


def churned(features: DataFrame, sales: DataFrame, snapshots: Sequence[DateLike],
            windows=None) -> DataFrame:
    """Snapshot customers with no purchase in the label window (left anti join)."""
    return features.join(label_buyers(sales, snapshots, windows),
                         ["snapshot_date", "customer_name"], "left_anti")
