"""Star schema: date, customer and product dimensions, sales fact, upserts, checks.

All steps are DataFrame -> DataFrame; ``plans.warehouse`` writes them.
Surrogate keys of existing members are kept through every upsert; only new
members are numbered (``ordering.number_rows``, no global window).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.functions.columns import date_key, is_weekend, year_month
from tillsight.operators.ordering import number_rows
from tillsight.session import materialize


class EtlError(RuntimeError):
    """Parameter or data errors of a load (codes 50001-50003 of the original)."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


def only_batch(df: DataFrame, batch_id: str | None) -> DataFrame:
    """Optional batch filter: added only when a batch is given (partition pruning)."""
    return df if batch_id is None else df.filter(F.col("load_batch_id") == F.lit(batch_id))


# ---------------------------------------------------------------- date dimension

def date_rows(dates: DataFrame) -> DataFrame:
    """Date dimension columns for a one-column DataFrame of dates ``full_date``."""
    d = F.col("full_date")
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        year_month(d).alias("year_month"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_date(spark, start, end) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive (error 50001 on a bad range)."""
    if start is None or end is None or start > end:
        raise EtlError(50001, "Invalid date range for the date dimension.")
    one = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return date_rows(one)


def dim_date_for(staged: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Date dimension over the date range of the staged rows, without a driver round trip.

    The range aggregate is one row; the explode yields one row per day, so
    the size is bounded by the calendar, not by the data.
    """
    rng = only_batch(staged, batch_id).agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("b"))
    days = rng.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b")).alias("full_date"))
    return date_rows(days)


def batch_date_range(staged: DataFrame, batch_id: str | None = None):
    """(first, last) sale date of a batch; error 50002 when the batch is empty."""
    r = only_batch(staged, batch_id).agg(F.min("sale_date"), F.max("sale_date")).first()
    if r is None or r[0] is None:
        raise EtlError(50002, "No staged rows found for the requested batch.")
    return r[0], r[1]


def merge_dim_date(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Upsert on date_key (source wins)."""
    return source if target is None else upsert(target, source, ["date_key"])


# ------------------------------------------------------------ customer dimension

def customer_candidates(staged: DataFrame, batch_id: str | None = None,
                        date_scope: str = "segment") -> DataFrame:
    """One row per customer: segment of the newest (customer, segment) group and dates.

    ``date_scope="segment"`` keeps the first/last dates of that newest
    group (the original behaviour); ``"customer"`` takes the customer's
    true first/last purchase. Same-date ties go to the larger segment.
    """
    if date_scope not in ("segment", "customer"):
        raise ValueError(f"unknown date_scope {date_scope!r}")
    g = (only_batch(staged, batch_id)
         .filter(F.col("customer_name").isNotNull())
         .groupBy("customer_name", "segment_name")
         .agg(F.min("sale_date").alias("first"), F.max("sale_date").alias("last")))
    best = F.max_by(F.struct("segment_name", "first", "last"), F.struct("last", "segment_name"))
    c = g.groupBy("customer_name").agg(best.alias("b"), F.min("first").alias("cf"), F.max("last").alias("cl"))
    first = F.col("b.first") if date_scope == "segment" else F.col("cf")
    last = F.col("b.last") if date_scope == "segment" else F.col("cl")
    return c.select("customer_name", F.col("b.segment_name").alias("current_segment"),
                    first.alias("first_purchase_date"), last.alias("last_purchase_date"))


def merge_dim_customer(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Upsert customers on name: segment replaced, dates widened, keys kept."""
    cols = ["customer_name", "current_segment", "first_purchase_date", "last_purchase_date"]
    if target is None:
        new = number_rows(source.select(*cols), ["customer_name"], 1, name="customer_key")
        return new.withColumn("is_active", F.lit(True)).select("customer_key", *cols, "is_active")
    t = target.alias("t")
    s = source.alias("s")
    j = t.join(s, F.col("t.customer_name") == F.col("s.customer_name"), "full_outer")
    matched = j.filter(F.col("t.customer_name").isNotNull())
    kept = matched.select(
        F.col("t.customer_key").alias("customer_key"),
        F.col("t.customer_name").alias("customer_name"),
        F.when(F.col("s.customer_name").isNotNull(), F.col("s.current_segment"))
         .otherwise(F.col("t.current_segment")).alias("current_segment"),
        F.least("t.first_purchase_date", "s.first_purchase_date").alias("first_purchase_date"),
        F.greatest("t.last_purchase_date", "s.last_purchase_date").alias("last_purchase_date"),
        F.col("t.is_active").alias("is_active"),
    )
    new = j.filter(F.col("t.customer_name").isNull()).select(*[F.col(f"s.{c}").alias(c) for c in cols])
    new = (number_rows(new, ["customer_name"], max_key(target, "customer_key") + 1, name="customer_key")
           .withColumn("is_active", F.lit(True)))
    return kept.unionByName(new.select(*kept.columns))


def max_key(target: DataFrame, key: str) -> int:
    """Largest surrogate key in use (one scalar to the driver)."""
    return int(target.agg(F.max(key)).first()[0] or 0)


# ------------------------------------------------------------- product dimension

def product_candidates(staged: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Most frequent attribute combination per product code; ties -> newest, then text."""
    g = (only_batch(staged, batch_id)
         .filter(F.col("product_code").isNotNull())
         .groupBy("product_code", "product_name", "unit_name", "category_name")
         .agg(F.count(F.lit(1)).alias("n"), F.max("sale_date").alias("last")))
    best = F.max_by(F.struct("product_name", "unit_name", "category_name"),
                    F.struct("n", "last", "product_name", "unit_name", "category_name"))
    return (g.groupBy("product_code").agg(best.alias("b"))
             .select("product_code", "b.product_name", "b.unit_name", "b.category_name"))


def merge_dim_product(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Upsert products on code: attributes replaced, keys kept, new codes numbered."""
    cols = ["product_code", "product_name", "unit_name", "category_name"]
    if target is None:
        return number_rows(source.select(*cols), ["product_code"], 1, name="product_key") \
            .select("product_key", *cols)
    kept = (target.select("product_key", "product_code")
            .join(source.select(*cols), "product_code", "inner"))
    untouched = target.join(source.select("product_code"), "product_code", "left_anti")
    new = source.select(*cols).join(target.select("product_code"), "product_code", "left_anti")
    new = number_rows(new, ["product_code"], max_key(target, "product_key") + 1,
                      name="product_key").select("product_key", *cols)
    return (kept.select("product_key", *cols)
            .unionByName(untouched.select("product_key", *cols))
            .unionByName(new))


# ------------------------------------------------------------------- sales fact

FACT_MEASURES = ("import_amount", "promo_quantity", "sales_quantity", "export_amount",
                 "revenue", "profit", "margin_pct", "promo_pct")


def fact_rows(staged: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
              batch_id: str | None = None, source_system: str = K.SOURCE_SYSTEM) -> DataFrame:
    """Staged rows resolved to surrogate keys (inner joins drop unknown members).

    Dimensions are joined as plain equi-joins: AQE broadcasts them when
    their run-time size is under the broadcast threshold and falls back to
    a shuffle join (with skew splitting) when they are not.
    """
    s = only_batch(staged, batch_id)
    measures = [F.col(c) for c in FACT_MEASURES if c in s.columns]
    return (s.join(dim_customer.select("customer_key", "customer_name"), "customer_name")
             .join(dim_product.select("product_key", "product_code"), "product_code")
             .select(F.lit(source_system).alias("source_system"), "source_row_id", "load_batch_id",
                     date_key("sale_date").alias("date_key"), "customer_key", "product_key",
                     F.col("segment_name").alias("segment_at_sale"), *measures))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order`` values."""
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


# Bits that mark repeated keys (16 MB, in rows of 2^15 bits), and from how many keys on all rows are grouped.
MARK_BITS, MARK_ROW_BITS, MAX_MARKED = 27, 15, 8_000_000


def newest_of_stored(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``newest_per_key`` of a written table whose keys mostly come once: only rows of repeated keys are shuffled whole.

    Hashes of the keys are counted first (8 bytes a row). Hashes that come more than once are marked in a bitmap of fixed
    size, which is broadcast; rows on a mark, among them a few whose key comes once, are grouped as ever.
    """
    h = F.xxhash64(*[F.col(k) for k in keys])
    at = F.pmod(h, F.lit(1 << MARK_BITS))
    again = materialize(df.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                        .select(F.pmod("_h", F.lit(1 << MARK_BITS)).alias("_p")), "repeated")
    marked = again.count()
    if not marked:
        return df.select(*keys, *[c for c in df.columns if c not in keys])
    if marked > MAX_MARKED:
        return newest_per_key(df, keys, order)
    row, bit = (lambda p: F.call_function("shiftright", p, F.lit(MARK_ROW_BITS))), (lambda p: F.pmod(p, F.lit(1 << MARK_ROW_BITS)).cast("int"))
    marks = again.groupBy(row(F.col("_p")).alias("_row")).agg(F.bitmap_construct_agg(bit(F.col("_p")).cast("long")).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.call_function("shiftright", bit(at), F.lit(3)) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, bit(at) % 8).bitwiseAND(F.lit(1)) == 1
    seen = df.join(F.broadcast(marks), row(at) == F.col("_row"), "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))  # 2^12 rows at most
    once = seen.where(~F.col("_hit")).select(*keys, *[c for c in df.columns if c not in keys])
    return once.unionByName(newest_per_key(seen.where("_hit").select(*df.columns), keys, order))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = None,
           rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Insert-or-update ``source`` into ``target`` on ``keys``.

    The source is first reduced to one row per key (greatest ``order``
    wins, e.g. the newest load batch). Without ``rules`` matched rows take
    the source row (anti join + union: only the keys of the target cross
    the shuffle twice). ``rules`` maps a column to an expression over the
    aliases ``t`` and ``s`` for matched rows (full outer join).
    """
    src = newest_per_key(source, keys, order) if order else source
    if not rules:
        return target.join(src.select(*keys), list(keys), "left_anti").unionByName(
            src.select(*target.columns), allowMissingColumns=False)
    t, s = target.alias("t"), src.alias("s")
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    j = t.join(s, cond, "full_outer")
    in_t = F.col(f"t.{keys[0]}").isNotNull()
    in_s = F.col(f"s.{keys[0]}").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            e = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c in rules:
            e = (F.when(in_t & in_s, rules[c]).when(in_s, F.col(f"s.{c}"))
                 .otherwise(F.col(f"t.{c}")))
        else:
            e = F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        out.append(e.alias(c))
    return j.select(*out)


# ----------------------------------------------------------------- data quality

def duplicate_keys(df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """One row: rows, distinct keys, keys seen more than once."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.lit(check).alias("check_name"),
                 F.sum("n").cast("long").alias("row_count"),
                 F.count(F.lit(1)).alias("distinct_keys"),
                 F.count_if(F.col("n") > 1).alias("duplicate_keys"))


def orphans(child: DataFrame, parent: DataFrame, key: str, check: str) -> DataFrame:
    """Distinct foreign-key values of ``child`` missing from ``parent``."""
    return (child.select(key).filter(F.col(key).isNotNull()).distinct()
            .join(parent.select(key), key, "left_anti")
            .select(F.lit(check).alias("check_name"), F.col(key).cast("string").alias("key_value")))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls per column (NOT NULL contract)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
