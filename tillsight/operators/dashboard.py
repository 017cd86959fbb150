"""Dashboard figures in one pass, monthly growth, and distinct customers from mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Grouping columns of the cube, and the levels that the dashboard shows (empty: the total).
DIMENSIONS = ("year_month", "segment", "category_name", "product_code", "customer_name")
LEVELS = (("segment",), ("category_name",), ("product_code",), ("year_month",), ("segment", "customer_name"),
          ("year_month", "segment"), ("year_month", "segment", "customer_name"), ())
#: log2 of the registers of a sketch; its relative standard error is about 1.04 / sqrt(2 ** LG_K).
LG_K = 12


def level_id(level: Sequence[str]) -> int:
    """The grouping id of a level: a set bit for every dimension that is rolled up, the first dimension highest."""
    return sum(1 << (len(DIMENSIONS) - 1 - k) for k, d in enumerate(DIMENSIONS) if d not in level)


def dashboard_cube(sales: DataFrame, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """All levels by grouping sets: one scan, partial sums in each task, one exchange.

    ``level`` is the grouping id, so that a null that stands for "all" is told from a null value.
    """
    rows = sales.select(F.date_format("sale_date", "yyyy-MM").alias("year_month"), F.col("segment_name").alias("segment"),
                        "category_name", "product_code", "customer_name", "revenue", "profit")
    cube = rows.groupingSets([[F.col(c) for c in level] for level in levels], *[F.col(d) for d in DIMENSIONS])
    return cube.agg(F.grouping_id(*DIMENSIONS).cast("int").alias("level"), F.count(F.lit(1)).alias("transaction_count"),
                    F.sum("revenue").cast("double").alias("revenue"), F.sum("profit").cast("double").alias("profit"))


def at_level(cube: DataFrame, *level: str) -> DataFrame:
    return cube.where(F.col("level") == level_id(level)).select(*level, "transaction_count", "revenue", "profit")


def customers_pivot(cube: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Distinct customers by month, a column a segment (0 where there are none): the cube's customer level has one row each."""
    names = at_level(cube, "year_month", "segment", "customer_name").where("customer_name IS NOT NULL")
    return names.groupBy("year_month").pivot("segment", list(segments)).agg(F.count(F.lit(1))).fillna(0, subset=list(segments))


def monthly_growth(sales: DataFrame) -> DataFrame:
    """Revenue of every calendar month from the first to the last, and growth against the month before.

    Months without sales have revenue 0; growth is null in the first month and after a month without revenue. The window
    runs over months only, a few hundred rows at most.
    """
    month = F.trunc("sale_date", "MM")
    per = sales.where("sale_date IS NOT NULL").groupBy(month.alias("month")).agg(F.sum("revenue").alias("_rev"), F.count(F.lit(1)).alias("_n"))
    span = per.agg(F.min("month").alias("a"), F.max("month").alias("b")).where("a IS NOT NULL")
    calendar = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    # both sides are calendars of months
    full = calendar.join(per, "month", "left").select("month", F.coalesce("_n", F.lit(0)).alias("transaction_count"), F.coalesce("_rev", F.lit(0)).cast("double").alias("revenue"))
    before = F.lag("revenue").over(Window.orderBy("month"))
    return full.select(F.date_format("month", "yyyy-MM").alias("year_month"), "transaction_count", "revenue", before.alias("revenue_before"),
                       ((F.col("revenue") - before) / F.nullif(before, F.lit(0.0))).alias("growth"))


# -- distinct customers from sketches ------------------------------------------------------------------------

def customer_sketches(sales: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``sale_date, segment, sketch``: an HLL sketch of the customers of a day and segment, to be kept and merged."""
    return sales.groupBy("sale_date", F.col("segment_name").alias("segment")).agg(F.hll_sketch_agg("customer_name", lg_k).alias("sketch"))


def customers_from_sketches(sketches: DataFrame, *by: Column) -> DataFrame:
    """Estimated distinct customers by ``by`` (all days and segments without), by merging sketches."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("customers", F.hll_sketch_estimate("sketch")).drop("sketch")


def error_bound(customers: Column, lg_k: int = LG_K, deviations: float = 4.0) -> Column:
    """The estimate's distance that is not exceeded but for a chance of about 1 in 16,000 (4 deviations), and at least 1."""
    return F.greatest(F.lit(1.0), F.lit(deviations * 1.04 / (2 ** lg_k) ** 0.5) * customers)


# -- names under a collation ---------------------------------------------------------------------------------

def merged_names(sales: DataFrame, collation: str | None = "UNICODE_CI", column: str = "customer_name") -> DataFrame:
    """``sales`` with one spelling a customer: the least of the names that the collation holds equal (None: no change).

    Only names are shuffled; the sales join the few names that change."""
    if collation is None:
        return sales
    names = sales.select(F.col(column).alias("_name")).where("_name IS NOT NULL").distinct()
    one = names.groupBy(F.collate("_name", collation).alias("_key")).agg(F.min("_name").alias("_one"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    change = names.join(one, F.collate("_name", collation) == F.col("_key")).where("_name <> _one").select("_name", "_one")
    return sales.join(change, F.col(column) == F.col("_name"), "left").withColumn(column, F.coalesce("_one", column)).drop("_name", "_one")


def customer_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_name").agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("revenue").cast("double").alias("revenue"))
