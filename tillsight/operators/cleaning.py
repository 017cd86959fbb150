"""Cleaning and derived columns of raw sales lines, row hashes, change detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight import constants as K
from tillsight.functions.columns import (coerce_number, leading_letters, parse_day_first,
                                         trim_unicode)

# Numeric columns coerced to numbers (bad or missing -> 0).
NUMERIC_COLUMNS = ("import_amount", "promo_quantity", "sales_quantity", "export_amount",
                   "revenue", "profit", "total_quantity_sold", "promo_pct")


def map_lookup(key: Column, mapping: Mapping[str, str], default: str | None) -> Column:
    """Look ``key`` up in a literal map (no join, stays in codegen)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, key)   # null key or missing key -> null
    return hit if default is None else F.coalesce(hit, F.lit(default))


def category_of(code: Column | str, mapping: Mapping[str, str] = K.CATEGORY_MAP,
                default: str = K.DEFAULT_CATEGORY) -> Column:
    """Category from the whole leading letter run of a product code."""
    return map_lookup(leading_letters(code), mapping, default)


def clean_sales(raw: DataFrame, category_map: Mapping[str, str] = K.CATEGORY_MAP,
                default_category: str = K.DEFAULT_CATEGORY) -> DataFrame:
    """Drop empty rows, trim text, coerce numbers, parse dates, derive columns.

    Adds ``year_number``/``month_number`` (kept when present, else from the
    date), ``category_name``, ``margin_pct`` (profit / revenue, 4 decimals
    half-even, 0 when revenue is 0) and ``revenue_per_unit`` (revenue /
    quantity, 0 decimals half-even, 0 when quantity is 0).
    """
    df = raw.dropna(how="all")
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in NUMERIC_COLUMNS:
            dtype = "decimal(18,8)" if f.name == "promo_pct" else "decimal(18,4)"
            c = (coerce_number(c, dtype) if isinstance(f.dataType, T.StringType)
                 else F.coalesce(c.cast(dtype), F.lit(0).cast(dtype)))
        elif f.name == "sale_date":
            c = (parse_day_first(c) if isinstance(f.dataType, T.StringType) else F.to_date(c))
        elif isinstance(f.dataType, T.StringType):
            c = trim_unicode(c)
        cols.append(c.alias(f.name))
    df = df.select(*cols)
    if "sale_date" in df.columns:
        year = F.year("sale_date")
        month = F.month("sale_date")
        if "year_number" in df.columns:
            year = F.coalesce(F.col("year_number").cast("int"), year)
        if "month_number" in df.columns:
            month = F.coalesce(F.col("month_number").cast("int"), month)
        df = df.withColumn("year_number", year).withColumn("month_number", month)
    rev, qty = F.col("revenue"), F.col("sales_quantity")
    return (df.withColumn("category_name", category_of("product_code", category_map, default_category))
              .withColumn("margin_pct", F.coalesce(
                  F.bround(F.try_divide(F.col("profit"), rev), 4).cast("double"), F.lit(0.0)))
              .withColumn("revenue_per_unit", F.coalesce(
                  F.bround(F.try_divide(rev, qty), 0).cast("double"), F.lit(0.0))))


KEY_FIELDS = ("source_row_id", "product_code", "sale_date", "customer_name")


def drop_incomplete(df: DataFrame, keys: Sequence[str] = KEY_FIELDS) -> DataFrame:
    """Drop rows missing any key field."""
    return df.dropna(subset=[k for k in keys if k in df.columns])


def incomplete(df: DataFrame, keys: Sequence[str] = KEY_FIELDS) -> DataFrame:
    """The rows that ``drop_incomplete`` drops."""
    missing = F.lit(False)
    for k in keys:
        if k in df.columns:
            missing = missing | F.col(k).isNull()
    return df.filter(missing)


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 hex of the pipe-joined text form of ``columns`` (null as empty)."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                     for c in columns]), 256)


def row_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Compare two versions of a table on ``key`` by row hash.

    Returns (key, change_status) with status ``new``, ``changed``, ``same``
    or ``gone``. Only the key and a 64-character hash cross the shuffle.
    """
    o = old.select(F.col(key), row_hash(columns).alias("_h_old"))
    n = new.select(F.col(key), row_hash(columns).alias("_h_new"))
    j = o.join(n, key, "full_outer")
    status = (F.when(F.col("_h_old").isNull(), "new")
               .when(F.col("_h_new").isNull(), "gone")
               .when(F.col("_h_old") == F.col("_h_new"), "same")
               .otherwise("changed"))
    return j.select(key, status.alias("change_status"))


def kpis(sales: DataFrame) -> DataFrame:
    """One-row KPI summary: revenue, profit, margin, lines, customers, products, AOV, loss lines."""
    rev = F.sum("revenue")
    prof = F.sum("profit")
    n = F.count(F.lit(1))
    return sales.agg(
        rev.cast("double").alias("total_revenue"),
        prof.cast("double").alias("total_profit"),
        F.coalesce(prof.cast("double") / F.nullif(rev.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("margin"),
        n.alias("order_lines"),
        F.count_distinct("customer_name").alias("customers"),
        F.count_distinct("product_name").alias("products"),
        F.coalesce(rev.cast("double") / F.nullif(n.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("aov"),
        F.count_if(F.col("profit") < 0).alias("negative_profit_lines"),
    )


def negative_profit_rows(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("profit") < 0)


def column_profile(sales: DataFrame) -> DataFrame:
    """Cardinalities and ranges printed by the cleaning step (categories, months, ratio, dates)."""
    return sales.agg(
        F.count_distinct("category_name").alias("categories"),
        F.count_distinct("month_number").alias("months"),
        F.round(F.avg("margin_pct"), 8).alias("avg_margin_pct"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )
