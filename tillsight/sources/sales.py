"""Sales line sources: files, the driver's TPC-H style tables, staging lineage.

A sales line is one invoice line (one transaction). Column names follow the
English names of the warehouse staging table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

D4 = T.DecimalType(18, 4)

# Staging schema of a sales line (no inference anywhere).
SALES_SCHEMA = T.StructType([
    T.StructField("source_row_id", T.StringType(), False),
    T.StructField("product_code", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("unit_name", T.StringType(), True),
    T.StructField("import_amount", D4, True),
    T.StructField("promo_quantity", D4, True),
    T.StructField("sales_quantity", D4, True),
    T.StructField("export_amount", D4, True),
    T.StructField("revenue", D4, True),
    T.StructField("sale_date", T.DateType(), True),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("segment_name", T.StringType(), True),
    T.StructField("profit", D4, True),
    T.StructField("promo_pct", T.DecimalType(18, 8), True),
    T.StructField("load_batch_id", T.StringType(), True),
])

# Columns the churn features need; the loader contract is the full schema.
ML_REQUIRED = ("sale_date", "customer_name", "segment_name", "revenue", "profit", "promo_pct")


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Fail at plan time when a required column is absent (sorted list)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"Missing required columns in {what}: {missing}")
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has cores.

    A file with a single row group is one scan task, and everything fused
    into that stage (joins against broadcast sides, projections) runs on
    one core. Large inputs have many splits and are left alone, so this
    never adds a shuffle of a big table.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _bytes(df: DataFrame) -> int:
    """Size of a scan by its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a side of a join; negative where it never does."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _dec(c: Column | str, p: int, s: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(T.DecimalType(p, s))


def sales_from_tables(spark: SparkSession, sf_dir: str, batch_cut: str = "1998-07-01") -> DataFrame:
    """Map the driver's lineitem/orders/customer/part tables onto sales lines.

    Each line item is one transaction on its ship date; the order priority
    plays the customer segment (it changes during a customer's life), the
    return flag plays the unit, part type + size plays the product code.
    Money is computed in decimals so sums are exact. Rows shipped before
    ``batch_cut`` form load batch ``batch_a``, the rest ``batch_b``.

    The three joins are left to Catalyst/AQE: at scale orders and customer
    are far too large to broadcast, so they become sort-merge joins on
    their keys, and AQE turns any side that is small at run time into a
    broadcast (size checked by ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    Orders meet their customers first, so line items are shuffled twice, by
    part and by order, and never by customer.
    """
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")

    oc = o.join(c, o.o_custkey == c.c_custkey)
    if _bytes(o) + _bytes(c) <= _broadcast_limit(spark):  # the estimate of a join is the product of its sides
        oc = F.broadcast(oc)
    j = li.join(p, li.l_partkey == p.p_partkey).join(oc, li.l_orderkey == oc.o_orderkey)
    qty = _dec("l_quantity", 6, 0)
    price = _dec("p_retailprice", 10, 2)
    ext = _dec("l_extendedprice", 12, 2)
    disc = _dec("l_discount", 4, 2)
    ship = F.col("l_shipdate").cast("date")
    revenue = ext * (F.lit(1) - disc)
    cost = qty * price
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    ship.cast("string")).alias("source_row_id"),
        F.concat(F.col("p_type"), F.col("p_size").cast("string")).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("l_returnflag").alias("unit_name"),
        cost.cast(D4).alias("import_amount"),
        (qty * disc).cast(D4).alias("promo_quantity"),
        F.col("l_quantity").cast(D4).alias("sales_quantity"),
        F.col("l_extendedprice").cast(D4).alias("export_amount"),
        revenue.cast(D4).alias("revenue"),
        ship.alias("sale_date"),
        F.col("c_name").alias("customer_name"),
        F.col("o_orderpriority").alias("segment_name"),
        (revenue - cost).cast(D4).alias("profit"),
        F.col("l_discount").cast(T.DecimalType(18, 8)).alias("promo_pct"),
        F.when(ship < F.lit(batch_cut).cast("date"), F.lit("batch_a"))
         .otherwise(F.lit("batch_b")).alias("load_batch_id"),
    )


def read_sales_files(spark: SparkSession, path: str, fmt: str = "parquet",
                     schema: T.StructType = SALES_SCHEMA, **options) -> DataFrame:
    """Read raw sales files (parquet, csv, json) with a declared schema."""
    reader = spark.read.format(fmt).options(**options)
    if fmt != "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def with_lineage(df: DataFrame, batch_id: str | None = None,
                 source_file: str | None = None) -> DataFrame:
    """Staging lineage: batch id, source file name, load time.

    ``source_file`` defaults to the file each row came from (``_metadata``
    of file sources); pass it for DataFrames that are not file scans.
    """
    out = df
    if batch_id is not None:
        out = out.withColumn("load_batch_id", F.lit(batch_id))
    if source_file is not None:
        out = out.withColumn("source_file_name", F.lit(source_file))
    elif "source_file_name" not in out.columns:
        out = out.withColumn("source_file_name", F.col("_metadata.file_name"))
    return out.withColumn("loaded_at", F.current_timestamp())


def append_staging(df: DataFrame, path: str) -> None:
    """Append staged rows, one folder per load batch (batch pruning on read)."""
    df.write.mode("append").partitionBy("load_batch_id").parquet(path)
