"""Tables stored in buckets of a key, so that joins and aggregates on it need no exchange.

Fact, snapshot and score tables that share a key and a bucket count meet bucket by bucket: a join of two of them, or a
grouping by the key (and any further columns), reads matching buckets in one task. The catalog entry names the folder;
another session registers it again with ``attach``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, sort: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` into ``buckets`` buckets of ``key`` at ``path`` and register it as ``table``.

    Rows are shuffled by the key once, so that each bucket is one file; a key with a third of all rows makes one large
    bucket, whose file readers cannot split by bucket, so keep such tables unbucketed.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *sort).option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def attach(spark: SparkSession, table: str, path: str, key: str, buckets: int, sort: tuple[str, ...] = ()) -> DataFrame:
    """Register the bucketed table at ``path`` in this session's catalog."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    order = ", ".join(map(_quoted, (key, *sort)))
    spark.sql(f"CREATE TABLE {_quoted(table)} ({columns}) USING parquet CLUSTERED BY ({_quoted(key)}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
