"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import checkpoint_dir

# Fixed value: the word separators of the documents' contract.
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Rows of two or three numbers up to which a counted side is broadcast (about 100 MB); beyond it, a plain join.
BROADCAST_ROWS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: one Parquet table in the shared checkpoint folder, read back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's full URI, as Spark resolves it: a bare path lies in Spark's default file system, local or not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a *written* table of numbers whose counted rows stay within ``limit``."""
    return F.broadcast(df) if df.count() <= limit else df


#: Bytes of a binary column up to which its written table is broadcast.
BROADCAST_BYTES = 64_000_000


def small(df: DataFrame, column: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a binary column of a *written* table sums to at most ``limit`` bytes, so that it may be broadcast."""
    return (df.agg(F.sum(F.octet_length(column))).first()[0] or 0) <= limit


def words_of(text: Column) -> Column:
    """Words of a text between the contract's separators; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def once(df: DataFrame, keep: list[str], values: dict[str, Column]) -> DataFrame:
    """``keep`` and the named ``values``, computed once a row. Catalyst copies an expression to every place that
    refers to it and pushes filters on it below; it does neither across a generator."""
    packed = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return df.select(*keep, F.explode_outer(packed).alias("_once")).select(*keep, *[F.col(f"_once.{k}") for k in values])


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, like ``--py-files``."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sources = tempfile.mkdtemp()
    shutil.copytree(package, os.path.join(sources, "src", os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(sources, "llm_package"), "zip", os.path.join(sources, "src")))
    sc._llm_shipped = True


def release() -> None:
    """Give memory that this worker has freed back to the system; allocators otherwise keep the peak of every task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
