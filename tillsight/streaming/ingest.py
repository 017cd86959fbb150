"""Incremental staging ingest with Structured Streaming.

New sales files landing in a folder are cleaned and appended to staging,
one load batch per micro-batch. The stream's checkpoint (in the shared
checkpoint folder) records which files were taken, so a restarted or
failed run neither loses nor repeats a file; ``availableNow`` processes
everything present and stops, which suits scheduled loads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.operators import cleaning as CL
from tillsight.plans.pipeline import write_staged
from tillsight.session import checkpoint_dir
from tillsight.sources.sales import SALES_SCHEMA


def _writer(base: str, batch_prefix: str, category_map: Mapping[str, str]):
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{batch_prefix}{epoch_id:08d}"
        # a replayed micro-batch replaces its own partitions; incomplete rows go to ``sale_rejects``
        write_staged(CL.clean_sales(batch.drop("load_batch_id"), category_map), base, batch_id)
    return write


def ingest_files(spark: SparkSession, source_dir: str, base: str, fmt: str = "parquet",
                 name: str = "staging_ingest", batch_prefix: str | None = None,
                 category_map: Mapping[str, str] = K.CATEGORY_MAP, max_files: int = 100,
                 available_now: bool = True, **options):
    """Start the file -> staging stream; returns the StreamingQuery.

    Load batches are named after the stream unless ``batch_prefix`` says otherwise. Each file keeps its name as ``source_file_name`` (file metadata
    column); ``max_files`` bounds the size of one micro-batch.
    """
    reader = spark.readStream.format(fmt).schema(
        SALES_SCHEMA if fmt != "parquet" else _without_batch(SALES_SCHEMA))
    stream = (reader.option("maxFilesPerTrigger", max_files).options(**options).load(source_dir)
              .withColumn("source_file_name", F.col("_metadata.file_name")))
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = (stream.writeStream.foreachBatch(_writer(base, f"{name}-" if batch_prefix is None else batch_prefix, category_map))
         .option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _without_batch(schema):
    from pyspark.sql import types as T
    return T.StructType([f for f in schema.fields if f.name != "load_batch_id"])
