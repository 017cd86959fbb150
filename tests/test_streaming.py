"""File -> staging stream: every file once, also across restarts."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillsight.plans import params as P
from tillsight.sources.sales import sales_from_tables
from tillsight.streaming.ingest import ingest_files


def test_ingest_files_exactly_once(spark):
    src = tempfile.mkdtemp(prefix="tillsight-in-")
    base = tempfile.mkdtemp(prefix="tillsight-st-")
    raw = sales_from_tables(spark, SF_SMALL, P.BATCH_CUT).drop("load_batch_id")
    a = raw.filter(F.col("sale_date") < F.lit("1996-01-01").cast("date"))
    b = raw.filter(F.col("sale_date") >= F.lit("1996-01-01").cast("date"))
    a.coalesce(1).write.parquet(f"{src}/part_a")
    q = ingest_files(spark, f"{src}/part_a", base, name="t_ingest_a", category_map=P.TEST_CATEGORY_MAP)
    q.awaitTermination(300)
    staged = spark.read.parquet(f"{base}/staging")
    assert staged.count() == a.count()
    # restart on the same folder: nothing is taken twice
    q = ingest_files(spark, f"{src}/part_a", base, name="t_ingest_a", category_map=P.TEST_CATEGORY_MAP)
    q.awaitTermination(300)
    assert spark.read.parquet(f"{base}/staging").count() == a.count()
    b.coalesce(1).write.parquet(f"{src}/part_b")
    q = ingest_files(spark, f"{src}/part_b", base, name="t_ingest_b", category_map=P.TEST_CATEGORY_MAP)
    q.awaitTermination(300)
    staged = spark.read.parquet(f"{base}/staging")
    assert staged.count() == raw.count()
    assert staged.select("source_file_name").distinct().count() == 2
    assert staged.filter(F.col("category_name").isNull()).count() == 0
