"""The warehouse pipeline on cases that must not lose, double or mix up rows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tillsight.functions.columns import parse_day_first
from tillsight.operators.scores import SCORE_KEYS, merge_scores
from tillsight.plans import pipeline as PL
from tillsight.streaming.ingest import _writer

HEAD = ("source_row_id string, product_code string, product_name string, unit_name string, import_amount decimal(18,4), "
        "promo_quantity decimal(18,4), sales_quantity decimal(18,4), export_amount decimal(18,4), revenue decimal(18,4), "
        "sale_date string, customer_name string, segment_name string, profit decimal(18,4), promo_pct decimal(18,8)")


def sale(spark, *rows):
    from decimal import Decimal as D
    return spark.createDataFrame([(i, "P1", "p", "u", D(1), D(1), D(1), D(1), D(r), day, c, "s", D(1), D(0)) for i, day, c, r in rows], HEAD)


def test_missing_and_unreadable_tables(spark):
    base = tempfile.mkdtemp()
    assert PL.exists(spark, f"{base}/none") is False
    os.makedirs(f"{base}/dim_customer")
    with open(f"{base}/dim_customer/part-0.parquet", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception):
        PL.exists(spark, f"{base}/dim_customer")


def test_staging_again_replaces_and_rejects_are_kept(spark):
    base = tempfile.mkdtemp()
    batch = sale(spark, ("1", "05/09/2023", "c", 5), ("2", "no date", "c", 6), (None, "06/09/2023", "c", 7))
    for _ in range(2):
        PL.stage_batch(batch, base, "b1", "f", {})
    assert spark.read.parquet(f"{base}/staging").count() == 1
    assert spark.read.parquet(f"{base}/sale_rejects").count() == 2


def test_first_load_keeps_one_row_a_key_and_moved_months_vanish(spark):
    base = tempfile.mkdtemp()
    PL.stage_batch(sale(spark, ("1", "05/09/2023", "c", 5)), base, "batch_9", "f", {})
    PL.stage_batch(sale(spark, ("1", "05/09/2023", "c", 6)), base, "batch_10", "f", {})
    PL.run_etl(spark, base)
    fact = spark.read.parquet(f"{base}/fact_sales").collect()
    assert [(r["load_batch_id"], int(r["revenue"])) for r in fact] == [("batch_10", 6)]
    PL.stage_batch(sale(spark, ("1", "05/10/2023", "c", 6)), base, "batch_11", "f", {})
    PL.run_etl(spark, base, "batch_11")
    assert [r["sale_month"] for r in spark.read.parquet(f"{base}/fact_sales").collect()] == [202310]


@pytest.mark.parametrize("batch_id", ["plain", "2024-01-01 10:00", "a/b=c%d", "..", "x/../../y"])
def test_any_batch_name_is_replaced_in_its_own_folder(spark, batch_id):
    base = tempfile.mkdtemp()
    PL.stage_batch(sale(spark, ("1", "05/09/2023", "c", 5)), base, "kept", "f", {})
    for _ in range(2):
        PL.stage_batch(sale(spark, ("1", "05/09/2023", "c", 5), (None, "05/09/2023", "c", 5)), base, batch_id, "f", {})
    for table in ("staging", "sale_rejects"):
        rows = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(f"{base}/{table}")
        assert rows.where(F.col("load_batch_id") == batch_id).count() == 1
    assert spark.read.parquet(f"{base}/staging").count() == 2


def test_streamed_incomplete_rows_are_kept(spark):
    base = tempfile.mkdtemp()
    batch = sale(spark, ("1", "05/09/2023", "c", 5), ("2", "no date", "c", 6)).withColumn("source_file_name", F.lit("f"))
    for _ in range(2):
        _writer(base, "stream_r-", {})(batch, 0)
    assert spark.read.parquet(f"{base}/staging").count() == 1
    assert [r["source_row_id"] for r in spark.read.parquet(f"{base}/sale_rejects").collect()] == ["2"]


def test_one_score_a_key(spark):
    rows = spark.createDataFrame([("2024-01-01", 1, "m", "1", 0.2, 2.0, "b"), ("2024-01-01", 1, "m", "1", 0.9, 9.0, "b")],
                                 "snapshot_date string, customer_key int, model_name string, model_version string, churn_prob double, risk_score double, load_batch_id string")
    for target in (None, rows.limit(0), rows.limit(1)):
        got = merge_scores(target, rows).collect()
        assert [r["churn_prob"] for r in got] == [0.9]
    assert len(SCORE_KEYS) == 4


def test_replayed_micro_batch_counts_once(spark):
    base = tempfile.mkdtemp()
    write = _writer(base, "stream_a-", {})
    batch = sale(spark, ("1", "05/09/2023", "c", 5)).withColumn("source_file_name", F.lit("f"))
    for _ in range(2):
        write(batch, 0)
    _writer(base, "stream_b-", {})(batch, 0)
    staged = spark.read.parquet(f"{base}/staging")
    assert staged.count() == 2 and "row_hash" in staged.columns


@pytest.mark.parametrize("text", ["2023-09-05", "2023-09-05 00:00:00.000", "2023-09-05T00:00:00.000Z", "05/09/23", "5/9/2023 00:00:00 AM", "5/9/2023 12:30:00 PM",
                                  "05/09/2023 10:11", "2023-09-05T10:11:12"])
def test_date_forms(spark, text):
    got = spark.createDataFrame([(text,)], "d string").select(parse_day_first("d").cast("string")).first()[0]
    assert got == "2023-09-05"


def test_entry_without_the_training_data_operators(monkeypatch):
    import importlib

    import __spark_entry__ as E

    def gone(name, package=None):
        raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(importlib, "import_module", gone)
    assert "q_upsert" in E.queries() and not [k for k in E.queries() if k.startswith("op")] and "q_upsert" in E.oracle_sql()
    monkeypatch.setattr(importlib, "import_module", lambda name: gone("numpy"))
    with pytest.raises(ModuleNotFoundError):
        E.queries()
