"""Queries over the published warehouse and its day states, over the whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators import daystates as DS
from tillsight.plans import fixtures as FX
from tillsight.plans import params as P
from tillsight.plans.published import Warehouse, load_batch
from tillsight.session import checkpoint_dir, materialize
from tillsight.sources.sales import sales_from_tables


class Stopped(RuntimeError):
    """The stop that the failing load of ``q_batch_ledger`` meets."""


def _stop(at: str):
    def step(name: str) -> None:
        if name == at:
            raise Stopped(f"stopped before {name}")
    return step


def warehouse_with_failures(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, list[tuple]]:
    """Loads that succeed, stop between dimension and fact, are run again, and have no rows; after each, the published fact."""
    warehouse = Warehouse(spark, f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}")
    raw = materialize(sales_from_tables(spark, sf_dir, P.BATCH_CUT), "sales")  # the source files of all loads: joined once
    a, b = (raw.where(F.col("load_batch_id") == k) for k in ("batch_a", "batch_b"))
    seen = []
    for batch, rows, at in (("batch_a", a, ""), ("batch_b", b, "fact_sales"), ("batch_b", b, ""), ("empty:1/2", raw.limit(0), "")):
        try:
            load_batch(warehouse, rows, batch, f"{batch}.parquet", P.TEST_CATEGORY_MAP, _stop(at))
        except Exception as e:  # noqa: BLE001 - the ledger has it; anything else than the two known ends goes on
            if not isinstance(e, Stopped) and getattr(e, "code", None) != 50002:
                raise
        fact = warehouse.table("fact_sales")
        got = fact.agg(F.count(F.lit(1)), F.sum("revenue").cast("double")).first()
        seen.append((len(seen) + 1, got[0], got[1]))
    return warehouse, seen


def q_batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of four loads, and the fact that readers saw after each."""
    warehouse, seen = warehouse_with_failures(spark, sf_dir)
    after = spark.createDataFrame(seen, "attempt int, fact_rows long, fact_revenue double")
    rows = warehouse.ledger().collect()                                     # one row a load
    numbered = spark.createDataFrame([(k, r["load"]) for k, r in enumerate(sorted(rows, key=lambda r: r["load"]), 1)], "attempt int, load string")
    return (warehouse.ledger().join(numbered, "load").join(after, "attempt").select(
        "attempt", "load_batch_id", "source_file_name", "status", "rows_loaded", "rows_rejected", "version",
        (F.col("finished_at") >= F.col("started_at")).alias("finished"), F.col("error").isNotNull().alias("has_error"), "fact_rows", "fact_revenue"))


def q_snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every month end from day states, after a late batch with a tenth of the lines of all days."""
    sales = FX.sales_lines(spark, sf_dir)
    late = F.pmod(F.crc32(F.col("source_row_id").cast("string").cast("binary")), F.lit(10)) == 0
    states = materialize(DS.day_states(sales.where(~late)), "day_states")
    return DS.features_from_states(DS.refreshed(states, sales.where(late), sales), P.ALL_MONTH_ENDS, P.LOOKBACK)


def registry() -> dict:
    return {f.__name__: f for f in (q_batch_ledger, q_snapshot_incremental)}
