"""A warehouse whose loads are published whole or not at all, with a ledger of batches.

    home/data/<load>/<table>/          files of one load, written once, never changed
    home/manifests/<version>.json      which folders make up every table in a version
    home/ledger/<load>-<n>.json        events of a load: STARTED, then SUCCESS or FAILED

A load writes new folders only. Its last step writes the next manifest under a temporary name and renames it to the next
version number: readers see the old version until then and the new one after, and a load that dies in between changes
nothing. A second load that started from the same version cannot publish under the same number; it fails and can be run
again. A manifest lists the partitions of a table, not its files, so its size follows the calendar and the batches.

Content is written once: a load writes the partitions it touches straight into its own folder and carries the others over
by name.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight import constants as K
from tillsight.operators import cleaning as CL
from tillsight.operators import daystates as DS
from tillsight.operators import warehouse as WH
from tillsight.operators.checks import Checks
from tillsight.plans.pipeline import FACT_SORT, newest_staged, staged_parts
from tillsight.session import CODEC, materialize, shuffles_dropped
from tillsight.sources.sales import SALES_SCHEMA, require_columns

#: Columns that may hold no null; a load that finds one fails.
STAGED_NOT_NULL = ("source_row_id", "product_code", "sale_date", "customer_name")
FACT_NOT_NULL = ("date_key", "customer_key", "product_key")
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
LEDGER = "load string, load_batch_id string, pipeline string, source_file_name string, event int, status string, at string, rows_loaded long, rows_rejected long, version long, error string"
#: Partition value column of the written folders (a copy: the table's own column stays in its files).
PART = "_part"


class Conflict(RuntimeError):
    """Another load published first."""


class Warehouse:
    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")

    # -- files, through Spark's file systems ---------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _put(self, path: str, value: dict) -> bool:
        """Create a small file whole: written aside, then renamed. False where the name is taken."""
        fs, final = self._fs(path)
        aside = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(aside, False)
        out.write(json.dumps(value).encode())
        out.close()
        done = not fs.exists(final) and fs.rename(aside, final)
        if not done:
            fs.delete(aside, False)
        return done and self._get(path) == value

    def _get(self, path: str) -> dict:
        fs, p = self._fs(path)
        reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        try:
            return json.loads(reader.readLine())
        finally:
            reader.close()

    # -- versions ------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.home}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The tables of a version (the newest by default; 0 is the empty warehouse)."""
        version = max(self.versions(), default=0) if version is None else version
        return self._get(f"{self.home}/manifests/{version:012d}.json") if version else {"version": 0, "tables": {}}

    def table(self, name: str, parts: Iterable | None = None, manifest: dict | None = None) -> DataFrame | None:
        """A table, or its listed partitions only; None where it does not exist."""
        found = (manifest or self.manifest())["tables"].get(name)
        if found is None:
            return None
        wanted = None if parts is None else {str(p) for p in parts}
        paths = [f"{self.home}/{path}" for part, path in found["parts"].items() if wanted is None or part in wanted]
        schema = _schema(found["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders of loads that none of the last ``keep`` versions reads and that are not running."""
        used = {path.split("/")[1] for v in self.versions()[-keep:] for t in self.manifest(v)["tables"].values() for path in t["parts"].values()}
        running = {r["load"] for r in self.ledger().where(F.col("status") == STARTED).collect()}
        gone = [n for n in self._names(f"{self.home}/data") if n not in used | running]
        for n in gone:
            fs, p = self._fs(f"{self.home}/data/{n}")
            fs.delete(p, True)
        return gone

    # -- ledger --------------------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        if not self._names(f"{self.home}/ledger"):
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).option("pathGlobFilter", "*.json").json(f"{self.home}/ledger")

    def ledger(self) -> DataFrame:
        """One row a load: its last status, with start and finish time."""
        last = F.max_by(F.struct("status", "rows_loaded", "rows_rejected", "version", "error"), "event").alias("last")
        at = F.to_timestamp("at")
        return self.events().groupBy("load").agg(
            F.max("load_batch_id").alias("load_batch_id"), F.max("pipeline").alias("pipeline"), F.max("source_file_name").alias("source_file_name"),
            F.min(at).alias("started_at"), F.max(F.when(F.col("status") != STARTED, at)).alias("finished_at"), last,
        ).select("load", "load_batch_id", "pipeline", "source_file_name", "started_at", "finished_at", "last.*")

    def recover(self) -> list[str]:
        """Mark loads that never ended as failed (their driver is gone); call it when no load runs."""
        lost = self.ledger().where(F.col("status") == STARTED).collect()
        for r in lost:
            Load(self, r["load_batch_id"], r["source_file_name"], r["pipeline"], r["load"]).event(FAILED, error="the driver ended before the load did")
        return [r["load"] for r in lost]

    def load(self, batch_id: str, source_file: str | None = None, pipeline: str = "warehouse") -> Load:
        return Load(self, batch_id, source_file, pipeline, f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")


class Load:
    """One run of a batch: ``with warehouse.load(batch) as load``. Publishes at the end; an error publishes nothing."""

    def __init__(self, warehouse: Warehouse, batch_id: str, source_file: str | None, pipeline: str, name: str):
        self.warehouse, self.batch_id, self.source_file, self.pipeline, self.name = warehouse, batch_id, source_file, pipeline, name
        self.rows_loaded = self.rows_rejected = None

    def event(self, status: str, error: str | None = None, version: int | None = None) -> None:
        row = {"load": self.name, "load_batch_id": self.batch_id, "pipeline": self.pipeline, "source_file_name": self.source_file, "event": int(status != STARTED),
               "status": status, "at": dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "rows_loaded": self.rows_loaded, "rows_rejected": self.rows_rejected,
               "version": version, "error": error}
        if not self.warehouse._put(f"{self.warehouse.home}/ledger/{self.name}-{row['event']}.json", row):
            raise Conflict(f"the ledger already has event {row['event']} of load {self.name}")

    def __enter__(self) -> Load:
        self.event(STARTED)
        self.base = self.warehouse.manifest()
        self.tables = json.loads(json.dumps(self.base["tables"]))
        return self

    def read(self, name: str, parts: Iterable | None = None) -> DataFrame | None:
        """A table as this load sees it: the version it started from and its own writes."""
        return self.warehouse.table(name, parts, {"tables": self.tables})

    def write(self, df: DataFrame, name: str, part: str | None = None, sort: tuple = (), replaces: Iterable = ()) -> DataFrame:
        """Write a table whole, or with ``part`` the partitions that ``df`` and ``replaces`` name; others are carried over."""
        folder = f"data/{self.name}/{name}"
        out = df if part is None else df.withColumn(PART, F.col(part).cast("string"))
        writer = (out.sortWithinPartitions(*([PART] if part else []), *sort) if sort else out).write.option("compression", CODEC)
        with shuffles_dropped(self.warehouse.spark):
            (writer.partitionBy(PART) if part else writer).parquet(f"{self.warehouse.home}/{folder}")
        table = {"schema": df.schema.json(), "parts": {"": folder}}
        if part is not None:
            unescape = self.warehouse.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
            new = {unescape(n[len(PART) + 1:]): f"{folder}/{n}" for n in self.warehouse._names(f"{self.warehouse.home}/{folder}") if n.startswith(f"{PART}=")}
            old = self.tables.get(name, {"parts": {}})["parts"]
            gone = {str(r) for r in replaces}
            table["parts"] = {k: v for k, v in old.items() if k not in gone} | new
        self.tables[name] = table
        return self.read(name, None if part is None else new)

    def __exit__(self, kind, error, trace) -> bool:
        if kind is not None:
            self.event(FAILED, error=f"{kind.__name__}: {error}"[:4000])
            return False
        version = self.base["version"] + 1
        if not self.warehouse._put(f"{self.warehouse.home}/manifests/{version:012d}.json", {"version": version, "load": self.name, "tables": self.tables}):
            self.event(FAILED, error=f"version {version} was published by another load")
            raise Conflict(f"version {version} was published by another load")
        self.event(SUCCESS, version=version)
        return False


def _schema(text: str):
    from pyspark.sql.types import StructType
    return StructType.fromJson(json.loads(text))


def load_batch(warehouse: Warehouse, raw: DataFrame, batch_id: str, source_file: str | None = None, category_map: Mapping[str, str] = K.CATEGORY_MAP,
               step: Callable[[str], None] = lambda name: None, date_scope: str = "segment") -> Load:
    """Stage a batch, load dimensions, fact and day states, and publish all of them as one version.

    Raises what a step raises (50002 for a batch without complete rows); then the old version stays. ``step`` is told the
    name of each step before it begins.
    """
    spark = warehouse.spark
    with warehouse.load(batch_id, source_file) as load:
        step("staging")
        require_columns(raw, [f.name for f in SALES_SCHEMA.fields if f.name != "load_batch_id"], "sales batch")
        parts = staged_parts(CL.clean_sales(raw.drop("load_batch_id"), category_map), batch_id, source_file)
        staging = load.write(parts["staging"], "staging", "load_batch_id", ("sale_date", "customer_name"), [batch_id])
        rejects = load.write(parts["sale_rejects"], "sale_rejects", "load_batch_id", (), [batch_id])
        load.rows_loaded, load.rows_rejected = Checks("staging", STAGED_NOT_NULL).require(staging)["row_count"], rejects.count()

        step("dim_date")
        first, last = WH.batch_date_range(staging, batch_id)
        load.write(WH.merge_dim_date(load.read("dim_date"), WH.dim_date(spark, first, last)), "dim_date")
        step("dim_customer")
        dc = load.write(WH.merge_dim_customer(load.read("dim_customer"), WH.customer_candidates(staging, batch_id, date_scope)), "dim_customer")
        step("dim_product")
        dp = load.write(WH.merge_dim_product(load.read("dim_product"), WH.product_candidates(staging, batch_id)), "dim_product")

        step("fact_sales")
        new = WH.fact_rows(newest_staged(staging), dc, dp).withColumn("sale_month", (F.col("date_key") / 100).cast("int"))
        key = ["source_system", "source_row_id"]
        old = load.read("fact_sales")
        # several steps read the new rows: they are made once, as the fact itself where there is none yet
        made = load.write(new, "fact_sales", "sale_month", FACT_SORT) if old is None else materialize(new, "fact_new")
        # months and day keys, bounded by the calendar
        at = {tuple(r) for r in made.select("sale_month", "date_key").distinct().collect()}
        if old is not None:
            moved = old.join(made.select(*key), key, "left_semi").select("sale_month", "date_key").distinct()
            at |= {tuple(r) for r in moved.collect()}
        months, touched = {m for m, _ in at}, {d for _, d in at}
        if old is not None:
            made = load.write(WH.upsert(load.read("fact_sales", months).select(*new.columns), made, key), "fact_sales", "sale_month", FACT_SORT, months)
        Checks("fact_sales", FACT_NOT_NULL).require(made)

        step("customer_days")
        lines = DS.lines_of(load.read("fact_sales", months).where(F.col("date_key").isin(*touched)), load.read("dim_date"), dc)
        states = DS.day_states(lines).withColumn("sale_month", F.year("sale_date") * 100 + F.month("sale_date"))
        kept = load.read("customer_days", months)
        if kept is not None:
            kept = kept.where(~(F.year("sale_date") * 10000 + F.month("sale_date") * 100 + F.dayofmonth("sale_date")).isin(*touched))
            states = kept.unionByName(states)
        load.write(states, "customer_days", "sale_month", ("customer_name", "sale_date"), months)
        step("publish")
    return load
