"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tillsight",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let spark-submit decide, the number
    of shuffle partitions too: adaptive execution joins small partitions and
    splits skewed joins, but never an aggregate's partition.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Set only where the session has none and driver and tasks are one process
    (local tests); on a cluster the setting must point at shared storage so
    lineage cuts survive executor loss, and its absence raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tillsight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # noqa: BLE001 - core settings may be read-only at run time
        pass
    return local


# Codec of written tables: smaller than the default by about a third.
CODEC = "zstd"
# Whether Spark drops the shuffle files of an execution as soon as it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files behind: what they write is read from its table, not from their shuffles.

    Otherwise the files stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint folder, read it back.

    Used where one intermediate feeds several later steps (staging rows,
    a dimension version), like a written table between pipeline stages.
    The folder comes from ``spark.checkpoint.dir`` (shared storage on a
    cluster), so the table survives executor loss; a columnar write is
    much cheaper than an RDD checkpoint, which recomputes the plan and
    serialises rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)
