"""Session settings and shared-storage staging."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Partition values such as month=05 must stay text, re-written partitions must replace only themselves,
# and a table may be broadcast only when its size is known to lie under the limit below. Rows come to a zone run by run,
# so a task keeps the files of its few runs open instead of sorting all it holds; beyond that many it sorts the rest.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(32 << 20),  # compressed: sorted rows take about eight times this
    # call sites of every column expression cost more than the plans of the wide fact tables
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "sluice", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_RELIED_ON = (
    "spark.sql.session.timeZone",
    "spark.sql.sources.partitionColumnTypeInference.enabled",
    "spark.sql.maxConcurrentOutputFileWriters",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to a session someone else created."""
    for key in _RELIED_ON:
        spark.conf.set(key, SETTINGS[key])
    return spark


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a scratch folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if configured:
        return os.path.join(configured, "sluice", app)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder when running on a cluster")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="sluice-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")


_staged = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables staged inside, by this thread, when the work is done or has failed.

    For work whose results are written elsewhere, such as a micro-batch. Yields the paths in the order of staging; what
    is taken out of the list stays.
    """
    outer = getattr(_staged, "paths", None)
    _staged.paths = []
    try:
        yield _staged.paths
    finally:
        for name in _staged.paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _staged.paths = outer


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    This fixes non-deterministic columns, cuts lineage in a way that survives executor loss, and gives the
    optimiser true file sizes, so a later join broadcasts the table only if it really is small.
    """
    path = new_path(df.sparkSession, label)
    if getattr(_staged, "paths", None) is not None:
        _staged.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stage_by(df: DataFrame, key: str, label: str) -> Iterator[DataFrame]:
    """Like ``stage``, dealt by ``key``: joins on it shuffle the other side only. The table has a name until the work inside is done."""
    spark = df.sparkSession
    path, name = new_path(spark, label), f"spark_catalog.default.sluice_{uuid.uuid4().hex[:12]}"
    if getattr(_staged, "paths", None) is not None:
        _staged.paths.append(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


_pool = ThreadPoolExecutor(6, "sluice")  # kept: every new thread opens its own connection to the JVM


def run_together(*jobs: Callable[[], object]) -> list:
    """Run independent jobs at the same time, so that one's last tasks do not idle the cluster for the next."""
    return [f.result() for f in [_pool.submit(j) for j in jobs]]


def planned_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate, exact for staged tables and an over-estimate for what filters them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcasts(df: DataFrame) -> bool:
    limit = df._jdf.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= planned_bytes(df) <= limit
