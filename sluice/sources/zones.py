"""Lake zones as Parquet tables, and readers for JSON-lines zones."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.contracts import (
    CURATED_ZONE,
    NAMES,
    PROCESSED_ZONE,
    RAW_ZONE,
    REJECTED_ZONE,
    RUN_FACT,
    STEP_FACT,
    ZONE_DATE_KEYS,
    LakeNames,
    struct,
)
from sluice.operators.facts import latest_runs, latest_steps
from sluice.sources.ledger import BatchKey, Entry, Ledger

_RUN_KEYS = ["product", *ZONE_DATE_KEYS, "run_id"]
_MANIFEST = struct(
    "ingestion_id string, execution_id string, anomesdia string, product string, business_date string, raw string, "
    "processed string, curated string, rejected array<string>, rejected_rows bigint, curated_notification string, "
    "analytics_bucket string, run_id string"
)
_OUTBOX = struct(
    "run_id string, product string, record_key string, payload string, event_type string, destination string, "
    "batch_id string"
)

# table: folder, schema, partition columns. Facts and messages are partitioned by batch below their day or
# destination: many facts share a file, and the ledger gives every batch partitions of its own.
TABLES: dict[str, tuple[str, T.StructType, list[str]]] = {
    "raw": ("raw", RAW_ZONE, _RUN_KEYS),
    "processed": ("processed", PROCESSED_ZONE, _RUN_KEYS),
    "curated": ("curated", CURATED_ZONE, _RUN_KEYS),
    "rejected": ("rejected", REJECTED_ZONE, ["stage", *_RUN_KEYS]),
    "ingestion_runs": (
        "observability/ingestion_runs",
        T.StructType([*RUN_FACT.fields, T.StructField("batch_id", T.StringType())]),
        ["anomesdia", "batch_id"],
    ),
    "ingestion_steps": (
        "observability/ingestion_steps",
        T.StructType([*STEP_FACT.fields, T.StructField("batch_id", T.StringType())]),
        ["anomesdia", "batch_id"],
    ),
    "manifests": ("manifests", _MANIFEST, ["run_id"]),
    "quarantine": ("quarantine", struct("value string, reason string, batch_id string"), ["batch_id"]),
    "outbox": ("outbox", _OUTBOX, ["event_type", "destination", "batch_id"]),
}


# tables of which the last write of each fact counts
LATEST = {"ingestion_runs": latest_runs, "ingestion_steps": latest_steps}


def date_parts(day: Column) -> dict[str, Column]:
    return {k: F.date_format(day, p) for k, p in zip(ZONE_DATE_KEYS, ("yyyy", "MM", "dd"))}


@dataclass(frozen=True)
class Lake:
    """Where the tables live, and how to read and write them."""

    spark: SparkSession
    root: str
    names: LakeNames = NAMES

    def path(self, table: str) -> str:
        return os.path.join(self.root, TABLES[table][0])

    def _folder(self, table: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, os.path.join(self.root, "ledger"))

    @contextmanager
    def batch(self, key: BatchKey | None = None) -> Iterator[Entry]:
        """Open a batch and commit it when the work inside is done; if that fails, the batch stays open and unseen.

        Skip the work if the entry is ``committed``. A new attempt at an open batch starts from a clean slate.
        """
        entry = self.ledger.open(key)
        if entry.replayed and not entry.committed:
            self._remove_batch(entry)
        yield entry
        if not entry.committed:
            self.ledger.commit(entry)

    def abandon(self, key: BatchKey) -> None:
        """Remove what an open batch wrote to the shared tables, and close it."""
        entry = self.ledger.open(key)
        if entry.committed:
            raise ValueError(f"batch {key} has committed")
        self._remove_batch(entry)
        self.ledger.abandon(entry)

    def _remove_batch(self, entry: Entry) -> None:
        for table, (_, _, keys) in TABLES.items():
            if "batch_id" not in keys:
                continue
            fs, path = self._folder(table)
            above = "/*" * keys.index("batch_id")
            found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{path.toString()}{above}/batch_id={entry.batch_id}"))
            for status in found or []:
                fs.delete(status.getPath(), True)

    def read_stream(self, table: str, max_files: int) -> DataFrame:
        """New files of a table as a stream; the folder is made if nothing was written yet."""
        fs, path = self._folder(table)
        fs.mkdirs(path)
        reader = self.spark.readStream.schema(TABLES[table][1]).option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        """Read a table with its declared schema; a table nothing was written to yet is empty.

        Rows of batches that have not committed are passed over, and a fact counts as its last batch wrote it; ``history``
        has all writes.
        """
        rows = self.committed(table)
        return LATEST[table](rows) if table in LATEST else rows

    def committed(self, table: str) -> DataFrame:
        """All writes of batches that have committed."""
        rows = self.history(table)
        if "batch_id" in TABLES[table][2] and (unseen := self.ledger.open_ids()):
            rows = rows.filter(~F.col("batch_id").isin(unseen))
        return rows

    def history(self, table: str) -> DataFrame:
        _, schema, _ = TABLES[table]
        fs, path = self._folder(table)
        if not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        fmt = "json" if table == "manifests" else "parquet"
        return self.spark.read.schema(schema).format(fmt).load(self.path(table))

    def read_runs(self, table: str, runs: DataFrame, **fixed: str) -> DataFrame:
        """Read only the partitions of the given runs (product, date parts, run_id); all must exist.

        Without this a micro-batch would list every run ever ingested.
        """
        _, schema, keys = TABLES[table]
        wanted = runs.select(*[F.lit(fixed[k]).alias(k) if k in fixed else F.col(k) for k in keys]).distinct()
        # run ids come with the messages; folder names hold them escaped, as Spark's writer does it
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        paths = ["/".join([self.path(table), *[escaped(k, row[k]) for k in keys]]) for row in wanted.collect()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def write(self, table: str, rows: DataFrame, gather: bool = False) -> None:
        """Replace exactly the partitions present in ``rows``.

        ``gather`` brings the rows of a partition together first, for rows a shuffle has scattered: without it every
        task writes a file into every partition. The rebalance splits a hot partition and merges small ones.
        """
        _, schema, keys = TABLES[table]
        if gather:
            rows = rows.hint("rebalance", *[F.col(k) for k in keys if k != "batch_id"])
        ordered = rows.to(schema)
        fmt = "json" if table == "manifests" else "parquet"
        writer = ordered.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*keys).save(self.path(table))


def read_jsonl_zone(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A zone of JSON-lines objects under any folder layout and suffix; empty lines and files vanish."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def register(lake: Lake, tables: dict[str, str]) -> None:
    """Expose lake tables to SQL as temporary views: view name to table name."""
    for view, table in tables.items():
        lake.read(table).createOrReplaceTempView(view)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and whether it is empty."""
    counts = [
        df.groupBy().agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    total = counts[0]
    for c in counts[1:]:
        total = total.unionByName(c)
    return total.withColumn("status", F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY"))
