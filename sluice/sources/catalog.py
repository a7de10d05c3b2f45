"""A lake in the catalog: two databases, external tables that follow the lake batch by batch, and the views.

Zone tables get the partitions a batch wrote by name, so registering costs what the batch holds. Fact tables hold the last
write of every fact: for the days a batch touched, its facts are merged with the earlier ones into new files, and each
day's partition is then pointed to them, which readers see as one change.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.plans.views import VIEWS
from sluice.sources.listing import leaf_files, qualified, uri
from sluice.sources.zones import LATEST, TABLES, Lake, date_parts

ANALYTICS_DB = "ingestion_analytics"
BUSINESS_DB = "ingestion_business"

#: catalog table: lake table
FACT_TABLES = {"analytics_ingestion_runs": "ingestion_runs", "analytics_ingestion_steps": "ingestion_steps"}
ZONE_TABLES = {
    "business_raw": "raw",
    "business_processed": "processed",
    "business_curated": "curated",
    "business_rejected": "rejected",
}
_STAGES = ("harmonization", "enrichment", "file-failed")
_MANY = 200  # partitions of one statement


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Catalog:
    """The names under which a lake is registered. Two lakes in one metastore need names of their own."""

    lake: Lake
    analytics: str = ANALYTICS_DB
    business: str = BUSINESS_DB

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    def tables(self) -> dict[str, str]:
        """Lake table to its full name."""
        names = {table: f"{self.analytics}.{name}" for name, table in FACT_TABLES.items()}
        return names | {table: f"{self.business}.{name}" for name, table in ZONE_TABLES.items()}

    def layout(self, table: str) -> tuple[T.StructType, list[str], str]:
        """Columns (partition columns last), partition columns and folder of a registered table."""
        folder, schema, keys = TABLES[table]
        if table in LATEST:
            columns = T.StructType([f for f in schema.fields if f.name not in keys] + [schema["anomesdia"]])
            return columns, ["anomesdia"], f"{self.lake.root}/current/{table}"
        return schema, keys, f"{self.lake.root}/{folder}"

    def create(self, replace: bool = False) -> None:
        """Create databases and tables that are not there. A name that stands for another lake is an error, or with
        ``replace`` forgotten first; a table that owns its data is never dropped."""
        for db in (self.analytics, self.business):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.lake.root}/_databases/{db}'")
        for table, name in self.tables().items():
            schema, keys, folder = self.layout(table)
            if self.spark.catalog.tableExists(name):
                about = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
                if self._same(about["Location"], folder):
                    continue
                if about["Type"] != "EXTERNAL":
                    raise ValueError(f"{name} holds data of its own at {about['Location']}")
                if not replace:
                    raise ValueError(f"{name} stands for {about['Location']}; register this lake under other names")
                self.spark.sql(f"DROP TABLE {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{folder}'"
            )

    def _same(self, one: str, other: str) -> bool:
        return uri(self.spark, qualified(self.spark, one)) == uri(self.spark, qualified(self.spark, other))

    def _add(self, name: str, keys: list[str], partitions: Iterable[tuple[list[str], str]]) -> None:
        specs = [
            f"PARTITION ({', '.join(f'`{k}` = {_text(v)}' for k, v in zip(keys, values))}) LOCATION {_text(place)}"
            for values, place in partitions
        ]
        for at in range(0, len(specs), _MANY):
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[at : at + _MANY])}")
        if specs:
            self.spark.catalog.refreshTable(name)

    def add_runs(self, runs: DataFrame) -> None:
        """Register what a batch wrote: ``runs`` has its runs' ``product``, ``business_day`` and ``run_id``, such as the
        states that ``ingest`` returns. Only the folders of these runs and the facts of their days are looked at."""
        self.create()
        escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        told = runs.select("product", "run_id", *[c.alias(k) for k, c in date_parts(F.col("business_day")).items()])
        rows = [r.asDict() for r in told.distinct().collect()]
        for table in ZONE_TABLES.values():
            _, keys, folder = self.layout(table)
            base = qualified(self.spark, folder)
            specs = [{**r, "stage": s} for r in rows for s in (_STAGES if "stage" in keys else ("",))]
            places = {"/".join(escaped(k, spec[k]) for k in keys): [spec[k] for k in keys] for spec in specs}
            prefix = uri(self.spark, base).rstrip("/") + "/"
            # a file's URI holds its folder's name escaped once more
            written = {unquote(file.removeprefix(prefix)).rsplit("/", 1)[0] for file, _ in leaf_files(self.spark, [f"{base}/{p}" for p in places])}
            self._add(self.tables()[table], keys, [(values, f"{base}/{p}") for p, values in places.items() if p in written])
        # an event may name another day for its facts than for its data
        day = F.col("anomesdia") if "anomesdia" in runs.columns else F.date_format("business_day", "yyyyMMdd")
        self.merge_facts(sorted(r.day for r in runs.select(day.alias("day")).distinct().collect() if r.day is not None))

    def merge_facts(self, days: list[str] | None) -> None:
        """Point the partitions of the given days (None: all) to the last write of each of their facts.

        Costs the facts of these days. One writer at a time; what a day's readers see changes once, when its merge is whole.
        """
        for table, latest in LATEST.items():
            schema, _, folder = self.layout(table)
            facts = self.lake.committed(table)
            if days is not None:
                facts = facts.filter(F.col("anomesdia").isin(days))
            version = f"{folder}/version-{uuid.uuid4().hex}"
            merged = latest(facts).to(schema).hint("rebalance", F.col("anomesdia"))
            merged.write.partitionBy("anomesdia").parquet(version)
            name = self.tables()[table]
            base = qualified(self.spark, version)
            prefix = uri(self.spark, base).rstrip("/") + "/anomesdia="
            folders = {file.rsplit("/", 1)[0] for file, _ in leaf_files(self.spark, [base])}
            found = sorted(unquote(f.removeprefix(prefix)) for f in folders if f.startswith(prefix))
            self._add(name, ["anomesdia"], [([d], f"{base}/anomesdia={d}") for d in found])
            for day in found:  # those that were there before still point to earlier files
                self.spark.sql(f"ALTER TABLE {name} PARTITION (anomesdia = {_text(day)}) SET LOCATION {_text(f'{base}/anomesdia={day}')}")
            self.spark.catalog.refreshTable(name)

    def register(self, replace: bool = False) -> dict[str, str]:
        """Register a whole lake, whatever wrote it: finds all partitions and merges all facts. Safe to repeat."""
        self.create(replace)
        for table in ZONE_TABLES.values():
            self.spark.catalog.recoverPartitions(self.tables()[table])
        self.merge_facts(None)
        return self.tables()

    def vacuum(self) -> None:
        """Delete merged facts that no partition points to any more. Not beside running readers of older states."""
        fs, _ = self.lake._folder("ingestion_runs")
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for table in LATEST:
            _, _, folder = self.layout(table)
            files = self.spark.table(self.tables()[table]).inputFiles()
            used = {name for f in files for name in f.split("/") if name.startswith("version-")}
            for status in fs.listStatus(hadoop(folder)) if fs.exists(hadoop(folder)) else []:
                if status.getPath().getName().startswith("version-") and status.getPath().getName() not in used:
                    fs.delete(status.getPath(), True)

    def describe(self) -> DataFrame:
        """Registered tables with their column and partition-key counts, and the rows SQL finds in them."""
        parts = []
        for table, name in self.tables().items():
            schema, keys, _ = self.layout(table)
            database, short = name.split(".")
            counted = self.spark.table(name).groupBy().agg(F.count(F.lit(1)).alias("row_count"))
            parts.append(
                counted.select(
                    F.lit(database).alias("database_name"),
                    F.lit(short).alias("table_name"),
                    F.lit(len(schema.fields) - len(keys)).alias("column_count"),
                    F.lit(", ".join(keys)).alias("partition_keys"),
                    "row_count",
                )
            )
        total = parts[0]
        for p in parts[1:]:
            total = total.unionByName(p)
        return total

    def register_views(self) -> None:
        """The views as temporary views over the registered tables."""
        names = self.tables()
        register_views(self.spark, {t: self.spark.table(n) for t, n in names.items()})


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, (build, inputs) in VIEWS.items():
        build(*[tables[t] for t in inputs]).createOrReplaceTempView(name)
