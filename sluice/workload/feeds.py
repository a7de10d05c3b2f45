"""Feeds: every table row becomes a record of a product file, one file per product and month.

orders comes from ``orders``, payments from ``lineitem`` (its customer through ``orders``), invoices from ``events``.
Blank cells and drifted headers follow from the keys, so any SQL engine can derive the same records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.contracts import DOMAIN, DOMAIN_FIELDS, LAYOUT_MAPPING, PRODUCT_CONFIG, struct
from sluice.operators import harmonize
from sluice.operators.enrich import Lookup
from sluice.operators.ordinals import number_by_key
from sluice.plans.ingest import (
    Batch,
    FileSource,
    TableSource,
    harmonized_records,
    ingest,
    plan_runs,
    publish_zones,
)
from sluice.session import configure, new_path, stage
from sluice.sources.catalog import Catalog
from sluice.sources.config import validate_configs
from sluice.sources.events import open_envelopes, validate_events
from sluice.sources.files import Landed
from sluice.sources.ledger import BatchKey
from sluice.sources.zones import Lake

CLOCK = "2026-05-01T00:00:00+00:00"

# Source columns of the products' files
ORDERS_LAYOUT = {
    "pedido_id": "transaction_id",
    "cliente_id": "customer_id",
    "valor_total": "amount",
    "data_pedido": "transaction_date",
}
PAYMENTS_LAYOUT = {
    "pagamento_id": "transaction_id",
    "cliente": "customer_id",
    "valor": "amount",
    "data_pagamento": "transaction_date",
}
DESTINATIONS = ["billing-events", "analytics-events"]
# end of fixed values

ORDERS_HEADER = [*ORDERS_LAYOUT, "canal"]
# files of November announce the amount under another name and fail their schema check
ORDERS_DRIFTED = ["pedido_id", "cliente_id", "valor_bruto", "data_pedido", "canal"]
PAYMENTS_HEADER = list(PAYMENTS_LAYOUT)
INVOICES_HEADER = ["invoice_id", "customer_id", "total", "issued_at"]
DRIFT_MONTH = 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(build: Callable) -> Callable:
    """Build once per Spark application and data folder; later queries read what was written."""
    built: dict[tuple[str, str], object] = {}

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, str(sf_dir))
        if key not in built:
            configure(spark)
            built[key] = build(spark, sf_dir)
        return built[key]

    get.fresh = build
    return get


def configs(spark: SparkSession) -> DataFrame:
    policy = {"max_error_count": 1000, "destinations": ["data-quality-events"]}
    rows = [
        (product, DOMAIN, f"de-para/{product}-transaction.json", (DESTINATIONS,), {"max_error_percent": pct, **policy})
        for product, pct in (("orders", 3.0), ("payments", 1.0))
    ]
    schema = struct("product string, domain string, mapping_key string")
    for field in ("publish", "rejection_policy"):
        schema = schema.add(PRODUCT_CONFIG[field])
    return spark.createDataFrame(rows, schema)


def mappings(spark: SparkSession) -> DataFrame:
    rows = [
        (f"de-para/{product}-transaction.json", DOMAIN, list(DOMAIN_FIELDS), layout)
        for product, layout in (("orders", ORDERS_LAYOUT), ("payments", PAYMENTS_LAYOUT))
    ]
    schema = struct("mapping_key string")
    for field in LAYOUT_MAPPING.fields:
        schema = schema.add(field)
    return spark.createDataFrame(rows, schema)


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _file(product: str, ts: str) -> dict[str, Column]:
    month = F.date_trunc("month", F.col(ts))
    return {
        "product": F.lit(product),
        "run_id": F.concat(F.lit(f"{product}-"), F.date_format(month, "yyyyMMdd")),
        "file_name": F.concat(F.lit(f"{product}-"), F.date_format(month, "yyyy-MM-dd"), F.lit(".csv")),
        "business_date": F.date_format(month, "yyyy-MM-dd"),
    }


def _feed(rows: DataFrame, product: str, ts: str, cells: list[Column], order: list[Column]) -> DataFrame:
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    columns = [c.alias(n) for n, c in _file(product, ts).items()]
    return rows.select(*columns, *keys, F.array(*[F.coalesce(c, F.lit("")) for c in cells]).alias("cells"))


def _no(width: int) -> list[Column]:
    return [F.lit(0).cast("bigint")] * width


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    cells = [
        key.cast("string"),
        F.when(key % 97 == 0, "").otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))),
        F.when(key % 89 == 0, "").otherwise(_money("o_totalprice")),
        _day("o_orderdate"),
        F.col("o_orderpriority"),
    ]
    order = [key, *_no(3), F.lit(0.0)]
    return _feed(table(spark, sf_dir, "orders"), "orders", "o_orderdate", cells, order)


def payments_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey")
    customers = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    rows = table(spark, sf_dir, "lineitem").join(customers, "l_orderkey")
    cells = [
        F.concat_ws("-", key.cast("string"), F.col("l_linenumber").cast("string")),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        F.when(key % 101 == 0, "").otherwise(_money("l_extendedprice")),
        _day("l_shipdate"),
    ]
    order = [key, F.col("l_linenumber").cast("bigint"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]
    return _feed(rows, "payments", "l_shipdate", cells, order)


def invoices_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [F.col("event_id").cast("string"), F.col("user_id").cast("string"), _money("value"), _day("ts")]
    return _feed(table(spark, sf_dir, "events"), "invoices", "ts", cells, [F.col("event_id"), *_no(3), F.lit(0.0)])


ORDER_KEYS = ["k0", "k1", "k2", "k3", "k4"]


def header_of(product: Column, business_date: Column) -> Column:
    def names(header: list[str]) -> Column:
        return F.array(*[F.lit(n) for n in header])

    drifted = F.month(F.to_date(business_date)) == DRIFT_MONTH
    return (
        F.when((product == "orders") & drifted, names(ORDERS_DRIFTED))
        .when(product == "orders", names(ORDERS_HEADER))
        .when(product == "payments", names(PAYMENTS_HEADER))
        .otherwise(names(INVOICES_HEADER))
    )


def csv_bytes(cells: Column) -> Column:
    """Bytes of a record as an unquoted CSV line."""
    return F.octet_length(F.concat_ws(",", cells)) + 1


@_once
def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All configured products' records, numbered within their file: product, file columns, row_number, cells."""
    rows = orders_feed(spark, sf_dir).unionByName(payments_feed(spark, sf_dir))
    return number_by_key(rows, ["run_id"], ORDER_KEYS, "raw", keep_order=False)


@_once
def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per delivered file with its header and size."""
    files = raw(spark, sf_dir).groupBy("product", "run_id", "file_name", "business_date").agg(
        F.sum(csv_bytes(F.col("cells"))).alias("_bytes"), F.count(F.lit(1)).alias("total")
    )
    sized = files.withColumn("header", header_of(F.col("product"), F.col("business_date")))
    size = F.col("_bytes") + csv_bytes(F.col("header"))
    return stage(sized.withColumn("file_size", size).drop("_bytes"), "delivered")


@_once
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-ready events: one per delivered file, one per product for the month after its last file (announced but
    never delivered), and one per month of the unconfigured product."""
    told = delivered(spark, sf_dir).select("product", "file_name", "business_date", "run_id")
    next_month = F.add_months(F.max(F.to_date("business_date")), 1)
    late = told.groupBy("product").agg(next_month.alias("_d"))
    late = late.select(
        "product",
        F.concat("product", F.lit("-"), F.date_format("_d", "yyyy-MM-dd"), F.lit(".csv")).alias("file_name"),
        F.date_format("_d", "yyyy-MM-dd").alias("business_date"),
        F.concat("product", F.lit("-"), F.date_format("_d", "yyyyMMdd")).alias("run_id"),
    )
    skipped = table(spark, sf_dir, "events").select(*[c.alias(n) for n, c in _file("invoices", "ts").items()])
    return stage(told.unionByName(late).unionByName(skipped.select(*told.columns).distinct()), "events")


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    files = delivered(spark, sf_dir)
    tagged = F.col("file_name").alias("file_path")
    return Landed(
        raw(spark, sf_dir).select("run_id", tagged, "row_number", "cells"),
        files.select("run_id", tagged, "header"),
        files.select("run_id", "file_size"),
        files.select("run_id", "total"),
    )


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment base: the customers, save every fiftieth."""
    known = table(spark, sf_dir, "customer").filter("c_custkey % 50 <> 0")
    return known.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"))


def build_lake(spark: SparkSession, sf_dir: str) -> tuple[Lake, Batch]:
    """Ingest and publish the whole feed into a new lake."""
    at = Lake(spark, new_path(spark, "lake"))
    batch = ingest(
        at,
        events(spark, sf_dir),
        configs(spark),
        mappings(spark),
        TableSource(landed(spark, sf_dir)),
        F.lit(CLOCK),
        lookups=[Lookup(reference(spark, sf_dir))],
    )
    publish_zones(at, configs(spark), at.read("curated"), at.read("rejected"))
    return at, batch


built = _once(build_lake)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    return built(spark, sf_dir)[0]


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir)[1].states


@_once
def _ledgered(spark: SparkSession, sf_dir: str) -> tuple[Lake, Catalog]:
    """The same feed, with messages that hold no event among it, as two streams deliver it, each as its batch 0.

    The first batch and the publication come twice, the second time with other contents; a third stream's attempt wrote
    wrong rows and never committed.
    """
    from sluice.workload.documents import event_messages

    at = Lake(spark, new_path(spark, "ledgered"))
    catalog = Catalog(at, "ledgered_analytics", "ledgered_business")
    catalog.create(replace=True)
    told = events(spark, sf_dir).select("product", F.to_json(F.struct("product", "file_name", "business_date", "run_id")).alias("value"))
    unusable = validate_events(open_envelopes(event_messages(spark, sf_dir)), products(spark)).filter("outcome = 'quarantined'")
    second = F.floor(F.col("message_id") / 10) % 2 == 1
    messages = told.select("value", (F.col("product") != "orders").alias("second")).unionByName(unusable.select("value", second.alias("second")))
    messages = stage(messages, "ledgered-messages")

    def deliver(rows: DataFrame, origin: str, clock: str = CLOCK) -> None:
        source, lookups = TableSource(landed(spark, sf_dir)), [Lookup(reference(spark, sf_dir))]
        events = open_envelopes(rows.select("value"))
        batch = ingest(at, events, configs(spark), mappings(spark), source, F.lit(clock), lookups=lookups, batch=BatchKey(origin, 0))
        if batch.states is not None:
            catalog.add_runs(batch.states)

    deliver(messages.filter("not second"), "events-a")
    deliver(messages.filter("second"), "events-b")
    deliver(messages, "events-a", "2027-01-01T00:00:00+00:00")
    publish_zones(at, configs(spark), at.read("curated"), at.read("rejected"), BatchKey("curated-a", 0))
    publish_zones(at, configs(spark), at.read("curated").limit(1), at.read("rejected"), BatchKey("curated-a", 0))
    failed = F.lit(at.ledger.open(BatchKey("events-c", 0)).batch_id)
    for name, column in (("ingestion_runs", "status"), ("ingestion_steps", "status"), ("quarantine", "reason"), ("outbox", "payload")):
        at.write(name, at.read(name).withColumns({column: F.lit("wrong"), "batch_id": failed}))
    return at, catalog


def ledgered(spark: SparkSession, sf_dir: str) -> Lake:
    return _ledgered(spark, sf_dir)[0]


def ledgered_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalog of that lake as its batches were added to it, pointing to the lake of this folder."""
    catalog = _ledgered(spark, sf_dir)[1]
    catalog.create(replace=True)
    if spark.sql(f"SHOW PARTITIONS {catalog.tables()['raw']}").isEmpty():  # another folder's lake had the names since
        catalog.register()
    return catalog


@_once
def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One context row per run, as the first step of ingestion makes it."""
    at = Lake(spark, new_path(spark, "unused"))
    clock = F.to_timestamp(F.lit(CLOCK), "yyyy-MM-dd'T'HH:mm:ssxxx")
    return plan_runs(events(spark, sf_dir), products(spark), clock, at)[1]


@_once
def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivered file's header resolved against its product's mapping."""
    runs = contexts(spark, sf_dir).filter("outcome = 'accepted'")
    by_product = harmonize.product_layouts(products(spark), mappings(spark))
    return stage(harmonize.file_layouts(landed(spark, sf_dir).headers, runs, by_product), "layouts")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numbered records mapped to the domain and classified."""
    return harmonized_records(landed(spark, sf_dir), layouts(spark, sf_dir))


@_once
def csv_files(spark: SparkSession, sf_dir: str) -> str:
    """The feed as CSV files under a source root, one folder of part files per run; payments quote every cell."""
    root = new_path(spark, "source")
    rows = raw(spark, sf_dir).join(delivered(spark, sf_dir).select("run_id", "header"), "run_id")
    variants = [("orders", ORDERS_HEADER), ("orders", ORDERS_DRIFTED), ("payments", PAYMENTS_HEADER)]
    for product, header in variants:
        matching = (F.col("product") == product) & (F.col("header") == F.array(*[F.lit(h) for h in header]))
        cells = [F.get("cells", F.lit(i)).alias(h) for i, h in enumerate(header)]
        placed = rows.filter(matching).repartitionByRange("run_id", "row_number")
        placed = placed.sortWithinPartitions("run_id", "row_number").select("run_id", *cells)
        writer = placed.write.mode("append").partitionBy("run_id").option("header", "true").option("escape", '"')
        writer.option("quoteAll", str(product == "payments").lower()).csv(f"{root}/{product}")
    return root


@_once
def landed_texts(spark: SparkSession, sf_dir: str) -> Landed:
    """The documents as CSV files, one folder of part files per language, landed and parsed; their texts hold line breaks."""
    root = new_path(spark, "texts")
    rows = table(spark, sf_dir, "documents").withColumn("run_id", F.concat(F.lit("texts-"), F.coalesce("lang", F.lit("none"))))
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer = rows.select("run_id", "doc_id", "text", "source").write.partitionBy("run_id").option("header", "true")
    writer.options(escape='"', **spaces).csv(f"{root}/texts")
    told = rows.select("run_id").distinct().withColumns(
        {"product": F.lit("texts"), "file_name": F.col("run_id"), "business_date": F.lit("2026-05-01"), "business_day": F.lit("2026-05-01").cast("date")}
    )
    runs = stage(told.withColumn("source_key", F.concat(F.lit("texts/run_id="), "run_id")), "text-runs")
    return FileSource(root).land(Lake(spark, new_path(spark, "text-lake")), runs)


def csv_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run contexts pointing at the CSV folders."""
    runs = contexts(spark, sf_dir).filter("outcome = 'accepted'")
    folder = F.concat(F.col("product"), F.lit("/run_id="), F.col("run_id"))
    return runs.withColumn("source_key", folder)


def land_csv(spark: SparkSession, sf_dir: str) -> tuple[Lake, Landed]:
    at = Lake(spark, new_path(spark, "csv-lake"))
    return at, FileSource(csv_files(spark, sf_dir)).land(at, csv_runs(spark, sf_dir))


landed_csv = _once(land_csv)


@_once
def csv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parsed file's own header resolved against its product's mapping."""
    by_product = harmonize.product_layouts(products(spark), mappings(spark))
    headers = landed_csv(spark, sf_dir)[1].headers
    return stage(harmonize.file_layouts(headers, csv_runs(spark, sf_dir), by_product), "csv-layouts")


def products(spark: SparkSession) -> DataFrame:
    return validate_configs(configs(spark))
