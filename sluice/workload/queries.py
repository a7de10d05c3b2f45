"""Registered queries: each operator of the engine over the feeds or documents derived from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.contracts import PROCESSED_ZONE
from sluice.functions import (
    anomesdia,
    blank,
    business_day,
    curated_key,
    date_key,
    double_text,
    json_line_bytes,
    manifest_key,
    object_uri,
    partition_prefix,
    processed_key,
    product_from_key,
    raw_key,
    rejected_key,
    run_id_for,
    run_id_from_key,
    sanitize_fragment,
    source_key,
    stem,
)
from sluice.operators import enrich, facts, gate, harmonize, publish
from sluice.operators.ordinals import number_by_key
from sluice.plans.ingest import enrichment_rejects, harmonized_records
from sluice.plans.reports import REPORTS
from sluice.plans.views import VIEWS
from sluice.session import configure, new_path, stage
from sluice.sources import config, events, notifications
from sluice.sources.catalog import Catalog
from sluice.sources.zones import Lake, read_jsonl_zone, table_counts
from sluice.workload import documents, feeds

Query = Callable[[SparkSession, str], DataFrame]
DOMAIN = ["transaction_id", "customer_id", "amount", "transaction_date"]
_REJECT = ["run_id", "stage", "product", "business_date", "file_name", "row_number", "reason", "raw_row"]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def joined(c: str) -> Column:
    return F.concat_ws(", ", c)


# --- sources ---


def _record_json() -> Column:
    """A record as a key-sorted object, for layouts that carry ``raw_fields``."""
    pairs = F.transform("raw_fields", lambda f: F.struct(f["name"], F.get("cells", f["at"])))
    return F.to_json(F.map_from_entries(pairs), {"ignoreNullFields": "false"})


@query
def scan_raw(spark, sf_dir):
    _, landed = feeds.landed_csv(spark, sf_dir)
    fields = stage(
        landed.headers.select("run_id", "file_path", harmonize.raw_fields(F.col("header")).alias("raw_fields")), "fields"
    )
    rows = landed.rows.join(fields, ["run_id", "file_path"])
    return rows.select("run_id", "row_number", _record_json().alias("raw_row"))


@query
def land_raw(spark, sf_dir):
    at, landed = feeds.landed_csv(spark, sf_dir)
    records = landed.rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("records"))
    header = landed.headers.groupBy("run_id").agg(F.max(F.concat_ws(",", "header")).alias("header"))
    # physical lines are the records plus one header line per part file
    parts = landed.headers.groupBy("run_id").agg(F.count(F.lit(1)).alias("_parts"))
    lines = at.read("raw").groupBy("product", "year", "month", "day", "run_id").agg(F.count(F.lit(1)).alias("_lines"))
    return (
        lines.join(records, "run_id")
        .join(header, "run_id")
        .join(parts, "run_id")
        .select(*["product", "year", "month", "day", "run_id", "records", "header"],
                (F.col("_lines") - F.col("_parts")).alias("data_lines"))
    )


@query
def scan_quoted_breaks(spark, sf_dir):
    """Records whose cells span lines, put together from the lines of split files."""
    cell = lambda i: F.get("cells", F.lit(i))
    return feeds.landed_texts(spark, sf_dir).rows.select(
        "run_id", cell(0).cast("bigint").alias("doc_id"), cell(1).alias("text"), cell(2).alias("source")
    )


@query
def quoted_break_numbers(spark, sf_dir):
    """Numbers of the same records: as many as rows, from 1 to the total of each run."""
    landed = feeds.landed_texts(spark, sf_dir)
    rows = landed.rows.groupBy("run_id").agg(
        F.count_distinct("row_number").alias("numbers"), F.min("row_number").alias("least"), F.max("row_number").alias("most")
    )
    return rows.join(landed.totals, "run_id").select("run_id", "numbers", "least", "most", "total")


@query
def row_ordinals(spark, sf_dir):
    feed = feeds.orders_feed(spark, sf_dir).unionByName(feeds.payments_feed(spark, sf_dir))
    numbered = number_by_key(feed, ["run_id"], feeds.ORDER_KEYS, "ordinals", keep_order=False)
    return numbered.select("run_id", "row_number", F.get("cells", F.lit(0)).alias("transaction_id"))


@query
def scan_processed(spark, sf_dir):
    return feeds.lake(spark, sf_dir).read("processed").select("run_id", *DOMAIN)


@query
def scan_curated(spark, sf_dir):
    columns = ["run_id", "row_number", *DOMAIN, "domain", "product", "business_date", "enriched_at"]
    return feeds.lake(spark, sf_dir).read("curated").select(*columns)


@query
def scan_rejected(spark, sf_dir):
    columns = ["run_id", "stage", "product", "row_number", "reason", "business_date", "year", "month", "day"]
    return feeds.lake(spark, sf_dir).read("rejected").select(*columns)


@query
def scan_zone_tables(spark, sf_dir):
    at = feeds.lake(spark, sf_dir)
    zones = []
    for name, columns in (
        ("processed", ["run_id", *DOMAIN]),
        ("curated", ["run_id", *DOMAIN, "domain", "business_date", "enriched_at"]),
        ("rejected", ["run_id", "stage", "row_number", "reason", "business_date"]),
    ):
        zones.append(at.read(name).select(F.lit(name).alias("zone"), *columns))
    merged = zones[0]
    for z in zones[1:]:
        merged = merged.unionByName(z, allowMissingColumns=True)
    return merged


def _table_counts(spark, sf_dir):
    at = feeds.lake(spark, sf_dir)
    names = {
        "analytics_ingestion_runs": "ingestion_runs",
        "analytics_ingestion_steps": "ingestion_steps",
        "business_curated": "curated",
        "business_rejected": "rejected",
    }
    return table_counts({view: at.read(name) for view, name in names.items()})


QUERIES["table_counts"] = _table_counts


def _catalog_tables(spark, sf_dir):
    """The whole lake registered at once; the names stand for the lake of the last call."""
    catalog = Catalog(feeds.lake(spark, sf_dir))
    catalog.register(replace=True)
    return catalog.describe()


QUERIES["catalog_tables"] = _catalog_tables


# --- configuration ---


def _configs(spark, sf_dir):
    return config.parse_product_configs(documents.config_documents(spark, sf_dir))


@query
def product_config(spark, sf_dir):
    return _configs(spark, sf_dir).select(
        *["product", "domain", "mapping_key"],
        joined("publish.destinations").alias("destinations"),
        F.col("rejection_policy.max_error_percent").alias("max_error_percent"),
        F.col("rejection_policy.max_error_count").alias("max_error_count"),
        joined("rejection_policy.destinations").alias("quality_destinations"),
    )


@query
def rejection_policy(spark, sf_dir):
    return config.rejection_policies(_configs(spark, sf_dir)).select(
        "product", "max_error_percent", "max_error_count", joined("quality_destinations").alias("quality_destinations")
    )


@query
def config_validated(spark, sf_dir):
    return config.validate_configs(_configs(spark, sf_dir)).select(
        "product", F.col("config_error").isNull().alias("usable"), "config_error"
    )


def _mappings(spark, sf_dir):
    return config.parse_layout_mappings(documents.mapping_documents(spark, sf_dir), F.col("mapping_key"))


@query
def layout_mapping(spark, sf_dir):
    pairs = F.transform(F.map_entries("layout_mapping"), lambda e: F.concat_ws(">", e["key"], e["value"]))
    return _mappings(spark, sf_dir).select(
        *["mapping_key", "domain"],
        joined("domain_required_fields").alias("required_fields"),
        F.concat_ws(", ", F.array_sort(pairs)).alias("layout"),
        F.concat_ws(
            ", ", *[F.concat(F.lit(f"{f}<"), harmonize.source_field(F.col("layout_mapping"), f)) for f in DOMAIN]
        ).alias("inverse"),
    )


@query
def mapping_validated(spark, sf_dir):
    return config.validate_mappings(_mappings(spark, sf_dir)).select(
        "mapping_key", F.col("mapping_error").isNull().alias("usable"), "mapping_error"
    )


# --- events ---


def _opened(spark, sf_dir):
    return events.open_envelopes(documents.event_messages(spark, sf_dir))


def _validated(spark, sf_dir):
    return events.validate_events(_opened(spark, sf_dir), feeds.products(spark))


@query
def event_envelope(spark, sf_dir):
    return _opened(spark, sf_dir).select(
        "message_id", events.routed(F.col("value")).alias("routed"), "product", "file_name", "business_date", "reason"
    )


@query
def events_validated(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        *["message_id", "outcome", "reason", "product", "business_date", "config_domain", "mapping_key"],
        joined("publish_destinations").alias("publish_destinations"),
    )


@query
def events_skipped(spark, sf_dir):
    opened = _opened(spark, sf_dir).filter(F.col("reason").isNull() & ~blank(F.col("product")))
    return events.unconfigured(opened, feeds.products(spark)).select("message_id", "product", "file_name")


def _contexts(spark, sf_dir):
    clock = F.to_timestamp(F.lit(feeds.CLOCK), "yyyy-MM-dd'T'HH:mm:ssxxx")
    keyed = _validated(spark, sf_dir).filter("outcome <> 'quarantined'")
    return events.execution_context(keyed, clock)


@query
def execution_context(spark, sf_dir):
    ids = ["ingestion_id", "execution_id", "correlation_id", "anomesdia"]
    return _contexts(spark, sf_dir).select("message_id", "run_id", *ids, "source_system", "source_bucket", "source_key")


@query
def analytics_dimensions(spark, sf_dir):
    bare = _opened(spark, sf_dir).filter(F.col("reason").isNull()).withColumn("domain", F.lit(""))
    dims = facts.fact_dimensions(bare, F.concat(F.lit("run-"), F.col("message_id").cast("string")))
    return dims.select("message_id", "ingestion_id", "execution_id", "correlation_id", "product", "domain")


@query
def event_batch_summary(spark, sf_dir):
    return events.batch_summary(_validated(spark, sf_dir))


# --- scalar functions over table rows ---


def _date_text() -> Column:
    d, key = "o_orderdate", F.col("o_orderkey")
    return (
        F.when(key % 6 == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(key % 6 == 1, F.date_format(d, "yyyy-M-d"))
        .when(key % 6 == 2, F.date_format(d, "dd-MM-yyyy"))
        .when(key % 6 == 3, "")
        .when(key % 6 == 4, F.date_format(d, "yyyy/MM/dd"))
        .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-02-30")))
    )


@query
def date_keys(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "orders").select("o_orderkey", _date_text().alias("business_date"))
    day = business_day(F.col("business_date"))
    return rows.select(
        "o_orderkey",
        anomesdia(day).alias("anomesdia"),
        partition_prefix(day).alias("prefix"),
        date_key(F.col("business_date")).alias("day_key"),
        F.when(day.isNull(), F.lit("business_date must use YYYY-MM-DD")).alias("reason"),
    )


@query
def run_ids(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "events")
    fields = {k: v for k, v in documents._event_fields().items()}
    clock = F.to_timestamp(F.lit(feeds.CLOCK), "yyyy-MM-dd'T'HH:mm:ssxxx")
    given = rows.select("event_id", *[c.alias(k) for k, c in fields.items()])
    return given.select("event_id", run_id_for([(k, F.col(k)) for k in fields], clock).alias("run_id"))


@query
def sanitize_keys(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "events")
    mixed = F.concat(F.lit("--"), "event_type", F.lit(" "), "props", F.lit("!"))
    text = F.when(F.col("event_id") % 3 == 0, mixed).when(F.col("event_id") % 3 == 1, F.lit("!?")).otherwise(F.col("props"))
    return rows.select("event_id", sanitize_fragment(text).alias("fragment"))


@query
def file_key_parse(spark, sf_dir):
    key = F.col("o_orderkey")
    dated = F.concat(F.date_format("o_orderdate", "'year='yyyy'/month='MM'/day='dd"), F.lit("/run-"), key.cast("string"))
    text = (
        F.when(key % 5 == 0, F.concat(F.lit("curated/orders/"), dated, F.lit("/f.parquet")))
        .when(key % 5 == 1, F.concat(F.lit("rejected/harmonization/payments/"), dated, F.lit("/f.jsonl")))
        .when(key % 5 == 2, F.concat(F.lit("manifests/"), key.cast("string")))
        .when(key % 5 == 3, F.lit("curated/orders"))
        .otherwise(F.lit("rejected/enrichment"))
    )
    rows = feeds.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("key"))
    product = product_from_key(F.col("key"))
    return rows.select(
        *["o_orderkey", "key"],
        product.alias("product"),
        run_id_from_key(F.col("key")).alias("run_id"),
        F.when(product.isNull(), F.concat(F.lit("unexpected pipeline file key: "), "key")).alias("reason"),
    )


@query
def artifact_paths(spark, sf_dir):
    key = F.col("o_orderkey")
    text = key.cast("string")
    name = (
        F.when(key % 4 == 0, F.concat(F.lit("orders-"), text, F.lit(".csv")))
        .when(key % 4 == 1, F.concat(F.lit("orders-"), text, F.lit(".tar.gz")))
        .when(key % 4 == 2, F.concat(F.lit(".hidden-"), text))
        .otherwise(F.concat(F.lit("plain-"), text))
    )
    rows = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit("processed").alias("product"), name.alias("file_name"),
        F.concat(F.lit("run-"), text).alias("run_id"), F.to_date("o_orderdate").alias("day"),
    )
    where = (F.col("product"), F.col("day"), F.col("run_id"), F.col("file_name"))
    processed = processed_key(*where)
    return rows.select(
        "o_orderkey",
        source_key(F.col("product"), F.col("file_name")).alias("source_key"),
        raw_key(*where).alias("raw_key"),
        processed.alias("processed_key"),
        curated_key(processed).alias("curated_key"),
        rejected_key(F.lit("enrichment"), *where).alias("rejected_key"),
        manifest_key(F.col("run_id")).alias("manifest_key"),
        object_uri(F.lit("data-lake"), raw_key(*where)).alias("raw_uri"),
        stem(F.col("file_name")).alias("stem"),
    )


# --- harmonisation and the first gate ---


def _schemas(spark, sf_dir):
    return harmonize.schema_check(feeds.layouts(spark, sf_dir), feeds.landed(spark, sf_dir).totals)


def _valid_records(spark, sf_dir):
    """Records of files whose header satisfies the mapping; the verdict needs the headers only."""
    good = feeds.layouts(spark, sf_dir).filter(F.col("mapping_error").isNull() & (F.size("missing") == 0))
    return harmonized_records(feeds.landed(spark, sf_dir), good)


@query
def schema_check(spark, sf_dir):
    return _schemas(spark, sf_dir).select("run_id", "schema_ok", "missing_columns", "unexpected_columns")


@query
def harmonize_mapped(spark, sf_dir):
    return feeds.records(spark, sf_dir).select("run_id", "row_number", *DOMAIN)


@query
def harmonize_accepted(spark, sf_dir):
    return harmonize.accepted(_valid_records(spark, sf_dir)).select("run_id", "row_number", *DOMAIN)


@query
def harmonize_rejected(spark, sf_dir):
    runs = feeds.contexts(spark, sf_dir).select("run_id", "product", "business_date", "file_name")
    rows = harmonize.rejected(_valid_records(spark, sf_dir)).join(runs, "run_id")
    return rows.withColumn("stage", F.lit("harmonization")).select(*_REJECT)


def _first_gate(spark, sf_dir):
    counted = harmonize.counts(_valid_records(spark, sf_dir))
    return gate.threshold_gate(counted, feeds.contexts(spark, sf_dir))


@query
def threshold_gate(spark, sf_dir):
    return _first_gate(spark, sf_dir).select(
        "run_id", "product", "total", "rejected", "rejected_percent", "max_error_percent", "max_error_count", "exceeded"
    )


def _processed(spark, sf_dir):
    verdicts = stage(_first_gate(spark, sf_dir), "gate")
    runs = feeds.contexts(spark, sf_dir).select("run_id", "product", "business_date", "file_name")
    return gate.passing(harmonize.accepted(_valid_records(spark, sf_dir)), verdicts).join(runs, "run_id")


@query
def processed(spark, sf_dir):
    return _processed(spark, sf_dir).select("run_id", "row_number", *DOMAIN)


@query
def harmonize_step(spark, sf_dir):
    landed = feeds.landed(spark, sf_dir)
    bad = harmonize.rejected(_valid_records(spark, sf_dir)).select("run_id", "row_number", "mask")
    counted = harmonize.reject_counts(landed.totals, bad)
    half = facts.harmonize_states(feeds.contexts(spark, sf_dir), landed.files, _schemas(spark, sf_dir), counted)
    settled = facts.run_states(stage(half, "half"), _no_counts(spark))
    clock = F.lit(feeds.CLOCK)
    return facts.harmonize_steps(settled, clock, clock).select(
        *["execution_id", "status", "input_records", "output_records", "rejected_records", "error_code"],
        *["validation_result", "rule_result", "threshold_value", "rejection_reason", "rejection_percent"],
    )


def _no_counts(spark):
    columns = "run_id string, total bigint, rejected bigint, processed_bytes bigint, accepted_bytes bigint"
    return spark.createDataFrame([], f"{columns}, first_reason string")


# --- enrichment and the second gate ---

_WIDE = ("raw_fields", "cells", "file_path")  # of records as they were parsed


def _lookups(spark, sf_dir):
    reference = enrich.Lookup(feeds.reference(spark, sf_dir))
    return enrich.check_lookups(_processed(spark, sf_dir).drop(*_WIDE), [reference])


def _second_gate(spark, sf_dir, checked):
    return gate.threshold_gate(enrich.counts(checked), feeds.contexts(spark, sf_dir))


@query
def enrich_lookup_accepted(spark, sf_dir):
    return enrich.accepted(_lookups(spark, sf_dir)).select("run_id", *DOMAIN)


@query
def enrich_lookup_rejected(spark, sf_dir):
    bad = enrich.rejected(_lookups(spark, sf_dir))
    removed = harmonize.rejected(_valid_records(spark, sf_dir)).select("run_id", "row_number")
    return enrichment_rejects(bad, removed).select(*_REJECT)


@query
def enrich_step(spark, sf_dir):
    clock = F.lit(feeds.CLOCK)
    rows = _processed(spark, sf_dir).drop(*_WIDE)
    checked = enrich.check_lookups(rows, [enrich.Lookup(feeds.reference(spark, sf_dir))])
    bad = stage(enrich.rejected(checked), "enrich-rejects")
    counted = enrich.reject_counts(enrich.sizes(rows, clock), bad, clock)
    return gate.threshold_gate(counted, feeds.contexts(spark, sf_dir)).select(
        *["run_id", "total", "rejected", "rejected_percent", "exceeded", "first_reason", "accepted_bytes"]
    )


@query
def curated(spark, sf_dir):
    checked = _lookups(spark, sf_dir)
    verdicts = stage(_second_gate(spark, sf_dir, checked), "second-gate")
    rows = enrich.enrich(enrich.accepted(checked), F.lit(feeds.CLOCK))
    columns = ["run_id", "row_number", *DOMAIN, "domain", "product", "business_date", "enriched_at"]
    return gate.passing(rows, verdicts).select(*columns)


# --- the same path from files: landed, parsed, harmonised, gated, enriched ---


def _file_records(spark, sf_dir):
    """Records parsed from landed CSV files, quoted and drifted ones included."""
    good = feeds.csv_layouts(spark, sf_dir).filter(F.col("mapping_error").isNull() & (F.size("missing") == 0))
    return harmonized_records(feeds.landed_csv(spark, sf_dir)[1], good)


def _file_gate(spark, sf_dir):
    return gate.threshold_gate(harmonize.counts(_file_records(spark, sf_dir)), feeds.contexts(spark, sf_dir))


def _file_processed(spark, sf_dir):
    runs = feeds.contexts(spark, sf_dir).select("run_id", "product", "business_date", "file_name")
    passed = gate.passing(harmonize.accepted(_file_records(spark, sf_dir)), stage(_file_gate(spark, sf_dir), "gate"))
    return passed.join(runs, "run_id")


@query
def file_threshold_gate(spark, sf_dir):
    return _file_gate(spark, sf_dir).select(
        "run_id", "product", "total", "rejected", "rejected_percent", "max_error_percent", "max_error_count", "exceeded"
    )


@query
def file_processed(spark, sf_dir):
    return _file_processed(spark, sf_dir).select("run_id", "row_number", *DOMAIN)


@query
def file_curated(spark, sf_dir):
    # read by the lookup, the gate and the result: lines are parsed once for all of them
    rows = stage(_file_processed(spark, sf_dir).drop(*_WIDE), "file-processed")
    checked = enrich.check_lookups(rows, [enrich.Lookup(feeds.reference(spark, sf_dir))])
    verdicts = stage(_second_gate(spark, sf_dir, checked), "second-gate")
    rows = enrich.enrich(enrich.accepted(checked), F.lit(feeds.CLOCK))
    columns = ["run_id", "row_number", *DOMAIN, "domain", "product", "business_date", "enriched_at"]
    return gate.passing(rows, verdicts).select(*columns)


# --- zones and facts of the written lake ---


@query
def rejected(spark, sf_dir):
    return feeds.lake(spark, sf_dir).read("rejected").select(*_REJECT)


@query
def file_failed(spark, sf_dir):
    rows = feeds.lake(spark, sf_dir).read("rejected").filter("stage = 'file-failed'")
    return rows.select("run_id", "stage", "product", "business_date", "file_name", "reason")


@query
def ingestion_runs(spark, sf_dir):
    return feeds.lake(spark, sf_dir).read("ingestion_runs").drop("batch_id")


@query
def ingestion_steps(spark, sf_dir):
    return feeds.lake(spark, sf_dir).read("ingestion_steps").drop("batch_id")


@query
def latest_step_facts(spark, sf_dir):
    """A re-delivered batch wrote the same keys an hour earlier; the later facts win."""
    steps = feeds.lake(spark, sf_dir).read("ingestion_steps")
    stale = steps.withColumns(
        {"finished_at": F.lit("2026-04-30T23:00:00+00:00"), "batch_id": F.lit("9"), "output_records": F.lit(-1).cast("bigint")}
    )
    return facts.latest_steps(steps.unionByName(stale)).select(
        "execution_id", "step_name", "status", "finished_at", "output_records", "batch_id"
    )


def _redelivered_lake(spark, sf_dir, registered=False):
    """The lake's run facts as three batches at one clock wrote them; only the last one's numbers are right."""
    runs = feeds.lake(spark, sf_dir).read("ingestion_runs")
    again = Lake(spark, new_path(spark, "redelivered"))
    if registered:
        catalog = Catalog(again, "redelivered_analytics", "redelivered_business")
        catalog.create(replace=True)
    for batch, wrong in ((9, -1), (11, 0), (10, -2)):
        total = F.col("total_records") if not wrong else F.lit(wrong).cast("bigint")
        status = F.col("status") if not wrong else F.lit("FAILED")
        written = {"batch_id": F.lit(f"events-{batch}"), "total_records": total, "status": status}
        again.write("ingestion_runs", runs.withColumns(written))
        if registered:
            catalog.merge_facts([r.anomesdia for r in runs.select("anomesdia").distinct().collect()])
    return again


def _redelivered(spark, sf_dir):
    return _redelivered_lake(spark, sf_dir).read("ingestion_runs")


@query
def redelivered_runs(spark, sf_dir):
    return _redelivered(spark, sf_dir).drop("batch_id")


@query
def redelivered_status_by_day(spark, sf_dir):
    return VIEWS["vw_ingestion_status_by_day"][0](_redelivered(spark, sf_dir))


@query
def redelivered_curated_with_run_context(spark, sf_dir):
    curated_rows = feeds.lake(spark, sf_dir).read("curated")
    return VIEWS["vw_curated_with_run_context_exact"][0](curated_rows, _redelivered(spark, sf_dir))


@query
def ledger_runs(spark, sf_dir):
    """Facts of two batches that share their number and their days."""
    return feeds.ledgered(spark, sf_dir).read("ingestion_runs").drop("batch_id")


@query
def ledger_steps(spark, sf_dir):
    return feeds.ledgered(spark, sf_dir).read("ingestion_steps").drop("batch_id")


@query
def ledger_quarantine(spark, sf_dir):
    rows = feeds.ledgered(spark, sf_dir).read("quarantine")
    return rows.groupBy("batch_id", "reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def ledger_messages(spark, sf_dir):
    return feeds.ledgered(spark, sf_dir).read("outbox").select("event_type", "destination", "run_id", "record_key", "payload")


@query
def ledger_batches(spark, sf_dir):
    """Every batch of that lake, with the rows it holds in the shared tables, seen or not."""
    at = feeds.ledgered(spark, sf_dir)
    entries = at.ledger.entries().select("sequence", "origin", "number", "state")
    for name in ("ingestion_runs", "quarantine", "outbox"):
        held = at.history(name).groupBy(F.col("batch_id").cast("bigint").alias("sequence")).agg(F.count(F.lit(1)).alias(name))
        entries = entries.join(held, "sequence", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return entries


@query
def catalog_ledger_tables(spark, sf_dir):
    """A lake registered batch by batch."""
    return feeds.ledgered_catalog(spark, sf_dir).describe()


@query
def catalog_curated_by_day(spark, sf_dir):
    name = feeds.ledgered_catalog(spark, sf_dir).tables()["curated"]
    return spark.sql(
        f"SELECT product, business_date, count(*) AS curated_records, count(DISTINCT run_id) AS runs FROM {name} GROUP BY product, business_date"
    )


@query
def catalog_redelivered_status_by_day(spark, sf_dir):
    """The registered run facts after three deliveries at one clock, merged after each."""
    catalog = Catalog(_redelivered_lake(spark, sf_dir, registered=True), "redelivered_analytics", "redelivered_business")
    return VIEWS["vw_ingestion_status_by_day"][0](spark.table(catalog.tables()["ingestion_runs"]))


@query
def odd_run_ids(spark, sf_dir):
    """Runs whose ids need escaping in folder names, written and read back by run."""
    run = F.concat(F.col("o_orderpriority"), F.lit(":%2F/{é} =*?"), "o_orderstatus")
    rows = feeds.table(spark, sf_dir, "orders").select(
        run.alias("run_id"), F.lit("orders").alias("product"), F.lit("2026").alias("year"), F.lit("05").alias("month"),
        F.lit("01").alias("day"), F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_orderkey").alias("row_number"),
    )
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESSED_ZONE.fields if f.name not in rows.columns]
    at = Lake(spark, new_path(spark, "odd-ids"))
    at.write("processed", rows.select("*", *empty), gather=True)
    found = at.read_runs("processed", rows)
    return found.groupBy("run_id").agg(F.count(F.lit(1)).alias("records"), F.min("row_number").alias("least"))


@query
def scan_jsonl_zone(spark, sf_dir):
    """The curated zone as JSON lines under other folders and suffixes, read with the declared schema."""
    path = new_path(spark, "jsonl")
    rows = feeds.lake(spark, sf_dir).read("curated").select("run_id", *DOMAIN, "domain", "business_date", "product")
    placed = rows.withColumn("in_product", F.col("product"))
    placed.write.partitionBy("in_product").option("ignoreNullFields", "false").json(path)
    return read_jsonl_zone(spark, path, rows.schema)


@query
def json_sizes(spark, sf_dir):
    """Bytes of documents as JSON lines; their texts hold line breaks, quotes and letters beyond ASCII."""
    rows = feeds.table(spark, sf_dir, "documents")
    return rows.select("doc_id", json_line_bytes({"lang": F.col("lang"), "text": F.col("text")}).alias("n_bytes"))


@query
def small_number_text(spark, sf_dir):
    rows = feeds.table(spark, sf_dir, "lineitem")
    shares = rows.select("l_orderkey", "l_linenumber", (F.col("l_linenumber") / (F.col("l_orderkey") + 1) / 8).alias("share"))
    return shares.select("l_orderkey", "l_linenumber", double_text(F.col("share")).alias("share"))


@query
def manifest(spark, sf_dir):
    rows = feeds.lake(spark, sf_dir).read("manifests")
    return rows.withColumn("rejected", joined("rejected"))


@query
def evidence_rollup(spark, sf_dir):
    return facts.evidence(feeds.states(spark, sf_dir))


@query
def artifact_sizes(spark, sf_dir):
    steps = feeds.lake(spark, sf_dir).read("ingestion_steps").filter("artifact_type is not null")
    return steps.select("execution_id", "artifact_type", "record_count_lineage", "file_size_bytes")


# --- publication ---


def _routed(spark, sf_dir):
    records = notifications.notification_records(documents.notification_messages(spark, sf_dir))
    return notifications.route_messages(records)


@query
def notification_records(spark, sf_dir):
    records = notifications.notification_records(documents.notification_messages(spark, sf_dir))
    return records.select("message_id", "bucket", "key", "reason")


@query
def route_messages(spark, sf_dir):
    return _routed(spark, sf_dir).select("message_id", "route", "product", "run_id", "reason")


@query
def publish_summary(spark, sf_dir):
    return publish.publish_summary(_routed(spark, sf_dir), feeds.products(spark), "message_id")


_ROUTE = ["event_type", "destination", "run_id", "product"]


@query
def outbox_domain_record_ready(spark, sf_dir):
    rows = publish.record_ready(feeds.lake(spark, sf_dir).read("curated"), feeds.products(spark))
    return rows.select(*_ROUTE, *DOMAIN, "domain", "business_date", "enriched_at", "source_bucket", "source_key")


@query
def outbox_records_rejected(spark, sf_dir):
    rows = publish.records_rejected(feeds.lake(spark, sf_dir).read("rejected"), feeds.products(spark))
    return rows.select(*_ROUTE, "stage", "row_number", "reason", "raw_row", "source_bucket", "source_key")


@query
def outbox_file_failed(spark, sf_dir):
    failures = facts.failure_events(feeds.states(spark, sf_dir))
    rows = publish.file_failed(failures, feeds.products(spark))
    own = ["business_date", "file_name", "rows_rejected", "rows_total", "error", "source_bucket", "source_key"]
    return rows.select(*_ROUTE, *own)


@query
def outbox_payload_json(spark, sf_dir):
    at = feeds.lake(spark, sf_dir)
    return at.read("outbox").select("event_type", "destination", "run_id", "record_key", "payload")


@query
def destination_counts(spark, sf_dir):
    return publish.destination_counts(feeds.lake(spark, sf_dir).read("outbox"))


# --- views and reports over the written lake ---


def _over_lake(build: Callable[..., DataFrame], inputs: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = feeds.lake(spark, sf_dir)
        return build(*[at.read(t) for t in inputs])

    return run


for _name, (_build, _inputs) in {**VIEWS, **REPORTS}.items():
    QUERIES[_name] = _over_lake(_build, _inputs)


def queries() -> dict[str, Query]:
    def prepared(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), str(sf_dir))

        return run

    return {name: prepared(build) for name, build in QUERIES.items()}
