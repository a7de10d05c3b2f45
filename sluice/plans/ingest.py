"""One batch of file-ready events through all zones, for every run in it at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from sluice.operators import enrich, facts, harmonize, publish
from sluice.operators.ordinals import renumber_without
from sluice.functions import csv_line
from sluice.sources import files as csv_files
from sluice.sources.config import validate_configs
from sluice.sources.events import execution_context, validate_events
from sluice.sources.files import Landed
from sluice.sources.ledger import BatchKey, Entry
from sluice.sources.zones import Lake, date_parts
from sluice.session import run_together, stage


class Source(Protocol):
    def land(self, lake: Lake, runs: DataFrame) -> Landed: ...


@dataclass(frozen=True)
class FileSource:
    """Product files under a root folder, addressed by each event's source key."""

    root: str

    def land(self, lake: Lake, runs: DataFrame) -> Landed:
        spark = lake.spark
        files = stage(csv_files.match_files(runs, csv_files.list_source_files(spark, self.root, runs)), "source-files")
        lines = csv_files.landed_lines(spark, files, runs)
        if lines is None:
            return csv_files.nothing_landed(files)
        lake.write("raw", lines)
        filled = runs.join(files.filter("file_size > 0"), "run_id", "left_semi")
        return csv_files.parse_landed(lake.read_runs("raw", _run_parts(filled)), files)


@dataclass(frozen=True)
class TableSource:
    """Records that are already rows of a numbered table; landing keeps them as CSV lines (quoted where needed, NULL as
    an empty cell), without header lines."""

    landed: Landed

    def land(self, lake: Lake, runs: DataFrame) -> Landed:
        only = runs.select("run_id")
        frames = (self.landed.rows, self.landed.headers, self.landed.files, self.landed.totals)
        rows, headers, files, totals = [f.join(only, "run_id", "left_semi") for f in frames]
        lines = rows.join(_run_parts(runs), "run_id").withColumns(
            {"block_start": F.lit(0), "pos": F.col("row_number"), "line": csv_line("cells")}
        )
        lake.write("raw", lines)
        return Landed(rows, headers, files, totals)


@dataclass(frozen=True)
class Batch:
    """What a batch leaves besides its tables: its ledger entry, one verdict per event and one state row per run.

    A replay of a committed batch does nothing and has the entry only.
    """

    entry: Entry
    validated: DataFrame | None = None
    states: DataFrame | None = None


def _run_parts(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "product", *[c.alias(k) for k, c in date_parts(F.col("business_day")).items()])


def _tags(states: DataFrame, condition: str) -> DataFrame:
    """Columns a zone row takes from its run."""
    parts = [c.alias(k) for k, c in date_parts(F.col("business_day")).items()]
    return states.filter(condition).select("run_id", "product", "business_date", "file_name", *parts)


def plan_runs(events: DataFrame, configs: DataFrame, clock: Column, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Verdict per event, and one context row per run; an event delivered twice is one run."""
    validated = stage(validate_events(events, configs), "validated")
    runs = execution_context(validated.filter("outcome <> 'quarantined'"), clock, lake.names)
    return validated, stage(runs.dropDuplicates(["run_id"]), "runs")


def harmonized_records(landed: Landed, layouts: DataFrame) -> DataFrame:
    return harmonize.classify(harmonize.map_records(landed.rows, layouts))


def ingest(
    lake: Lake,
    events: DataFrame,
    configs: DataFrame,
    mappings: DataFrame,
    source: Source,
    clock: Column,
    finished: Column | None = None,
    lookups: Sequence[enrich.Lookup] = (),
    hook: enrich.Hook | None = None,
    batch: BatchKey | None = None,
) -> Batch:
    """Land, harmonise, gate, enrich, gate, publish and record. ``clock`` is the run clock as ISO text.

    ``batch`` says which batch this is, so that a replay is recognised; without it the call is a batch of its own.
    Small per-run tables (contexts, layouts, counts, states) are staged once; record-grain data is written only to
    the zones. Rejected records are written whether or not their run passes its gate.
    """
    with lake.batch(batch) as entry:
        if entry.committed:
            return Batch(entry)
        return _ingest(lake, entry, events, configs, mappings, source, clock, finished, lookups, hook)


def _ingest(
    lake: Lake,
    entry: Entry,
    events: DataFrame,
    configs: DataFrame,
    mappings: DataFrame,
    source: Source,
    clock: Column,
    finished: Column | None,
    lookups: Sequence[enrich.Lookup],
    hook: enrich.Hook | None,
) -> Batch:
    finished = clock if finished is None else finished
    stamp = F.to_timestamp(clock, "yyyy-MM-dd'T'HH:mm:ssxxx")
    tagged = F.lit(entry.batch_id).alias("batch_id")
    products = stage(validate_configs(configs), "configs")
    validated, runs = plan_runs(events, products, stamp, lake)
    body = F.col("value") if "value" in validated.columns else F.to_json(F.struct(*events.columns))
    lake.write("quarantine", validated.filter("outcome = 'quarantined'").select(body.alias("value"), "reason", tagged))

    accepted_runs = runs.filter("outcome = 'accepted'")
    landed = source.land(lake, accepted_runs)
    layouts = stage(
        harmonize.file_layouts(landed.headers, accepted_runs, harmonize.product_layouts(products, mappings, lake.names)),
        "layouts",
    )
    schemas = stage(harmonize.schema_check(layouts, landed.totals), "schemas")
    # files that fail their schema check drop out here, with the join that resolves the layouts
    usable = layouts.join(schemas.filter("schema_ok").select("run_id"), "run_id", "left_semi")
    records = harmonized_records(landed, stage(usable, "usable-layouts"))

    # first pass over the records: rejects go out whatever the gate decides, and counting them decides the gate
    bad = stage(harmonize.rejected(records).drop("raw_fields", "cells"), "harmonize-rejects")
    counted = harmonize.reject_counts(landed.totals, bad)
    half = stage(facts.harmonize_states(runs, landed.files, schemas, counted, lake.names), "harmonize-states")
    # second pass: accepted records of the runs that passed
    good = harmonize.accepted(records).join(_tags(half, "harmonized"), "run_id")
    tagged_bad = bad.join(_tags(half, "schema_ok"), "run_id").withColumn("stage", F.lit("harmonization"))
    run_together(lambda: lake.write("rejected", tagged_bad), lambda: lake.write("processed", good))

    # the same order for enrichment, on the processed zone
    processed = lake.read_runs("processed", _tags(half, "harmonized and h_total > h_rejected"))
    checked = enrich.check_lookups(processed, lookups, hook)
    unknown = stage(enrich.rejected(checked), "enrich-rejects")
    enriched = enrich.reject_counts(enrich.sizes(processed, clock), unknown, clock)
    states = stage(facts.run_states(half, enriched, lake.names), "states")
    removed = bad.select("run_id", "row_number")
    failed_files = facts.file_failures(states).withColumns(
        {**date_parts(F.col("business_day")), "row_number": F.lit(None), "raw_row": F.lit(None)}
    )
    late_rejects = enrichment_rejects(unknown, removed).unionByName(failed_files, allowMissingColumns=True)
    curated = enrich.enrich(enrich.accepted(checked), clock).join(
        states.filter("curated").select("run_id"), "run_id", "left_semi"
    )
    failures = publish.file_failed(facts.failure_events(states, lake.names), products)
    run_facts = facts.ingestion_runs(states, clock, finished, lake.names)
    step_facts = facts.ingestion_steps(states, clock, finished, lake.names)
    run_together(
        lambda: lake.write("rejected", late_rejects, gather=True),
        lambda: lake.write("curated", curated),
        lambda: lake.write("ingestion_runs", run_facts.select("*", tagged), gather=True),
        lambda: lake.write("ingestion_steps", step_facts.select("*", tagged), gather=True),
        lambda: lake.write("manifests", facts.manifests(states, lake.names), gather=True),
        lambda: lake.write("outbox", publish.file_failed_messages(failures).select("*", tagged)),
    )
    return Batch(entry, validated, states)


def enrichment_rejects(bad: DataFrame, removed: DataFrame) -> DataFrame:
    """Records that failed a lookup, numbered by their place among the processed records."""
    row = F.to_json(F.struct("amount", "customer_id", "transaction_date", "transaction_id"))
    numbered = renumber_without(bad.withColumn("raw_row", row), removed)
    return numbered.withColumns({"row_number": F.col("position"), "stage": F.lit("enrichment")})


def publish_zones(lake: Lake, configs: DataFrame, curated: DataFrame, rejected: DataFrame, batch: BatchKey | None = None) -> None:
    """Fan curated and rejected rows out to the outbox, once per ``batch``."""
    with lake.batch(batch) as entry:
        if entry.committed:
            return
        products = stage(validate_configs(configs), "configs")
        ready = publish.record_ready_messages(publish.record_ready(curated, products, lake.names))
        bad = publish.records_rejected_messages(publish.records_rejected(rejected, products, lake.names))
        lake.write("outbox", ready.unionByName(bad).select("*", F.lit(entry.batch_id).alias("batch_id")))
