"""Processed records to curated ones: reference lookups and constants."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sluice.contracts import DOMAIN, DOMAIN_FIELDS, REASON_NO_LOOKUP
from sluice.functions import json_line_bytes
from sluice.session import broadcasts, stage


@dataclass(frozen=True)
class Lookup:
    """A reference table in which a record's field must be found."""

    reference: DataFrame
    field: str = "customer_id"
    key: str = "customer_id"
    reason: str = REASON_NO_LOOKUP


Hook = Callable[[DataFrame], DataFrame]


def missing_keys(rows: DataFrame, lookup: Lookup) -> DataFrame:
    """Distinct keys of ``rows`` that the reference lacks, a NULL key among them; written once, so that its size is known.

    Only keys meet the reference, however large it is, and a key that many records share is one of them.
    """
    keys = rows.select(F.col(lookup.field).alias("_key")).distinct()
    known = lookup.reference.select(F.col(lookup.key).alias("_key"))
    return stage(keys.join(known, "_key", "left_anti"), "missing-keys")


def check_lookups(processed: DataFrame, lookups: Sequence[Lookup], hook: Hook | None = None) -> DataFrame:
    """Add ``reject_reason``: the first lookup that misses, then the user's own rule, or NULL.

    Records meet the missing keys only, which are broadcast if they are as few as they should be; otherwise the records
    are shuffled to them. ``hook`` maps a frame to one with a nullable ``reject_reason`` column, so custom rules stay
    set-wise; its verdict is written once, since its readers (accepted and rejected records) must see the same one.
    """
    checked, reasons, shuffled = processed, [], False
    for i, lookup in enumerate(lookups):
        flag, missing = f"_missing_{i}", missing_keys(processed, lookup)
        shuffled = shuffled or not broadcasts(missing)
        marked = missing.withColumn(flag, F.lit(True))
        checked = checked.join(marked, F.col(lookup.field).eqNullSafe(F.col("_key")), "left").drop("_key")
        reasons.append(F.when(F.col(flag), F.lit(lookup.reason)))
    if hook is not None:
        checked = hook(checked)
        reasons.append(F.col("reject_reason"))
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    checked = checked.withColumn("reject_reason", reason).drop(*[f"_missing_{i}" for i in range(len(lookups))])
    # a shuffle scattered every run; bring runs back together (hot ones split) so zone files stay few and full
    checked = checked.hint("rebalance", F.col("run_id")) if shuffled else checked
    return stage(checked, "lookups") if hook is not None or shuffled else checked


def counts(checked: DataFrame) -> DataFrame:
    """Per run: records and rejects."""
    bad = F.col("reject_reason").isNotNull()
    return checked.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("rejected"))


def _enriched_bytes(clock: Column) -> Column:
    kept = {f: F.col(f) for f in (*DOMAIN_FIELDS, "product", "business_date")}
    return json_line_bytes({**kept, "domain": F.lit(DOMAIN), "enriched_at": clock})


def sizes(processed: DataFrame, clock: Column) -> DataFrame:
    """Per run: processed records, and their bytes as JSON lines before and after enrichment. Needs no lookup."""
    own = json_line_bytes({f: F.col(f) for f in DOMAIN_FIELDS})
    return processed.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(own).alias("processed_bytes"),
        F.sum(_enriched_bytes(clock)).alias("_all_bytes"),
    )


def reject_counts(sized: DataFrame, bad: DataFrame, clock: Column) -> DataFrame:
    """Complete the sizes with the rejects: their number, what is left in bytes, and the first one's reason.

    ``bad`` is read twice, so pass it staged; it holds the rejects only.
    """
    per_run = bad.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rejected"),
        F.sum(_enriched_bytes(clock)).alias("_bad_bytes"),
        F.min("row_number").alias("row_number"),
    )
    first = bad.select("run_id", "row_number", F.col("reason").alias("first_reason"))
    zero = F.lit(0).cast("bigint")
    return (
        sized.join(per_run.join(first, ["run_id", "row_number"]), "run_id", "left")
        .withColumns(
            {
                "rejected": F.coalesce("rejected", zero),
                "accepted_bytes": F.col("_all_bytes") - F.coalesce("_bad_bytes", zero),
            }
        )
        .drop("row_number", "_all_bytes", "_bad_bytes")
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is null").drop("reject_reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter("reject_reason is not null").withColumnRenamed("reject_reason", "reason")


def enrich(rows: DataFrame, clock: Column) -> DataFrame:
    """Stamp domain and enrichment time; product and business date already travel with the record."""
    return rows.withColumns({"domain": F.lit(DOMAIN), "enriched_at": clock})
