"""File-ready events: envelopes, validation and execution context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.contracts import (
    EVENT,
    EVENT_DETAIL_TYPE,
    EVENT_SOURCE,
    NAMES,
    REASON_BAD_DATE,
    REASON_NOT_AN_EVENT,
    LakeNames,
)
from sluice.functions import anomesdia, blank, business_day, first_filled, run_id_for, source_key

REQUIRED = ("product", "file_name", "business_date")
EVENT_FIELDS = tuple(EVENT.fieldNames())


def routed(body: Column) -> Column:
    """The bus rule: only file-ready messages of the product lake reach the ingestion queue."""
    return F.coalesce(
        (F.get_json_object(body, "$.source") == EVENT_SOURCE)
        & (F.get_json_object(body, "$['detail-type']") == EVENT_DETAIL_TYPE),
        F.lit(False),
    )


def misrouted(body: Column) -> Column:
    """An envelope that names another source or type. Bare events, and envelopes that name neither, are for us."""
    named = F.get_json_object(body, "$.source").isNotNull() | F.get_json_object(body, "$['detail-type']").isNotNull()
    enveloped = F.get_json_object(body, "$.detail").isNotNull() | F.get_json_object(body, "$.Detail").isNotNull()
    return enveloped & named & ~routed(body)


def event_detail(body: Column) -> Column:
    """The event inside a message: under ``detail``, under ``Detail`` (object or JSON text), or the message itself."""
    keys = F.coalesce(F.json_object_keys(body), F.array().cast("array<string>"))
    bare = F.forall(F.array(*[F.lit(f) for f in REQUIRED]), lambda f: F.array_contains(keys, f))
    return (
        F.when(F.array_contains(keys, "detail"), F.get_json_object(body, "$.detail"))
        .when(F.array_contains(keys, "Detail"), F.get_json_object(body, "$.Detail"))
        .when(bare, body)
    )


def open_envelopes(messages: DataFrame, body: str = "value") -> DataFrame:
    """Messages to event columns; ``reason`` marks those that hold no event."""
    detail = event_detail(F.col(body))
    opened = messages.withColumn("_detail", detail)
    usable = F.coalesce(F.size(F.json_object_keys("_detail")), F.lit(0)) > 0
    return (
        opened.withColumn("_event", F.from_json("_detail", EVENT))
        .withColumn("reason", F.when(~usable, F.lit(REASON_NOT_AN_EVENT)))
        .select(*messages.columns, "_event.*", "reason")
    )


def with_event_columns(events: DataFrame) -> DataFrame:
    """Add the optional event columns a hand-made frame lacks."""
    absent = [f for f in EVENT_FIELDS if f not in events.columns]
    return events.withColumns({f: F.lit(None).cast("string") for f in absent}) if absent else events


def execution_context(events: DataFrame, clock: Column, names: LakeNames = NAMES) -> DataFrame:
    """Fill run, ingestion, execution and correlation ids, the day key and the source location by fallback."""
    e = with_event_columns(events)
    run_id = first_filled(F.col("run_id"), run_id_for([(f, F.col(f)) for f in EVENT_FIELDS], clock))
    e = e.withColumn("run_id", run_id).withColumn("business_day", business_day(F.col("business_date")))
    e = e.withColumn("ingestion_id", first_filled(F.col("ingestion_id"), F.col("run_id")))
    return e.withColumns(
        {
            "execution_id": first_filled(F.col("execution_id"), F.col("run_id")),
            "correlation_id": first_filled(F.col("correlation_id"), F.col("ingestion_id")),
            "anomesdia": first_filled(F.col("anomesdia"), anomesdia(F.col("business_day"))),
            "source_system": first_filled(F.col("source_system"), F.lit(names.source_system)),
            "source_bucket": first_filled(F.col("source_bucket"), F.lit(names.source_bucket)),
            "source_key": first_filled(F.col("source_key"), source_key(F.col("product"), F.col("file_name"))),
        }
    )


def missing_fields(*required: str) -> Column:
    return F.concat_ws(", ", *[F.when(blank(F.col(f)), F.lit(f)) for f in required])


def validate_events(events: DataFrame, configs: DataFrame) -> DataFrame:
    """Look every event's product up and add ``reason`` and ``outcome``.

    ``quarantined`` events cannot be keyed at all (no event, missing fields, malformed date) and never become a
    run; ``refused`` ones become a run that fails validation; ``accepted`` ones go on. ``configs`` comes from
    :func:`sluice.sources.config.validate_configs`.
    """
    lookup = configs.select(
        "product",
        F.col("domain").alias("config_domain"),
        "mapping_key",
        F.col("publish.destinations").alias("publish_destinations"),
        "max_error_percent",
        "max_error_count",
        "quality_destinations",
        "config_error",
        F.lit(True).alias("configured"),
    )
    e = with_event_columns(events)
    if "reason" not in e.columns:
        e = e.withColumn("reason", F.lit(None).cast("string"))
    missing = missing_fields(*REQUIRED)
    unkeyed = F.coalesce(
        F.col("reason"),
        F.when(missing != "", F.concat(F.lit("event missing fields: "), missing)),
        F.when(business_day(F.col("business_date")).isNull(), F.lit(REASON_BAD_DATE)),
    )
    refused = F.when(
        F.col("configured").isNull(), F.concat(F.lit("product not configured: "), F.col("product"))
    ).otherwise(F.col("config_error"))
    checked = e.withColumn("_unkeyed", unkeyed).join(lookup, "product", "left")
    return (
        checked.withColumn("reason", F.coalesce("_unkeyed", refused))
        .withColumn(
            "outcome",
            F.when(F.col("_unkeyed").isNotNull(), "quarantined")
            .when(F.col("reason").isNotNull(), "refused")
            .otherwise("accepted"),
        )
        .drop("_unkeyed", "configured", "config_error")
    )


def unconfigured(events: DataFrame, configs: DataFrame) -> DataFrame:
    """Events whose product has no config."""
    return events.join(configs.select("product"), "product", "left_anti")


def batch_summary(validated: DataFrame) -> DataFrame:
    """How many messages were received, processed and skipped, and why."""
    processed = F.col("outcome") == "accepted"
    return validated.groupBy(
        F.when(processed, "processed").otherwise("skipped").alias("outcome"), F.coalesce("reason", F.lit("")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("messages"))
