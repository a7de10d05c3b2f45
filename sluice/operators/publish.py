"""Downstream messages: one per record and configured destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.contracts import (
    CURATED_COLUMNS,
    FILE_FAILED,
    NAMES,
    RECORD_READY,
    RECORDS_REJECTED,
    REJECTED_COLUMNS,
    ZONE_DATE_KEYS,
    LakeNames,
    struct,
)
from sluice.functions import sorted_json, stem

CURATED_FIELDS = struct(CURATED_COLUMNS).fieldNames()
REJECTED_FIELDS = struct(REJECTED_COLUMNS).fieldNames()


def zone_key(zone: str | Column, leaf: Column) -> Column:
    """Logical key of the file a zone row belongs to, from the row's partition columns."""
    folder = F.lit(zone) if isinstance(zone, str) else zone
    dates = [F.concat(F.lit(f"{k}="), F.col(k)) for k in ZONE_DATE_KEYS]
    return F.concat_ws("/", folder, F.col("product"), *dates, F.col("run_id"), leaf)


def fan_out(rows: DataFrame, configs: DataFrame, destinations: Column) -> DataFrame:
    """Repeat every row for each destination its product lists. ``configs`` has one row per product."""
    routes = configs.select("product", destinations.alias("_destinations"))
    return rows.join(routes, "product").withColumn("destination", F.explode("_destinations")).drop("_destinations")


def record_ready(curated: DataFrame, configs: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """Curated record × publish destination."""
    leaf = F.concat(stem(F.col("file_name")), F.lit(".parquet"))
    return fan_out(curated, configs, F.col("publish.destinations")).withColumns(
        {
            "event_type": F.lit(RECORD_READY),
            "source_bucket": F.lit(names.data_bucket),
            "source_key": zone_key("curated", leaf),
        }
    )


def records_rejected(rejected: DataFrame, configs: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """Rejected record × quality destination. File-failure records have their own message type and stay out."""
    leaf = F.concat(stem(F.col("file_name")), F.lit(".jsonl"))
    rows = rejected.filter(F.col("stage") != "file-failed")
    return fan_out(rows, configs, F.col("quality_destinations")).withColumns(
        {
            "event_type": F.lit(RECORDS_REJECTED),
            "source_bucket": F.lit(names.data_bucket),
            "source_key": zone_key(F.concat(F.lit("rejected/"), F.col("stage")), leaf),
        }
    )


def file_failed(failures: DataFrame, configs: DataFrame) -> DataFrame:
    """Failed validated run × quality destination; ``failures`` comes from the facts' failure events."""
    return fan_out(failures, configs, F.col("quality_destinations")).withColumn("event_type", F.lit(FILE_FAILED))


def _envelope(**body: Column) -> dict[str, Column]:
    return {
        **{k: F.col(k) for k in ("event_type", "destination", "run_id", "product")},
        "source": F.struct(F.col("source_bucket").alias("bucket"), F.col("source_key").alias("key")),
        **body,
    }


def _message(rows: DataFrame, record_key: Column, payload: Column) -> DataFrame:
    return rows.select(
        "run_id", "product", record_key.alias("record_key"), payload.alias("payload"), "event_type", "destination"
    )


def record_ready_messages(rows: DataFrame) -> DataFrame:
    record = F.struct(*[F.col(f) for f in sorted(CURATED_FIELDS)])
    return _message(rows, F.col("row_number").cast("string"), sorted_json(**_envelope(record=record)))


def records_rejected_messages(rows: DataFrame) -> DataFrame:
    fields = {f: F.col(f) for f in REJECTED_FIELDS} | {"raw_row": F.from_json("raw_row", "map<string,string>")}
    record = F.struct(*[fields[f].alias(f) for f in sorted(fields)])
    key = F.concat_ws("/", "stage", F.col("row_number").cast("string"))
    return _message(rows, key, sorted_json(**_envelope(rejected_record=record)))


def file_failed_messages(rows: DataFrame) -> DataFrame:
    counted = F.struct(F.col("rows_rejected").alias("rejected"), F.col("rows_total").alias("total"))
    body = {k: F.col(k) for k in ("business_date", "file_name", "error")} | {"rows": counted}
    fields = _envelope(**body)
    # absent counts leave an empty object
    payload = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))
    return _message(rows, F.lit(""), payload)


def destination_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("destination", "event_type").agg(F.count(F.lit(1)).alias("messages"))


def publish_summary(routed: DataFrame, configs: DataFrame, message: str) -> DataFrame:
    """Messages received, messages that published anything, and the destinations reached.

    ``routed``: notification records after routing, with ``message`` identifying the message each came from.
    """
    lookup = configs.select("product", F.col("publish.destinations").alias("_publish"), "quality_destinations")
    reached = (
        routed.join(lookup, "product", "left")
        .withColumn(
            "_to",
            F.when(
                F.col("reason").isNull(),
                F.when(F.col("route") == "rejected", F.col("quality_destinations")).otherwise(F.col("_publish")),
            ),
        )
        .select(message, "_to")
    )
    size = F.size(F.coalesce("_to", F.array().cast("array<string>")))
    per_message = reached.groupBy(message).agg(F.max(size).alias("_n"))
    one, zero, no_name = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.lit(None).cast("string")
    messages = per_message.select(one.alias("r"), (F.col("_n") > 0).cast("bigint").alias("p"), no_name.alias("d"))
    # the distinct names are as few as the configured destinations
    names = reached.select(zero.alias("r"), zero.alias("p"), F.explode("_to").alias("d")).distinct()
    return messages.unionByName(names).agg(
        F.sum("r").alias("received_messages"),
        F.sum("p").alias("processed_messages"),
        F.concat_ws(", ", F.array_sort(F.collect_set("d"))).alias("published_destinations"),
    )
