"""Object-created notifications and their routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.contracts import FILE_FAILED, RECORDS_REJECTED, struct
from sluice.functions import product_from_key, run_id_from_key

_RECORD = struct("eventName string", s3=T.StructType([
    T.StructField("bucket", struct("name string")),
    T.StructField("object", struct("key string")),
]))
_NOTE = struct(
    "Event string, event_type string, bucket string, key string, run_id string, product string",
    Records=T.ArrayType(_RECORD),
)
REASON_NOT_A_NOTIFICATION = "message is not S3 notification"


def notification_records(messages: DataFrame, body: str = "value") -> DataFrame:
    """Messages to (bucket, key) rows: notification records, a direct ``{bucket, key}``, or an error row.

    Test notifications vanish. Keys of notification records arrive URL-encoded; direct keys are plain.
    """
    note = messages.withColumn("_n", F.from_json(body, _NOTE))
    usable = F.filter(
        F.coalesce(F.col("_n.Records"), F.array().cast(_NOTE["Records"].dataType)),
        lambda r: (F.coalesce(r["s3"]["bucket"]["name"], F.lit("")) != "")
        & (F.coalesce(r["s3"]["object"]["key"], F.lit("")) != ""),
    )
    listed = F.transform(
        usable,
        lambda r: F.struct(
            r["s3"]["bucket"]["name"].alias("bucket"), F.url_decode(r["s3"]["object"]["key"]).alias("key")
        ),
    )
    direct = F.array(F.struct(F.col("_n.bucket").alias("bucket"), F.col("_n.key").alias("key")))
    has_direct = F.col("_n.bucket").isNotNull() & F.col("_n.key").isNotNull()
    # an unusable message still yields one row, with neither bucket nor key and a reason
    rows = F.when(F.size(listed) > 0, listed).otherwise(direct)
    kept = messages.columns
    return (
        note.filter(~F.col("_n.Event").eqNullSafe("s3:TestEvent"))
        .select(
            *kept,
            F.col("_n.event_type").alias("event_type"),
            F.col("_n.run_id").alias("message_run_id"),
            F.col("_n.product").alias("message_product"),
            F.when((F.size(listed) == 0) & ~has_direct, F.lit(REASON_NOT_A_NOTIFICATION)).alias("reason"),
            F.explode(rows).alias("r"),
        )
        .select(*kept, "event_type", "message_run_id", "message_product", "reason", "r.bucket", "r.key")
        .withColumns(
            {
                "bucket": F.when(F.col("reason").isNull(), F.col("bucket")),
                "key": F.when(F.col("reason").isNull(), F.col("key")),
            }
        )
    )


def route(event_type: Column, key: Column) -> Column:
    """Rejected files and quality messages go to the quality destinations, everything else is curated data."""
    quality = key.startswith("rejected/") | event_type.isin(RECORDS_REJECTED, FILE_FAILED)
    return F.when(F.coalesce(quality, F.lit(False)), F.lit("rejected")).otherwise(F.lit("curated"))


def route_messages(records: DataFrame) -> DataFrame:
    """Route, product and run of every usable notification record; a key outside both zones gets a reason."""
    product = F.coalesce(F.nullif(F.col("message_product"), F.lit("")), product_from_key(F.col("key")))
    routed = records.withColumn("route", route(F.col("event_type"), F.col("key")))
    product = F.when(F.col("route") == "rejected", product).otherwise(product_from_key(F.col("key")))
    run_id = F.when(
        F.col("route") == "rejected",
        F.coalesce(F.nullif(F.col("message_run_id"), F.lit("")), run_id_from_key(F.col("key"))),
    ).otherwise(run_id_from_key(F.col("key")))
    return routed.withColumns({"product": product, "run_id": run_id}).withColumn(
        "reason",
        F.coalesce(
            "reason",
            F.when(F.col("product").isNull(), F.concat(F.lit("unexpected pipeline file key: "), F.col("key"))),
        ),
    )
