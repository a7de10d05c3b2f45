"""Ad-hoc operational reports: narrower than the views, and sorted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from sluice.contracts import SUCCEEDED
from sluice.functions import date_key
from sluice.plans.views import errors_with_source, filled


def runs_by_status(runs: DataFrame) -> DataFrame:
    measures = ("total_records", "processed_records", "rejected_records")
    totals = [F.sum(m).alias(m) for m in measures]
    grouped = runs.groupBy("anomesdia", "product", "status").agg(F.count(F.lit(1)).alias("total_runs"), *totals)
    return grouped.orderBy("anomesdia", "product")


def troubleshooting_dashboard(runs: DataFrame) -> DataFrame:
    return runs.select(
        "anomesdia",
        "product",
        F.col("status").alias("run_status"),
        "source_bucket", "source_key", "source_file_name", "total_records", "processed_records",
        "rejected_records", "error_records", "failure_step",
        F.col("error_message").alias("run_error"),
        "raw_path", "processed_path", "curated_path", "rejected_path",
    ).orderBy("anomesdia", "product")


def steps_summary(steps: DataFrame) -> DataFrame:
    totals = [F.sum(m).alias(m) for m in ("input_records", "output_records", "rejected_records")]
    keys = ["anomesdia", "product", "step_order", "step_name"]
    return steps.groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("attempts"), *totals).orderBy(*keys)


def errors_from_steps(steps: DataFrame) -> DataFrame:
    return (
        steps.filter(filled("error_message"))
        .select(
            "anomesdia", "product", "step_name", "error_type", "error_code", "error_message", "error_category",
            "source_bucket", "source_key", "occurred_at",
        )
        .orderBy("anomesdia", "product", "occurred_at")
    )


def quality_from_steps(steps: DataFrame) -> DataFrame:
    keys = ["anomesdia", "product", "step_name", "rule_name", "rule_type", "rule_result"]
    totals = [F.sum(m).alias(m) for m in ("valid_records", "invalid_records")]
    return steps.filter(filled("rule_name")).groupBy(*keys).agg(*totals).orderBy("anomesdia", "product")


def schema_from_steps(steps: DataFrame) -> DataFrame:
    return (
        steps.filter(filled("schema_name"))
        .select(
            "anomesdia", "product", "step_name", "schema_name", "validation_result",
            "missing_columns", "unexpected_columns", "validated_at",
        )
        .orderBy("anomesdia", "product", "validated_at")
    )


def rejections_from_steps(steps: DataFrame) -> DataFrame:
    keys = ["anomesdia", "product", "step_name", "rejection_reason", "rejection_category"]
    grouped = steps.filter(filled("rejection_reason")).groupBy(*keys)
    return grouped.agg(
        F.sum("rejected_count_summary").alias("total_rejected"),
        F.round(F.avg("rejection_percent"), 2).alias("avg_pct"),
        F.min("rejected_detail_path").alias("detail_path"),
        F.min("sample_message").alias("sample"),
    ).orderBy("anomesdia", "product")


def lineage_from_steps(steps: DataFrame) -> DataFrame:
    keys = ["anomesdia", "product", "artifact_type"]
    counts = [F.count(F.lit(1)).alias("files"), F.sum("record_count_lineage").alias("total_records")]
    return steps.filter(filled("artifact_type")).groupBy(*keys).agg(*counts).orderBy(*keys)


def curated_with_run_context(curated: DataFrame, runs: DataFrame) -> DataFrame:
    """Curated records per product, date and domain with the status of the day's successful runs.

    Records are counted before the join and multiplied by the matching runs, so the join meets one row per group
    instead of every record.
    """
    keys = ["product", "business_date", "domain"]
    counted = curated.groupBy(*keys).agg(F.count(F.lit(1)).alias("_records"))
    matching = (
        runs.filter(F.col("status") == SUCCEEDED)
        .groupBy("product", F.col("anomesdia").alias("_day"), F.col("status").alias("run_status"))
        .agg(F.count(F.lit(1)).alias("_runs"))
    )
    joined = counted.withColumn("_day", date_key(F.col("business_date"))).join(matching, ["product", "_day"], "left")
    records = F.col("_records") * F.coalesce("_runs", F.lit(1).cast("bigint"))
    return joined.select(*keys, records.alias("curated_records"), "run_status").orderBy("product", "business_date")


def rejected_detail(rejected: DataFrame) -> DataFrame:
    counted = rejected.groupBy("product", "stage", "reason").agg(F.count(F.lit(1)).alias("rows"))
    return counted.orderBy("product", "stage")


def error_detail_with_source(steps: DataFrame, runs: DataFrame) -> DataFrame:
    return errors_with_source(steps, runs).drop("ingestion_id", "execution_id").orderBy(
        "anomesdia", "product", "occurred_at"
    )


# report: how to build it, and the tables it reads
REPORTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "runs_by_status": (runs_by_status, ("ingestion_runs",)),
    "troubleshooting_dashboard": (troubleshooting_dashboard, ("ingestion_runs",)),
    "steps_summary": (steps_summary, ("ingestion_steps",)),
    "errors_from_steps": (errors_from_steps, ("ingestion_steps",)),
    "quality_from_steps": (quality_from_steps, ("ingestion_steps",)),
    "schema_from_steps": (schema_from_steps, ("ingestion_steps",)),
    "rejections_from_steps": (rejections_from_steps, ("ingestion_steps",)),
    "lineage_from_steps": (lineage_from_steps, ("ingestion_steps",)),
    "curated_with_run_context": (curated_with_run_context, ("curated", "ingestion_runs")),
    "rejected_detail": (rejected_detail, ("rejected",)),
    "error_detail_with_source": (error_detail_with_source, ("ingestion_steps", "ingestion_runs")),
}
