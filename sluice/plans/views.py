"""Operational views over the fact tables and their joins with business data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sluice.contracts import SUCCEEDED
from sluice.functions import blank, date_key


def filled(name: str) -> Column:
    return ~blank(F.col(name))


def ingestion_status_by_day(runs: DataFrame) -> DataFrame:
    measures = ("total_records", "processed_records", "rejected_records")
    return runs.groupBy("anomesdia", "product", "domain", "status").agg(
        F.count(F.lit(1)).alias("total_runs"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
        F.coalesce(F.avg("duration_seconds"), F.lit(0.0)).alias("avg_duration_seconds"),
    )


def troubleshooting(runs: DataFrame) -> DataFrame:
    return runs.select(
        "anomesdia",
        "product",
        "domain",
        F.col("status").alias("run_status"),
        "source_bucket", "source_key", "source_file_name", "ingestion_id", "execution_id",
        "total_records", "processed_records", "rejected_records", "error_records", "failure_step",
        F.col("error_message").alias("run_error"),
        "started_at", "finished_at", "raw_path", "processed_path", "curated_path", "rejected_path",
        F.when(F.col("rejected_records") > 0, 1).otherwise(0).alias("has_rejections"),
    )


def ingestion_steps_summary(steps: DataFrame) -> DataFrame:
    measures = ("input_records", "output_records", "rejected_records", "error_records")
    return steps.groupBy("anomesdia", "product", "step_order", "step_name", "status").agg(
        F.count(F.lit(1)).alias("attempts"),
        *[F.sum(m).alias(m) for m in measures],
        F.avg("duration_seconds").alias("avg_duration_seconds"),
    )


def errors_with_source(steps: DataFrame, runs: DataFrame) -> DataFrame:
    own = ["anomesdia", "product", "step_name", "error_type", "error_code", "error_message", "error_category"]
    run = runs.select(
        "ingestion_id", "source_file_name", "execution_id", F.col("status").alias("run_status"),
        F.col("ingestion_id").alias("run_ingestion_id"),
    )
    joined = steps.filter(filled("error_message")).drop("execution_id").join(run, "ingestion_id", "left")
    return joined.select(
        *own,
        "occurred_at", "source_bucket", "source_key", "source_file_name",
        F.col("run_ingestion_id").alias("ingestion_id"),
        "execution_id",
        "run_status",
    )


def quality_results(steps: DataFrame) -> DataFrame:
    """Rule results with the textual minimum of threshold and measure, as the fact table stores them."""
    keys = ["anomesdia", "product", "step_name", "rule_name", "rule_type", "rule_result"]
    return steps.filter(filled("rule_name")).groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in ("valid_records", "invalid_records", "warning_records")],
        *[F.min(m).alias(m) for m in ("threshold_value", "measured_value")],
    )


def quality_results_exact(steps: DataFrame) -> DataFrame:
    """Rule results whose minima compare as numbers."""
    keys = ["anomesdia", "product", "step_name", "rule_name", "rule_type", "rule_result"]
    return steps.filter(filled("rule_name")).groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in ("valid_records", "invalid_records", "warning_records")],
        *[F.min(F.col(m).cast("double")).alias(m) for m in ("threshold_value", "measured_value")],
    )


def schema_validation_results(steps: DataFrame) -> DataFrame:
    return steps.filter(filled("schema_name")).select(
        "anomesdia", "product", "step_name", "schema_name", "schema_version", "validation_result",
        "missing_columns", "unexpected_columns", "validation_message", "validated_at",
    )


def rejections_summary(steps: DataFrame) -> DataFrame:
    keys = ["anomesdia", "product", "step_name", "rejection_reason", "rejection_category"]
    return steps.filter(filled("rejection_reason")).groupBy(*keys).agg(
        F.sum("rejected_count_summary").alias("total_rejected"),
        F.avg("rejection_percent").alias("avg_rejection_percent"),
        F.min("rejected_detail_path").alias("rejected_detail_path"),
        F.min("sample_message").alias("sample_message"),
    )


def file_lineage(steps: DataFrame) -> DataFrame:
    return steps.filter(filled("artifact_type")).select(
        "anomesdia", "product", "step_name", "artifact_type", "artifact_role", "lineage_bucket", "lineage_key",
        "lineage_format", "record_count_lineage", "file_size_bytes", "parent_bucket", "parent_key",
        "lineage_created_at",
    )


_BUSINESS = ["transaction_id", "customer_id", "amount", "transaction_date", "domain", "product", "business_date"]


def _with_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows with the runs of their product and day; several runs of one day repeat the row."""
    return rows.withColumn("_day", date_key(F.col("business_date"))).join(
        runs.withColumn("_day", F.col("anomesdia")), ["product", "_day"], "left"
    )


def _succeeded(runs: DataFrame, *columns: str) -> DataFrame:
    return runs.filter(F.col("status") == SUCCEEDED).select(
        "product", "anomesdia", F.col("status").alias("run_status"), *columns
    )


def curated_with_run_context(curated: DataFrame, runs: DataFrame) -> DataFrame:
    context = ["execution_id", "ingestion_id", "source_bucket", "source_key", "source_file_name"]
    rows = curated.select(*_BUSINESS, "enriched_at")
    return _with_runs(rows, _succeeded(runs, *context)).select(*_BUSINESS, "enriched_at", "run_status", *context)


def rejected_with_context(rejected: DataFrame, runs: DataFrame) -> DataFrame:
    own = ["run_id", "stage", "product", "business_date", "file_name", "row_number", "reason", "raw_row"]
    context = runs.select(
        "product", "anomesdia", F.col("status").alias("run_status"), "ingestion_id", "source_file_name"
    )
    return _with_runs(rejected.select(*own), context).select(*own, "run_status", "ingestion_id", "source_file_name")


def ingested_with_source(curated: DataFrame, runs: DataFrame) -> DataFrame:
    before = ["source_bucket", "source_key", "source_file_name", "ingestion_id", "execution_id"]
    paths = ["raw_path", "processed_path", "curated_path"]
    return _with_runs(curated.select(*_BUSINESS), _succeeded(runs, *before, *paths)).select(
        *_BUSINESS, "anomesdia", *before, "run_status", *paths
    )


def curated_with_run_context_exact(curated: DataFrame, runs: DataFrame) -> DataFrame:
    """As the parity view, but each row meets only the run that wrote it, however often a day was re-ingested."""
    context = ["execution_id", "ingestion_id", "source_bucket", "source_key", "source_file_name"]
    run = runs.select(F.col("execution_id").alias("run_id"), F.col("status").alias("run_status"), *context)
    return curated.join(run, "run_id", "left").select(*_BUSINESS, "enriched_at", "run_status", *context)


def rejected_with_context_exact(rejected: DataFrame, runs: DataFrame) -> DataFrame:
    own = ["run_id", "stage", "product", "business_date", "file_name", "row_number", "reason", "raw_row"]
    run = runs.select(
        F.col("execution_id").alias("run_id"), F.col("status").alias("run_status"), "ingestion_id", "source_file_name"
    )
    return rejected.select(*own).join(run, "run_id", "left").select(
        *own, "run_status", "ingestion_id", "source_file_name"
    )


# view: how to build it, and the tables it reads
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "vw_ingestion_status_by_day": (ingestion_status_by_day, ("ingestion_runs",)),
    "vw_troubleshooting_dashboard": (troubleshooting, ("ingestion_runs",)),
    "vw_ingestion_steps_summary": (ingestion_steps_summary, ("ingestion_steps",)),
    "vw_errors_with_source": (errors_with_source, ("ingestion_steps", "ingestion_runs")),
    "vw_quality_results": (quality_results, ("ingestion_steps",)),
    "vw_schema_validation_results": (schema_validation_results, ("ingestion_steps",)),
    "vw_rejections_summary": (rejections_summary, ("ingestion_steps",)),
    "vw_file_lineage": (file_lineage, ("ingestion_steps",)),
    "vw_curated_with_run_context": (curated_with_run_context, ("curated", "ingestion_runs")),
    "vw_rejected_with_context": (rejected_with_context, ("rejected", "ingestion_runs")),
    "vw_ingested_with_source": (ingested_with_source, ("curated", "ingestion_runs")),
    "vw_quality_results_exact": (quality_results_exact, ("ingestion_steps",)),
    "vw_curated_with_run_context_exact": (curated_with_run_context_exact, ("curated", "ingestion_runs")),
    "vw_rejected_with_context_exact": (rejected_with_context_exact, ("rejected", "ingestion_runs")),
}
