"""Names, texts and table schemas every module agrees on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: the shared domain, its required fields and the default rejection policy ---
DOMAIN = "transaction"
DOMAIN_FIELDS = ("transaction_id", "customer_id", "amount", "transaction_date")
DEFAULT_MAX_ERROR_PERCENT = 1.0
DEFAULT_MAX_ERROR_COUNT = 1000
DEFAULT_QUALITY_DESTINATIONS = ("data-quality-events",)

# --- Fixed values: event routing rule and message types ---
EVENT_SOURCE = "local.product-lake"
EVENT_DETAIL_TYPE = "file-ready"
RECORD_READY = "domain_record_ready"
RECORDS_REJECTED = "ingestion.records-rejected"
FILE_FAILED = "ingestion.file-failed"

# --- Fixed values: run states, statuses and reject texts ---
STEP_VALIDATE = "ValidateEvent"
STEP_INIT = "InitExecution"
STEP_LANDING = "LandingGlue"
STEP_HARMONIZE = "HarmonizationGlue"
STEP_ENRICH = "EnrichmentBatch"
STEP_NOTIFY = "CuratedS3Notification"
STEP_FINALIZE = "FinalizeExecution"
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
REASON_NOT_AN_EVENT = "message is not EventBridge file-ready event"
REASON_BAD_DATE = "business_date must use YYYY-MM-DD"
REASON_NO_LOOKUP = "customer not found in enrichment base"
ERROR_CONTRACT = "PipelineError"
ERROR_THRESHOLD = "RejectedRowsThresholdError"


@dataclass(frozen=True)
class LakeNames:
    """Bucket names that appear in logical paths; deployments override them."""

    # --- Fixed values: the default names ---
    scheme: str = "s3"
    source_bucket: str = "product-lake"
    data_bucket: str = "data-lake"
    analytics_bucket: str = "analytics-lake"
    source_system: str = "product-lake"
    notification_queue: str = "curated-files"


NAMES = LakeNames()

# --- Fixed values: declared columns of the tables ---
RUN_COLUMNS = (
    "ingestion_id string, execution_id string, correlation_id string, product string, domain string, "
    "source_system string, source_bucket string, source_key string, source_file_name string, "
    "source_file_etag string, status string, failure_step string, started_at string, finished_at string, "
    "duration_seconds bigint, total_records bigint, processed_records bigint, rejected_records bigint, "
    "error_records bigint, raw_path string, processed_path string, curated_path string, "
    "rejected_path string, error_message string"
)
STEP_COLUMNS = (
    # core
    "ingestion_id string, execution_id string, correlation_id string, product string, domain string, "
    "step_name string, step_order int, attempt int, glue_job_name string, glue_job_run_id string, "
    "status string, started_at string, finished_at string, duration_seconds bigint, input_records bigint, "
    "output_records bigint, rejected_records bigint, error_records bigint, input_path string, "
    "output_path string, "
    # error
    "error_message string, error_type string, error_code string, error_category string, "
    "is_retryable boolean, source_bucket string, source_key string, payload_ref string, occurred_at string, "
    # quality
    "rule_name string, rule_type string, rule_result string, valid_records bigint, invalid_records bigint, "
    "warning_records bigint, threshold_value string, measured_value string, quality_details string, "
    "measured_at string, "
    # schema
    "schema_name string, schema_version string, validation_result string, missing_columns string, "
    "unexpected_columns string, invalid_types string, validation_message string, validated_at string, "
    # rejection
    "rejection_reason string, rejection_category string, rejected_count_summary bigint, "
    "total_step_records_summary bigint, rejection_percent double, rejected_detail_path string, "
    "sample_message string, "
    # lineage
    "artifact_type string, artifact_role string, lineage_bucket string, lineage_key string, "
    "lineage_format string, record_count_lineage bigint, file_size_bytes bigint, parent_bucket string, "
    "parent_key string, lineage_created_at string"
)
PROCESSED_COLUMNS = "transaction_id string, customer_id string, amount string, transaction_date string"
CURATED_COLUMNS = PROCESSED_COLUMNS + ", domain string, product string, business_date string, enriched_at string"
REJECTED_COLUMNS = (
    "run_id string, stage string, product string, business_date string, file_name string, "
    "row_number bigint, reason string, raw_row string"
)
EVENT_COLUMNS = (
    "product string, file_name string, business_date string, run_id string, ingestion_id string, "
    "execution_id string, correlation_id string, anomesdia string, source_system string, "
    "source_bucket string, source_key string, source_file_etag string"
)
# --- end of fixed values ---


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}


def struct(columns: str, **nested: T.DataType) -> T.StructType:
    """Schema from ``name type, …`` plus nested fields; unlike ``fromDDL`` it needs no running session."""
    pairs = [c.split(" ") for c in columns.split(", ")]
    flat = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(flat + [T.StructField(name, kind) for name, kind in nested.items()])


RUN_FACT = struct("anomesdia string, " + RUN_COLUMNS)
STEP_FACT = struct("anomesdia string, " + STEP_COLUMNS)
EVENT = struct(EVENT_COLUMNS)

PRODUCT_CONFIG = struct(
    "domain string, mapping_key string",
    publish=struct("destinations array<string>"),
    rejection_policy=struct("max_error_percent double, max_error_count bigint, destinations array<string>"),
)
LAYOUT_MAPPING = struct(
    "domain string, domain_required_fields array<string>, layout_mapping map<string,string>"
)

# Zone tables carry (run_id, row_number) on top of the declared columns: exact lineage and idempotent publication
# need them, and the declared projections simply leave them out.
ZONE_DATE_KEYS = ("year", "month", "day")
PROCESSED_ZONE = struct(
    "file_name string, row_number bigint, " + PROCESSED_COLUMNS + ", business_date string, product string, year string, month string, day string, run_id string"
)
CURATED_ZONE = struct(
    "file_name string, row_number bigint, " + PROCESSED_COLUMNS + ", domain string, business_date string, enriched_at string, "
    "product string, year string, month string, day string, run_id string"
)
REJECTED_ZONE = struct(
    "business_date string, file_name string, row_number bigint, reason string, raw_row string, "
    "stage string, product string, year string, month string, day string, run_id string"
)
RAW_ZONE = struct(
    "file_path string, block_start bigint, pos bigint, line string, "
    "product string, year string, month string, day string, run_id string"
)
