"""Run and step facts, built for all runs of a batch at once from one state row per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice.contracts import (
    ERROR_CONTRACT,
    ERROR_THRESHOLD,
    FAILED,
    NAMES,
    RUN_FACT,
    STEP_ENRICH,
    STEP_FACT,
    STEP_FINALIZE,
    STEP_HARMONIZE,
    STEP_INIT,
    STEP_LANDING,
    STEP_VALIDATE,
    SUCCEEDED,
    LakeNames,
)
from sluice.functions import (
    curated_key,
    double_text,
    first_filled,
    object_uri,
    processed_key,
    raw_key,
    rejected_key,
)
from sluice.operators.gate import exceeded, reject_percent, threshold_message


def fact_dimensions(contexts: DataFrame, run_id: Column | None = None) -> DataFrame:
    """Ids, product, domain and day key every fact row carries, each with its fallback chain."""
    given = F.lit(None).cast("string") if run_id is None else run_id
    run = first_filled(F.col("run_id"), given)
    ingestion = F.coalesce(first_filled(F.col("ingestion_id"), run), F.lit("unknown"))
    return contexts.withColumns(
        {
            "ingestion_id": ingestion,
            "execution_id": F.coalesce(first_filled(F.col("execution_id"), run), F.lit("unknown")),
            "correlation_id": first_filled(F.col("correlation_id"), ingestion),
            "product": F.coalesce("product", F.lit("unknown")),
            "domain": F.coalesce(first_filled(F.col("domain")), F.lit("unknown")),
        }
    )


def _keys(names: LakeNames) -> dict[str, Column]:
    where = (F.col("product"), F.col("business_day"), F.col("run_id"), F.col("file_name"))
    processed = processed_key(*where)
    return {
        "raw_key": raw_key(*where),
        "processed_key": processed,
        "curated_key": curated_key(processed),
        "h_rejected_key": rejected_key(F.lit("harmonization"), *where),
        "e_rejected_key": rejected_key(F.lit("enrichment"), *where),
        "file_failed_key": rejected_key(F.lit("file-failed"), *where),
    }


def _data_uri(key: str, names: LakeNames) -> Column:
    return object_uri(F.lit(names.data_bucket), F.col(key), names)


def harmonize_states(
    contexts: DataFrame, files: DataFrame, schemas: DataFrame, counts: DataFrame, names: LakeNames = NAMES
) -> DataFrame:
    """One row per run with what happened up to harmonisation and, in ``h_error``, why it stopped there.

    ``contexts``: accepted and refused events. ``files``: run_id, file_size of found sources.
    """
    counted = counts.select(
        "run_id",
        F.col("total").alias("h_total"),
        F.col("rejected").alias("h_rejected"),
        F.col("first_reason").alias("h_reason"),
    )
    joined = contexts.join(files, "run_id", "left").join(schemas, "run_id", "left").join(counted, "run_id", "left")
    zero = F.lit(0).cast("bigint")
    s = joined.withColumns(
        {c: F.coalesce(c, zero) for c in ("h_total", "h_rejected")} | _keys(names)
    )
    over = exceeded(F.col("h_rejected"), F.col("h_total"), F.col("max_error_percent"), F.col("max_error_count"))
    usable = F.coalesce("schema_ok", F.lit(False))
    s = s.withColumns(
        {
            "landed": (F.col("outcome") == "accepted") & F.col("file_size").isNotNull(),
            "landing_error": F.when(
                (F.col("outcome") == "accepted") & F.col("file_size").isNull(),
                F.concat(
                    F.lit("s3 object not found: "), object_uri(F.col("source_bucket"), F.col("source_key"), names)
                ),
            ),
            "schema_error": F.when(
                F.col("mapping_error").isNull() & (F.col("missing_columns") != ""),
                F.concat(F.lit("file missing source columns: "), F.col("missing_columns")),
            ),
            "h_exceeded": F.coalesce(usable & over, F.lit(False)),
        }
    )
    message = threshold_message(
        F.col("h_rejected"),
        F.col("h_total"),
        F.col("max_error_percent"),
        F.col("max_error_count"),
        _data_uri("h_rejected_key", names),
    )
    return s.withColumns(
        {
            "h_error": F.coalesce("mapping_error", "schema_error", F.when(F.col("h_exceeded"), message)),
            "harmonized": F.col("landed") & usable & ~F.col("h_exceeded"),
        }
    )


def run_states(states: DataFrame, counts: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """Add the enrichment outcome and the run's verdict: the first failing step wins."""
    counted = counts.select(
        "run_id",
        F.col("total").alias("e_total"),
        F.col("rejected").alias("e_rejected"),
        F.col("processed_bytes").alias("h_bytes"),
        F.col("accepted_bytes").alias("e_bytes"),
        F.col("first_reason").alias("e_reason"),
    )
    zero = F.lit(0).cast("bigint")
    s = states.join(counted, "run_id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("e_total", "e_rejected", "h_bytes", "e_bytes")}
    )
    limits = (F.col("max_error_percent"), F.col("max_error_count"))
    over = F.coalesce(exceeded(F.col("e_rejected"), F.col("e_total"), *limits), F.lit(False))
    s = s.withColumn("e_exceeded", F.col("harmonized") & over)
    message = threshold_message(F.col("e_rejected"), F.col("e_total"), *limits, _data_uri("e_rejected_key", names))
    s = s.withColumn("e_error", F.when(F.col("e_exceeded"), message))
    error = F.coalesce("reason", "landing_error", "h_error", "e_error")
    s = s.withColumns(
        {
            "error": error,
            "status": F.when(error.isNull(), SUCCEEDED).otherwise(FAILED),
            "failure_step": F.when(F.col("reason").isNotNull(), STEP_VALIDATE)
            .when(F.col("landing_error").isNotNull(), STEP_LANDING)
            .when(F.col("h_error").isNotNull(), STEP_HARMONIZE)
            .when(F.col("e_error").isNotNull(), STEP_ENRICH)
            .otherwise(""),
            "curated": F.col("harmonized") & ~F.col("e_exceeded"),
            "valid": F.col("outcome") == "accepted",
        }
    )
    h_written = F.col("landed") & F.coalesce("schema_ok", F.lit(False)) & (F.col("h_rejected") > 0)
    e_written = F.col("harmonized") & (F.col("e_rejected") > 0)
    return s.withColumns(
        {
            "h_rejected": F.when(h_written, F.col("h_rejected")).otherwise(zero),
            "rejected_keys": F.filter(
                F.array(F.when(h_written, F.col("h_rejected_key")), F.when(e_written, F.col("e_rejected_key"))),
                lambda k: k.isNotNull(),
            ),
            "domain": F.when(F.col("valid"), F.col("config_domain")).otherwise("unknown"),
        }
    )


def _conform(rows: DataFrame, schema: T.StructType, columns: dict[str, Column]) -> DataFrame:
    """Select the given columns; those of the schema that are not given become NULL."""
    return rows.select(*[c.alias(n) for n, c in columns.items()]).to(schema)


def _dimensions() -> dict[str, Column]:
    names = ("anomesdia", "ingestion_id", "execution_id", "correlation_id", "product", "domain")
    return {n: F.col(n) for n in names}


def seconds_between(started: Column, finished: Column) -> Column:
    return F.unix_timestamp(finished, "yyyy-MM-dd'T'HH:mm:ssxxx") - F.unix_timestamp(started, "yyyy-MM-dd'T'HH:mm:ssxxx")


def ingestion_runs(states: DataFrame, started: Column, finished: Column, names: LakeNames = NAMES) -> DataFrame:
    def path(flag: str, key: str) -> Column:
        return F.when(F.col(flag), _data_uri(key, names)).otherwise("")

    zero = F.lit(0)
    rejected_paths = F.transform(
        "rejected_keys", lambda k: F.concat(F.lit(f"{names.scheme}://{names.data_bucket}/"), k)
    )
    return _conform(
        states,
        RUN_FACT,
        {
            **_dimensions(),
            "source_system": F.col("source_system"),
            "source_bucket": F.col("source_bucket"),
            "source_key": F.col("source_key"),
            "source_file_name": F.col("file_name"),
            "source_file_etag": F.coalesce("source_file_etag", F.lit("")),
            "status": F.col("status"),
            "failure_step": F.col("failure_step"),
            "started_at": started,
            "finished_at": finished,
            "duration_seconds": seconds_between(started, finished),
            "total_records": F.when(F.col("landed"), F.col("h_total")).otherwise(zero),
            "processed_records": F.when(F.col("harmonized"), F.col("h_total") - F.col("h_rejected")).otherwise(zero),
            "rejected_records": F.col("h_rejected") + F.col("e_rejected"),
            "error_records": (F.col("status") == FAILED).cast("int"),
            "raw_path": path("landed", "raw_key"),
            "processed_path": path("harmonized", "processed_key"),
            "curated_path": path("curated", "curated_key"),
            "rejected_path": F.concat_ws(", ", rejected_paths),
            "error_message": F.coalesce("error", F.lit("")),
        },
    )


def _step(
    name: str, order: int, job: str, ok: Column, started: Column, finished: Column, **fields: Column
) -> dict[str, Column]:
    """A step row's core block over its defaults."""
    defaults = {
        "attempt": F.lit(1),
        "rejected_records": F.lit(0),
        "error_message": F.lit(""),
        "input_records": F.lit(0),
        "output_records": F.lit(0),
        "input_path": F.lit(""),
        "output_path": F.lit(""),
    }
    return {
        **_dimensions(),
        **defaults,
        "step_name": F.lit(name),
        "step_order": F.lit(order),
        "glue_job_name": F.lit(job),
        "glue_job_run_id": F.col("execution_id"),
        "status": F.when(ok, SUCCEEDED).otherwise(FAILED),
        "started_at": started,
        "finished_at": finished,
        "duration_seconds": seconds_between(started, finished),
        "error_records": F.when(ok, 0).otherwise(1),
        **fields,
    }


def _only(condition: Column, block: dict[str, Column]) -> dict[str, Column]:
    return {k: F.when(condition, c) for k, c in block.items()}


def _error(failed: Column, text: Column, kind: Column, code: Column, bucket: Column, key: Column, at: Column, names: LakeNames):
    block = _only(
        failed,
        {
            "error_type": kind,
            "error_code": code,
            "error_category": F.lit("pipeline"),
            "source_bucket": bucket,
            "source_key": key,
            "payload_ref": object_uri(bucket, key, names),
            "occurred_at": at,
        },
    )
    return {**block, "error_message": F.when(failed, text).otherwise("")}


def _rejection(rejected: Column, total: Column, reason: Column, category: str, key: str, names: LakeNames):
    return _only(
        rejected > 0,
        {
            "rejection_reason": reason,
            "rejection_category": F.lit(category),
            "rejected_count_summary": rejected,
            "total_step_records_summary": total,
            "rejection_percent": reject_percent(rejected, total, 0.0),
            "rejected_detail_path": _data_uri(key, names),
            "sample_message": reason,
        },
    )


def _quality(ok: Column, rule: str, kind: str, rejected: Column, total: Column, details: Column, at: Column):
    return _only(
        ok,
        {
            "rule_name": F.lit(rule),
            "rule_type": F.lit(kind),
            "rule_result": F.when(rejected > 0, FAILED).otherwise(SUCCEEDED),
            "valid_records": total - rejected,
            "invalid_records": rejected,
            "warning_records": F.lit(0),
            "threshold_value": double_text(F.col("max_error_percent")),
            "measured_value": double_text(reject_percent(rejected, total, 0.0)),
            "quality_details": details,
            "measured_at": at,
        },
    )


def _lineage(ok, kind, role, bucket, key, fmt, records, size, parent_bucket, parent_key, at):
    return _only(
        ok,
        {
            "artifact_type": F.lit(kind),
            "artifact_role": F.lit(role),
            "lineage_bucket": bucket,
            "lineage_key": key,
            "lineage_format": F.lit(fmt),
            "record_count_lineage": records,
            "file_size_bytes": size,
            "parent_bucket": parent_bucket,
            "parent_key": parent_key,
            "lineage_created_at": at,
        },
    )


def init_steps(states: DataFrame, started: Column, finished: Column) -> DataFrame:
    row = _step(STEP_INIT, 1, "local_sfn_runner", F.lit(True), started, finished)
    return _conform(states, STEP_FACT, {**row, "domain": F.lit("unknown")})


def landing_steps(states: DataFrame, started: Column, finished: Column, names: LakeNames = NAMES) -> DataFrame:
    ok = F.col("landed")
    source = (F.col("source_bucket"), F.col("source_key"))
    total = F.when(ok, F.col("h_total")).otherwise(0)
    row = _step(
        STEP_LANDING,
        2,
        "glue_landing",
        ok,
        started,
        finished,
        input_records=total,
        output_records=total,
        input_path=object_uri(*source, names),
        output_path=_data_uri("raw_key", names),
        **_error(~ok, F.col("landing_error"), F.lit(ERROR_CONTRACT), F.lit("landing_failed"), *source, finished, names),
        **_lineage(
            ok, "raw", "landing_output", F.lit(names.data_bucket), F.col("raw_key"), "csv",
            F.col("h_total"), F.col("file_size"), *source, finished,
        ),
    )
    return _conform(states.filter("valid"), STEP_FACT, row)


def harmonize_steps(states: DataFrame, started: Column, finished: Column, names: LakeNames = NAMES) -> DataFrame:
    """One row per landed run. A failed row keeps its schema or rejection block, whichever explains it."""
    ok, over = F.col("harmonized"), F.col("h_exceeded")
    drift = F.col("schema_error").isNotNull()
    bucket = F.lit(names.data_bucket)
    total, bad = F.col("h_total"), F.col("h_rejected")
    good = total - bad
    schema = _only(
        ok | drift,
        {
            "schema_name": F.lit("source_layout_mapping"),
            "schema_version": F.lit("v1"),
            "validation_result": F.when(ok, SUCCEEDED).otherwise(FAILED),
            "missing_columns": F.col("missing_columns"),
            "unexpected_columns": F.when(ok, F.col("unexpected_columns")).otherwise(""),
            "invalid_types": F.lit(""),
            "validation_message": F.when(ok, "source columns satisfied mapping").otherwise(F.col("schema_error")),
            "validated_at": finished,
        },
    )
    row = _step(
        STEP_HARMONIZE,
        3,
        "glue_harmonization",
        ok,
        started,
        finished,
        input_records=F.when(ok | over, total).otherwise(0),
        output_records=F.when(ok, good).otherwise(0),
        rejected_records=bad,
        input_path=_data_uri("raw_key", names),
        output_path=_data_uri("processed_key", names),
        **_error(
            ~ok,
            F.col("h_error"),
            F.when(over, ERROR_THRESHOLD).otherwise(ERROR_CONTRACT),
            F.when(drift, "harmonization_schema_failed").otherwise("harmonization_failed"),
            bucket,
            F.col("raw_key"),
            finished,
            names,
        ),
        **schema,
        **_quality(
            ok, "required_domain_fields", "completeness", bad, total,
            F.concat(F.lit("mapping="), F.col("mapping_key")), finished,
        ),
        **_rejection(bad, total, F.col("h_reason"), "required_field_validation", "h_rejected_key", names),
        **_lineage(
            ok, "processed", "harmonization_output", bucket, F.col("processed_key"), "parquet",
            good, F.col("h_bytes"), bucket, F.col("raw_key"), finished,
        ),
    )
    return _conform(states.filter("landed"), STEP_FACT, row)


def enrich_steps(states: DataFrame, started: Column, finished: Column, names: LakeNames = NAMES) -> DataFrame:
    ok = F.col("curated")
    bucket = F.lit(names.data_bucket)
    total, bad = F.col("e_total"), F.col("e_rejected")
    row = _step(
        STEP_ENRICH,
        4,
        "enrichment_batch",
        ok,
        started,
        finished,
        input_records=total,
        output_records=F.when(ok, total - bad).otherwise(0),
        rejected_records=bad,
        input_path=_data_uri("processed_key", names),
        output_path=_data_uri("curated_key", names),
        **_error(
            ~ok, F.col("e_error"), F.lit(ERROR_THRESHOLD), F.lit("enrichment_failed"), bucket,
            F.col("processed_key"), finished, names,
        ),
        **_quality(
            ok, "enrichment_success_rate", "enrichment", bad, total, F.lit("enrichment batch summary"), finished
        ),
        **_rejection(bad, total, F.col("e_reason"), "enrichment_lookup", "e_rejected_key", names),
        **_lineage(
            ok, "curated", "enrichment_output", bucket, F.col("curated_key"), "parquet",
            total - bad, F.col("e_bytes"), bucket, F.col("processed_key"), finished,
        ),
    )
    return _conform(states.filter("harmonized"), STEP_FACT, row)


def ingestion_steps(states: DataFrame, started: Column, finished: Column, names: LakeNames = NAMES) -> DataFrame:
    steps = init_steps(states, started, finished)
    for build in (landing_steps, harmonize_steps, enrich_steps):
        steps = steps.unionByName(build(states, started, finished, names))
    return steps


def latest(facts: DataFrame, *key: str) -> DataFrame:
    """Last write per fact key; a re-delivered execution replaces its earlier facts.

    Clocks have seconds, so batches decide between equal times: by the number their id ends in, then by the id.
    """
    order = [F.col("finished_at").desc()]
    if "batch_id" in facts.columns:
        number = F.expr("try_cast(regexp_extract(batch_id, '([0-9]+)$', 1) as decimal(38, 0))")
        order += [number.desc_nulls_last(), F.col("batch_id").desc()]
    newest = Window.partitionBy(*key).orderBy(*order)
    return facts.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_runs(runs: DataFrame) -> DataFrame:
    return latest(runs, "anomesdia", "execution_id")


def latest_steps(steps: DataFrame) -> DataFrame:
    return latest(steps, "anomesdia", "execution_id", "step_name", "status")


def manifests(states: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """Where each successful run's data went."""
    uri = f"{names.scheme}://{names.data_bucket}/"
    return states.filter(F.col("status") == SUCCEEDED).select(
        "run_id",
        "ingestion_id",
        "execution_id",
        "anomesdia",
        "product",
        "business_date",
        _data_uri("raw_key", names).alias("raw"),
        _data_uri("processed_key", names).alias("processed"),
        _data_uri("curated_key", names).alias("curated"),
        F.transform("rejected_keys", lambda k: F.concat(F.lit(uri), k)).alias("rejected"),
        (F.col("h_rejected") + F.col("e_rejected")).alias("rejected_rows"),
        F.lit(f"{uri}curated/ -> {names.notification_queue}").alias("curated_notification"),
        F.lit(names.analytics_bucket).alias("analytics_bucket"),
    )


def _contract_failure() -> Column:
    return F.col("valid") & (F.col("status") == FAILED) & ~F.col("h_exceeded") & ~F.col("e_exceeded")


def file_failures(states: DataFrame) -> DataFrame:
    """One record per validated run that broke a contract; threshold failures have their rejected rows instead."""
    return states.filter(_contract_failure()).select(
        "run_id",
        F.lit("file-failed").alias("stage"),
        F.col("failure_step").alias("failed_step"),
        "product",
        "business_date",
        "business_day",
        "file_name",
        F.col("error").alias("reason"),
        F.col("file_failed_key").alias("key"),
    )


def failure_events(states: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """File-failed events of validated runs: counts for threshold failures, none for contract failures."""
    over_h, over_e = F.col("h_exceeded"), F.col("e_exceeded")
    return states.filter(F.col("valid") & (F.col("status") == FAILED)).select(
        "run_id",
        "product",
        "business_date",
        "file_name",
        F.when(over_h, F.col("h_rejected")).when(over_e, F.col("e_rejected")).alias("rows_rejected"),
        F.when(over_h, F.col("h_total")).when(over_e, F.col("e_total")).alias("rows_total"),
        "error",
        F.lit(names.data_bucket).alias("source_bucket"),
        F.when(over_h, F.col("h_rejected_key"))
        .when(over_e, F.col("e_rejected_key"))
        .otherwise(F.col("file_failed_key"))
        .alias("source_key"),
    )


def evidence(states: DataFrame) -> DataFrame:
    """Per run: every state it went through in order, OK or FAIL, and the run's verdict."""

    def entry(happened: Column, name: str) -> Column:
        return F.when(happened, F.lit(f"{name}:OK"))

    def failed(step: str) -> Column:
        return F.when(F.col("failure_step") == step, F.lit(f"{step}:FAIL"))

    landed, harmonized, done = F.col("landed"), F.col("harmonized"), F.col("curated")
    steps = F.array_compact(
        F.array(
            entry(F.lit(True), STEP_INIT),
            failed(STEP_VALIDATE),
            entry(F.col("valid"), "ProductConfig"),
            failed(STEP_LANDING),
            entry(landed, STEP_LANDING),
            failed(STEP_HARMONIZE),
            entry(harmonized, STEP_HARMONIZE),
            entry(harmonized & (F.col("h_rejected") > 0), "RejectedRecords"),
            failed(STEP_ENRICH),
            entry(done, STEP_ENRICH),
            entry(done & (F.col("e_rejected") > 0), "RejectedRecords"),
            entry(done, "S3Notification"),
            entry(done, "Manifest"),
            entry(done, STEP_FINALIZE),
        )
    )
    return states.select(
        "run_id",
        "product",
        "file_name",
        "business_date",
        F.when(F.col("status") == FAILED, "FAIL").otherwise("OK").alias("status"),
        F.size(steps).alias("step_count"),
        F.concat_ws(", ", steps).alias("steps"),
        F.coalesce("error", F.lit("")).alias("error"),
    )
