"""The registered queries again as plain SQL over the same tables, written independently of the engine.

Chains of common table expressions stand for the engine's stages; each oracle takes the part of the chain it needs.
"""

from __future__ import annotations

_CLOCK = "'2026-05-01T00:00:00+00:00'"

# name -> body; a later entry may use any earlier one
_CTES: dict[str, str] = {}

_CTES["feed"] = """
    SELECT 'orders' AS product, date_trunc('month', o_orderdate) AS m, o_orderkey AS k0, 0::BIGINT AS k1,
           0::BIGINT AS k2, 0::BIGINT AS k3, 0.0::DOUBLE AS k4, o_orderkey::VARCHAR AS tid,
           CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'C' || o_custkey END AS cid,
           CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END AS amt,
           strftime(o_orderdate, '%Y-%m-%d') AS tday, o_orderpriority AS canal
    FROM orders
    UNION ALL
    SELECT 'payments', date_trunc('month', l_shipdate), l_orderkey, l_linenumber::BIGINT, l_partkey, l_suppkey,
           l_extendedprice, l_orderkey || '-' || l_linenumber, 'C' || o_custkey,
           CASE WHEN l_orderkey % 101 = 0 THEN '' ELSE l_extendedprice::DECIMAL(18,2)::VARCHAR END,
           strftime(l_shipdate, '%Y-%m-%d'), NULL
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

_CTES["raw_rows"] = """
    SELECT f.*, product || '-' || strftime(m, '%Y%m%d') AS run_id,
           product = 'orders' AND month(m) = 11 AS drifted,
           row_number() OVER (PARTITION BY product, m ORDER BY k0, k1, k2, k3, k4)::BIGINT AS row_number
    FROM feed f"""

_CTES["recs"] = """
    SELECT r.run_id, r.product, m, drifted, row_number, tid AS transaction_id, cid AS customer_id,
           CASE WHEN drifted THEN '' ELSE amt END AS amount, tday AS transaction_date,
           CASE WHEN product = 'payments'
                THEN json_object('cliente', cid, 'data_pagamento', tday, 'pagamento_id', tid, 'valor', amt)
                WHEN drifted
                THEN json_object('canal', canal, 'cliente_id', cid, 'data_pedido', tday, 'pedido_id', tid,
                                 'valor_bruto', amt)
                ELSE json_object('canal', canal, 'cliente_id', cid, 'data_pedido', tday, 'pedido_id', tid,
                                 'valor_total', amt) END::VARCHAR AS raw_row,
           strlen(tid) + strlen(cid) + strlen(amt) + strlen(tday) + 4
             + coalesce(strlen(canal) + 1, 0) AS csv_bytes
    FROM raw_rows r"""

_CTES["judged"] = """
    SELECT *, concat_ws(', ', CASE WHEN transaction_id = '' THEN 'transaction_id' END,
                              CASE WHEN customer_id = '' THEN 'customer_id' END,
                              CASE WHEN amount = '' THEN 'amount' END,
                              CASE WHEN transaction_date = '' THEN 'transaction_date' END) AS gaps
    FROM recs"""

# one row per announced file: delivered ones, the one after each product's last, and the unconfigured product's
_CTES["told"] = """
    SELECT product, m, count(*)::BIGINT AS n, sum(csv_bytes)::BIGINT AS data_bytes FROM recs GROUP BY ALL
    UNION ALL
    SELECT product, max(m) + INTERVAL 1 MONTH, NULL, NULL FROM recs GROUP BY product
    UNION ALL
    SELECT DISTINCT 'invoices', date_trunc('month', ts), NULL::BIGINT, NULL::BIGINT FROM events"""

_CTES["runs0"] = """
    SELECT product, m, n, product || '-' || strftime(m, '%Y%m%d') AS run_id,
           strftime(m, '%Y-%m-%d') AS business_date, strftime(m, '%Y%m%d') AS anomesdia,
           product || '-' || strftime(m, '%Y-%m-%d') || '.csv' AS file_name,
           product || '-' || strftime(m, '%Y-%m-%d') AS file_stem,
           product || '/year=' || strftime(m, '%Y') || '/month=' || strftime(m, '%m') || '/day=' || strftime(m, '%d')
             || '/' || product || '-' || strftime(m, '%Y%m%d') || '/' AS folder,
           product <> 'invoices' AS valid, n IS NOT NULL AS landed,
           product = 'orders' AND month(m) = 11 AND n IS NOT NULL AS drifted,
           CASE product WHEN 'orders' THEN 3.0 WHEN 'payments' THEN 1.0 END::DOUBLE AS max_pct,
           data_bytes + CASE WHEN product = 'payments' THEN strlen('pagamento_id,cliente,valor,data_pagamento')
                        ELSE strlen('pedido_id,cliente_id,valor_total,data_pedido,canal') END + 1 AS file_size
    FROM told"""

_CTES["first_counts"] = """
    SELECT run_id, product, any_value(m) AS m, count(*)::BIGINT AS total,
           count(*) FILTER (gaps <> '')::BIGINT AS rejected,
           'missing domain fields: ' || arg_min(gaps, row_number) FILTER (gaps <> '') AS first_reason,
           sum(strlen(transaction_id) + strlen(customer_id) + strlen(amount) + strlen(transaction_date)
               + strlen('{"amount": "", "customer_id": "", "transaction_date": "", "transaction_id": ""}') + 1)
             FILTER (gaps = '')::BIGINT AS good_bytes
    FROM judged WHERE NOT drifted GROUP BY run_id, product"""

_CTES["first_gate"] = """
    SELECT c.*, CASE product WHEN 'orders' THEN 3.0 ELSE 1.0 END::DOUBLE AS max_error_percent,
           1000::BIGINT AS max_error_count, rejected::DOUBLE / total * 100 AS pct,
           rejected > 0 AND (rejected > 1000
             OR rejected::DOUBLE / total * 100 > CASE product WHEN 'orders' THEN 3.0 ELSE 1.0 END) AS exceeded
    FROM first_counts c"""

_CTES["passed"] = """
    SELECT j.* FROM judged j JOIN first_gate g ON g.run_id = j.run_id AND NOT g.exceeded WHERE gaps = ''"""

_CTES["looked_up"] = """
    SELECT p.*, c.c_custkey IS NOT NULL AS known,
           row_number() OVER (PARTITION BY run_id ORDER BY row_number)::BIGINT AS place
    FROM passed p
    LEFT JOIN customer c ON 'C' || c.c_custkey = p.customer_id AND c.c_custkey % 50 <> 0"""

_CTES["second_counts"] = f"""
    SELECT run_id, product, count(*)::BIGINT AS total, count(*) FILTER (NOT known)::BIGINT AS rejected,
           sum(strlen(transaction_id) + strlen(customer_id) + strlen(amount) + strlen(transaction_date)
               + strlen(product) + 10 + strlen({_CLOCK}) + strlen('transaction')
               + strlen('{{"amount": "", "business_date": "", "customer_id": "", "domain": "", "enriched_at": "", '
                        || '"product": "", "transaction_date": "", "transaction_id": ""}}') + 1)
             FILTER (known)::BIGINT AS good_bytes
    FROM looked_up GROUP BY run_id, product"""

_CTES["second_gate"] = """
    SELECT c.*, rejected::DOUBLE / total * 100 AS pct,
           rejected > 0 AND (rejected > 1000
             OR rejected::DOUBLE / total * 100 > CASE product WHEN 'orders' THEN 3.0 ELSE 1.0 END) AS exceeded
    FROM second_counts c"""

_CTES["final_rows"] = """
    SELECT l.*, strftime(m, '%Y-%m-%d') AS business_date FROM looked_up l
    JOIN second_gate g ON g.run_id = l.run_id AND NOT g.exceeded WHERE known"""

_CTES["all_rejects"] = """
    SELECT run_id, 'harmonization' AS stage, product, strftime(m, '%Y-%m-%d') AS business_date,
           product || '-' || strftime(m, '%Y-%m-%d') || '.csv' AS file_name, row_number::BIGINT AS row_number,
           'missing domain fields: ' || gaps AS reason, raw_row
    FROM judged WHERE gaps <> '' AND NOT drifted
    UNION ALL
    SELECT run_id, 'enrichment', product, strftime(m, '%Y-%m-%d'),
           product || '-' || strftime(m, '%Y-%m-%d') || '.csv', place::INTEGER,
           'customer not found in enrichment base',
           json_object('amount', amount, 'customer_id', customer_id, 'transaction_date', transaction_date,
                       'transaction_id', transaction_id)::VARCHAR
    FROM looked_up WHERE NOT known"""

_CTES["verdicts"] = """
    SELECT r.*, coalesce(r.n, 0) AS total, coalesce(a.rejected, 0) AS h_bad, a.first_reason, a.good_bytes AS h_bytes,
           coalesce(a.exceeded, false) AS h_over, a.pct AS h_pct,
           landed AND NOT r.drifted AND NOT coalesce(a.exceeded, false) AS harmonized,
           coalesce(b.total, 0) AS e_total, coalesce(b.rejected, 0) AS e_bad, b.good_bytes AS e_bytes,
           coalesce(b.exceeded, false) AS e_over, b.pct AS e_pct,
           's3://data-lake/rejected/harmonization/' || folder || file_stem || '.jsonl' AS h_rejects,
           's3://data-lake/rejected/enrichment/' || folder || file_stem || '.jsonl' AS e_rejects,
           's3://data-lake/raw/' || folder || file_name AS raw_uri,
           's3://data-lake/processed/' || folder || file_stem || '.parquet' AS processed_uri,
           's3://data-lake/curated/' || folder || file_stem || '.parquet' AS curated_uri
    FROM runs0 r LEFT JOIN first_gate a ON a.run_id = r.run_id LEFT JOIN second_gate b ON b.run_id = r.run_id"""

_CTES["outcomes"] = """
    SELECT v.*, harmonized AND NOT e_over AS done,
           CASE WHEN NOT valid THEN 'ValidateEvent' WHEN NOT landed THEN 'LandingGlue'
                WHEN NOT harmonized THEN 'HarmonizationGlue' WHEN e_over THEN 'EnrichmentBatch' ELSE '' END AS failed_at,
           CASE WHEN NOT valid THEN 'product not configured: ' || product
                WHEN NOT landed THEN 's3 object not found: s3://product-lake/' || product || '/' || file_name
                WHEN drifted THEN 'file missing source columns: valor_total'
                WHEN h_over THEN 'rejected rows exceeded threshold: ' || h_bad || '/' || total || ' rows; limits '
                     || max_pct::VARCHAR || '% or 1000 rows; rejected=' || h_rejects
                WHEN e_over THEN 'rejected rows exceeded threshold: ' || e_bad || '/' || e_total || ' rows; limits '
                     || max_pct::VARCHAR || '% or 1000 rows; rejected=' || e_rejects
                ELSE '' END AS error
    FROM verdicts v"""

_CTES["run_facts"] = f"""
    SELECT anomesdia, run_id AS ingestion_id, run_id AS execution_id, run_id AS correlation_id, product,
           CASE WHEN valid THEN 'transaction' ELSE 'unknown' END AS domain, 'product-lake' AS source_system,
           'product-lake' AS source_bucket, product || '/' || file_name AS source_key,
           file_name AS source_file_name, '' AS source_file_etag,
           CASE WHEN failed_at = '' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, failed_at AS failure_step,
           {_CLOCK} AS started_at, {_CLOCK} AS finished_at, 0::BIGINT AS duration_seconds,
           total AS total_records,
           CASE WHEN harmonized THEN total - h_bad ELSE 0 END::BIGINT AS processed_records,
           (h_bad + e_bad)::BIGINT AS rejected_records, (failed_at <> '')::BIGINT AS error_records,
           CASE WHEN landed THEN raw_uri ELSE '' END AS raw_path,
           CASE WHEN harmonized THEN processed_uri ELSE '' END AS processed_path,
           CASE WHEN done THEN curated_uri ELSE '' END AS curated_path,
           concat_ws(', ', CASE WHEN h_bad > 0 THEN h_rejects END, CASE WHEN e_bad > 0 THEN e_rejects END)
             AS rejected_path,
           error AS error_message
    FROM outcomes"""

# fixed values: columns of a step fact beyond its core, by type
_STEP_TEXT = [
    "error_type", "error_code", "error_category", "source_bucket", "source_key",
    "payload_ref", "occurred_at", "rule_name", "rule_type", "rule_result",
    "threshold_value", "measured_value", "quality_details", "measured_at", "schema_name",
    "schema_version", "validation_result", "missing_columns", "unexpected_columns", "invalid_types",
    "validation_message", "validated_at", "rejection_reason", "rejection_category", "rejected_detail_path",
    "sample_message", "artifact_type", "artifact_role", "lineage_bucket", "lineage_key",
    "lineage_format", "parent_bucket", "parent_key", "lineage_created_at",
]
_STEP_NUMBERS = [
    "valid_records", "invalid_records", "warning_records", "rejected_count_summary", "total_step_records_summary",
    "record_count_lineage", "file_size_bytes",
]


def _step(name: str, order: int, job: str, source: str, ok: str, **given: str) -> str:
    """One step's rows: the core columns, then every block column, NULL unless given."""
    core = {
        "domain": "'transaction'",
        "input_records": "0",
        "output_records": "0",
        "rejected_records": "0",
        "input_path": "''",
        "output_path": "''",
        "error_message": "''",
    }
    for c in core:
        core[c] = given.pop(c, core[c])
    blocks = [f"{given.pop(c, 'NULL')}::VARCHAR AS {c}" for c in _STEP_TEXT]
    blocks += [f"({given.pop(c, 'NULL')})::BIGINT AS {c}" for c in _STEP_NUMBERS]
    blocks.append(f"({given.pop('rejection_percent', 'NULL')})::DOUBLE AS rejection_percent")
    blocks.append("NULL::BOOLEAN AS is_retryable")
    assert not given, given
    return f"""
    SELECT anomesdia, run_id AS ingestion_id, run_id AS execution_id, run_id AS correlation_id, product,
           {core['domain']} AS domain, '{name}' AS step_name, {order} AS step_order, 1 AS attempt,
           '{job}' AS glue_job_name, run_id AS glue_job_run_id,
           CASE WHEN {ok} THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, {_CLOCK} AS started_at,
           {_CLOCK} AS finished_at, 0::BIGINT AS duration_seconds, ({core['input_records']})::BIGINT AS input_records,
           ({core['output_records']})::BIGINT AS output_records,
           ({core['rejected_records']})::BIGINT AS rejected_records,
           CASE WHEN {ok} THEN 0 ELSE 1 END::BIGINT AS error_records, {core['input_path']} AS input_path,
           {core['output_path']} AS output_path, {core['error_message']} AS error_message,
           {', '.join(blocks)}
    FROM {source}"""


def _when(condition: str, value: str) -> str:
    return f"(CASE WHEN {condition} THEN {value} END)"


def _error_block(failed: str, kind: str, code: str, bucket: str, key: str) -> dict[str, str]:
    return {
        "error_message": f"CASE WHEN {failed} THEN error ELSE '' END",
        "error_type": _when(failed, kind),
        "error_code": _when(failed, code),
        "error_category": _when(failed, "'pipeline'"),
        "source_bucket": _when(failed, f"'{bucket}'"),
        "source_key": _when(failed, key),
        "payload_ref": _when(failed, f"'s3://{bucket}/' || {key}"),
        "occurred_at": _when(failed, _CLOCK),
    }


def _reject_block(bad: str, total: str, pct: str, reason: str, category: str, path: str) -> dict[str, str]:
    some = f"{bad} > 0"
    return {
        "rejection_reason": _when(some, reason),
        "rejection_category": _when(some, f"'{category}'"),
        "rejected_count_summary": _when(some, bad),
        "total_step_records_summary": _when(some, total),
        "rejection_percent": _when(some, pct),
        "rejected_detail_path": _when(some, path),
        "sample_message": _when(some, reason),
    }


def _quality_block(ok: str, rule: str, kind: str, bad: str, total: str, pct: str, details: str) -> dict[str, str]:
    return {
        "rule_name": _when(ok, f"'{rule}'"),
        "rule_type": _when(ok, f"'{kind}'"),
        "rule_result": _when(ok, f"CASE WHEN {bad} > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END"),
        "valid_records": _when(ok, f"{total} - {bad}"),
        "invalid_records": _when(ok, bad),
        "warning_records": _when(ok, "0"),
        "threshold_value": _when(ok, "max_pct::VARCHAR"),
        "measured_value": _when(ok, f"({pct})::VARCHAR"),
        "quality_details": _when(ok, details),
        "measured_at": _when(ok, _CLOCK),
    }


def _lineage_block(ok, kind, role, key, fmt, records, size, parent_bucket, parent) -> dict[str, str]:
    return {
        "artifact_type": _when(ok, f"'{kind}'"),
        "artifact_role": _when(ok, f"'{role}'"),
        "lineage_bucket": _when(ok, "'data-lake'"),
        "lineage_key": _when(ok, key),
        "lineage_format": _when(ok, f"'{fmt}'"),
        "record_count_lineage": _when(ok, records),
        "file_size_bytes": _when(ok, size),
        "parent_bucket": _when(ok, f"'{parent_bucket}'"),
        "parent_key": _when(ok, parent),
        "lineage_created_at": _when(ok, _CLOCK),
    }


_RAW = "'raw/' || folder || file_name"
_PROC = "'processed/' || folder || file_stem || '.parquet'"
_CUR = "'curated/' || folder || file_stem || '.parquet'"
_SRC = "product || '/' || file_name"
_seen = "(harmonized OR drifted)"

_CTES["step_facts"] = " UNION ALL ".join(
    [
        _step("InitExecution", 1, "local_sfn_runner", "outcomes", "true", domain="'unknown'"),
        _step(
            "LandingGlue", 2, "glue_landing", "outcomes WHERE valid", "landed",
            input_records="total", output_records="total", input_path=f"'s3://product-lake/' || {_SRC}",
            output_path="raw_uri",
            **_error_block("NOT landed", "'PipelineError'", "'landing_failed'", "product-lake", _SRC),
            **_lineage_block("landed", "raw", "landing_output", _RAW, "csv", "total", "file_size", "product-lake", _SRC),
        ),
        _step(
            "HarmonizationGlue", 3, "glue_harmonization", "outcomes WHERE landed", "harmonized",
            input_records="CASE WHEN drifted THEN 0 ELSE total END",
            output_records="CASE WHEN harmonized THEN total - h_bad ELSE 0 END", rejected_records="h_bad",
            input_path="raw_uri", output_path="processed_uri",
            **_error_block(
                "NOT harmonized", "CASE WHEN h_over THEN 'RejectedRowsThresholdError' ELSE 'PipelineError' END",
                "CASE WHEN drifted THEN 'harmonization_schema_failed' ELSE 'harmonization_failed' END",
                "data-lake", _RAW,
            ),
            schema_name=_when(_seen, "'source_layout_mapping'"), schema_version=_when(_seen, "'v1'"),
            validation_result=_when(_seen, "CASE WHEN drifted THEN 'FAILED' ELSE 'SUCCEEDED' END"),
            missing_columns=_when(_seen, "CASE WHEN drifted THEN 'valor_total' ELSE '' END"),
            unexpected_columns=_when(_seen, "CASE WHEN product = 'orders' AND NOT drifted THEN 'canal' ELSE '' END"),
            invalid_types=_when(_seen, "''"),
            validation_message=_when(
                _seen, "CASE WHEN drifted THEN error ELSE 'source columns satisfied mapping' END"),
            validated_at=_when(_seen, _CLOCK),
            **_quality_block(
                "harmonized", "required_domain_fields", "completeness", "h_bad", "total", "h_pct",
                "'mapping=de-para/' || product || '-transaction.json'"),
            **_reject_block(
                "h_bad", "total", "h_pct", "first_reason", "required_field_validation", "h_rejects"),
            **_lineage_block(
                "harmonized", "processed", "harmonization_output", _PROC, "parquet", "total - h_bad", "h_bytes",
                "data-lake", _RAW),
        ),
        _step(
            "EnrichmentBatch", 4, "enrichment_batch", "outcomes WHERE harmonized", "NOT e_over",
            input_records="e_total", output_records="CASE WHEN e_over THEN 0 ELSE e_total - e_bad END",
            rejected_records="e_bad", input_path="processed_uri", output_path="curated_uri",
            **_error_block("e_over", "'RejectedRowsThresholdError'", "'enrichment_failed'", "data-lake", _PROC),
            **_quality_block(
                "NOT e_over", "enrichment_success_rate", "enrichment", "e_bad", "e_total", "e_pct",
                "'enrichment batch summary'"),
            **_reject_block(
                "e_bad", "e_total", "e_pct", "'customer not found in enrichment base'", "enrichment_lookup", "e_rejects"),
            **_lineage_block(
                "NOT e_over", "curated", "enrichment_output", _CUR, "parquet", "e_total - e_bad", "e_bytes",
                "data-lake", _PROC),
        ),
    ]
)

_CTES["rejected_zone"] = """
    SELECT * FROM all_rejects
    UNION ALL
    SELECT run_id, 'file-failed', product, business_date, file_name, NULL, error, NULL
    FROM outcomes WHERE valid AND (NOT landed OR drifted)"""

_CTES["ready"] = """
    SELECT 'domain_record_ready' AS event_type, d AS destination, f.run_id, f.product, row_number, transaction_id,
           customer_id, amount, transaction_date, 'transaction' AS domain, f.business_date,
           '2026-05-01T00:00:00+00:00' AS enriched_at, 'data-lake' AS source_bucket,
           'curated/' || r.folder || r.file_stem || '.parquet' AS source_key
    FROM final_rows f JOIN runs0 r ON r.run_id = f.run_id,
         (VALUES ('billing-events'), ('analytics-events')) AS t(d)"""

_CTES["bad_rows"] = """
    SELECT 'ingestion.records-rejected' AS event_type, 'data-quality-events' AS destination, a.run_id, a.product,
           a.stage, a.row_number, a.reason, a.raw_row, a.business_date, a.file_name, 'data-lake' AS source_bucket,
           'rejected/' || a.stage || '/' || r.folder || r.file_stem || '.jsonl' AS source_key
    FROM all_rejects a JOIN runs0 r ON r.run_id = a.run_id"""

_CTES["bad_files"] = """
    SELECT 'ingestion.file-failed' AS event_type, 'data-quality-events' AS destination, run_id, product,
           business_date, file_name,
           CASE WHEN h_over THEN h_bad WHEN e_over THEN e_bad END::BIGINT AS rows_rejected,
           CASE WHEN h_over THEN total WHEN e_over THEN e_total END::BIGINT AS rows_total,
           error, 'data-lake' AS source_bucket,
           'rejected/' || CASE WHEN h_over THEN 'harmonization' WHEN e_over THEN 'enrichment' ELSE 'file-failed' END
             || '/' || folder || file_stem || '.jsonl' AS source_key
    FROM outcomes WHERE valid AND failed_at <> ''"""

_CTES["messages_out"] = """
    SELECT event_type, destination, run_id, row_number::VARCHAR AS record_key,
           json_object('destination', destination, 'event_type', event_type, 'product', product, 'record',
             json_object('amount', amount, 'business_date', business_date, 'customer_id', customer_id,
               'domain', domain, 'enriched_at', enriched_at, 'product', product, 'transaction_date', transaction_date,
               'transaction_id', transaction_id),
             'run_id', run_id, 'source', json_object('bucket', source_bucket, 'key', source_key))::VARCHAR AS payload
    FROM ready
    UNION ALL
    SELECT event_type, destination, run_id, stage || '/' || row_number,
           json_object('destination', destination, 'event_type', event_type, 'product', product, 'rejected_record',
             json_object('business_date', business_date, 'file_name', file_name, 'product', product,
               'raw_row', raw_row::JSON, 'reason', reason, 'row_number', row_number, 'run_id', run_id, 'stage', stage),
             'run_id', run_id, 'source', json_object('bucket', source_bucket, 'key', source_key))::VARCHAR
    FROM bad_rows
    UNION ALL
    SELECT event_type, destination, run_id, '',
           json_object('business_date', business_date, 'destination', destination, 'error', error,
             'event_type', event_type, 'file_name', file_name, 'product', product, 'rows',
             CASE WHEN rows_total IS NULL THEN '{}'::JSON
                  ELSE json_object('rejected', rows_rejected, 'total', rows_total) END,
             'run_id', run_id, 'source', json_object('bucket', source_bucket, 'key', source_key))::VARCHAR
    FROM bad_files"""

# --- messages, notifications and documents ---

_CTES["msgs"] = """
    SELECT event_id AS message_id, event_id % 10 AS shape, user_id, strftime(ts, '%Y-%m-%d') AS day,
           strftime(ts, '%d-%m-%Y') AS wrong_day,
           CASE WHEN event_type IN ('click', 'view') THEN 'orders' WHEN event_type = 'purchase' THEN 'payments'
                ELSE 'invoices' END AS product, event_id
    FROM events"""

_CTES["opened"] = """
    SELECT message_id, shape, user_id, shape IN (1, 5, 6, 7, 9) AS routed,
           CASE WHEN shape NOT IN (4, 7, 8) THEN product END AS product,
           CASE WHEN shape NOT IN (4, 7, 8) THEN product || '-' || event_id || '.csv' END AS file_name,
           CASE WHEN shape = 6 THEN wrong_day WHEN shape NOT IN (4, 5, 7, 8) THEN day END AS business_date,
           CASE WHEN shape IN (4, 7, 8) THEN 'message is not EventBridge file-ready event' END AS reason
    FROM msgs"""

_CTES["checked_events"] = """
    SELECT message_id, shape, user_id, product, file_name, business_date,
           coalesce(reason, CASE WHEN shape = 5 THEN 'event missing fields: business_date'
                WHEN shape = 6 THEN 'business_date must use YYYY-MM-DD'
                WHEN product = 'invoices' THEN 'product not configured: invoices' END) AS reason,
           CASE WHEN shape IN (4, 5, 6, 7, 8) THEN 'quarantined' WHEN product = 'invoices' THEN 'refused'
                ELSE 'accepted' END AS outcome
    FROM opened"""

_CTES["notes"] = """
    SELECT o_orderkey AS message_id, o_orderkey % 8 AS shape, product,
           'curated/' || product || '/' || dated || '/part file.parquet' AS good_key,
           'rejected/harmonization/' || product || '/' || dated || '/f+1.jsonl' AS bad_key
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'payments' WHEN o_orderkey % 17 = 0 THEN 'invoices'
                             ELSE 'orders' END AS product,
                 'year=' || strftime(o_orderdate, '%Y') || '/month=' || strftime(o_orderdate, '%m') || '/day='
                   || strftime(o_orderdate, '%d') || '/run-' || o_orderkey AS dated FROM orders)"""

_CTES["note_records"] = """
    SELECT message_id, shape, product, 'data-lake' AS bucket, good_key AS key, NULL AS reason
    FROM notes WHERE shape IN (0, 2, 3)
    UNION ALL
    SELECT message_id, shape, product, 'data-lake', bad_key, NULL FROM notes WHERE shape IN (1, 2, 4)
    UNION ALL
    SELECT message_id, shape, product, NULL, NULL, 'message is not S3 notification' FROM notes WHERE shape = 6
    UNION ALL
    SELECT message_id, shape, product, 'data-lake', 'manifests/' || message_id, NULL FROM notes WHERE shape = 7"""

_CTES["note_routes"] = """
    SELECT message_id, CASE WHEN key LIKE 'rejected/%' THEN 'rejected' ELSE 'curated' END AS route,
           CASE WHEN shape < 6 THEN product END AS product,
           CASE WHEN shape = 4 THEN 'given-' || message_id WHEN shape < 6 THEN 'run-' || message_id
                ELSE 'unknown' END AS run_id,
           CASE WHEN shape = 7 THEN 'unexpected pipeline file key: ' || key ELSE reason END AS reason
    FROM note_records"""

_CTES["cfg"] = """
    SELECT c_custkey AS k, 'c' || c_custkey AS product,
           CASE WHEN c_custkey % 11 = 0 THEN 'order' ELSE 'transaction' END AS domain,
           CASE WHEN c_custkey % 13 <> 0 THEN 'de-para/c' || c_custkey || '.json' END AS mapping_key,
           CASE WHEN c_custkey % 17 = 0 OR c_custkey % 19 = 0 THEN ''
                ELSE lower(c_mktsegment) || ', analytics-events' END AS destinations,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 101.0
                WHEN c_custkey % 3 = 0 THEN 2.5 END::DOUBLE AS pct,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN -1
                WHEN c_custkey % 2 = 0 THEN c_custkey END::BIGINT AS cnt,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN ''
                WHEN c_custkey % 5 = 0 THEN 'quality-, ' || lower(c_mktsegment) END AS quality
    FROM customer"""

_CTES["maps"] = """
    SELECT p_partkey AS k, 'de-para/p' || p_partkey || '.json' AS mapping_key,
           CASE WHEN p_partkey % 17 = 0 THEN 'order' ELSE 'transaction' END AS domain,
           CASE WHEN p_partkey % 13 = 0 THEN 'transaction_id, customer_id, amount'
                ELSE 'transaction_date, amount, customer_id, transaction_id' END AS required_fields,
           CASE WHEN p_partkey % 7 = 0 THEN 'none' WHEN p_partkey % 5 = 0 THEN 'short'
                WHEN p_partkey % 11 = 0 THEN 'twice' ELSE 'full' END AS shape
    FROM part"""


def _with(*needed: str) -> str:
    """Definitions of the given names and of everything they use, in order."""
    names = list(_CTES)
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in names[: names.index(name)]:
                if any(other == word for word in _words(_CTES[name])):
                    add(other)

    for n in needed:
        add(n)
    return "WITH " + ", ".join(f"{n} AS ({_CTES[n]})" for n in names if n in wanted)


def _words(sql: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())


def _sql(select: str) -> str:
    used = [n for n in _CTES if n in _words(select)]
    return f"{_with(*used)} {select}" if used else select


_DOMAIN = "transaction_id, customer_id, amount, transaction_date"
_REJECT = "run_id, stage, product, business_date, file_name, row_number, reason, raw_row"
_STEP_KEYS = "anomesdia, product, step_name"
_ERR = "error_message IS NOT NULL AND error_message <> ''"
_RUN_JOIN = "LEFT JOIN run_facts r ON r.product = {0}.product AND r.anomesdia = replace({0}.business_date, '-', '')"
_FULL_RAW = "'year=' || strftime(o_orderdate, '%Y') || '/month=' || strftime(o_orderdate, '%m') || '/day=' || strftime(o_orderdate, '%d')"

_SELECTS: dict[str, str] = {
    # sources
    "scan_raw": "SELECT run_id, row_number, raw_row FROM recs",
    "land_raw": """
        SELECT product, strftime(m, '%Y') AS year, strftime(m, '%m') AS month, strftime(m, '%d') AS day, run_id,
               count(*)::BIGINT AS records, count(*)::BIGINT AS data_lines,
               CASE WHEN product = 'payments' THEN 'pagamento_id,cliente,valor,data_pagamento'
                    WHEN drifted THEN 'pedido_id,cliente_id,valor_bruto,data_pedido,canal'
                    ELSE 'pedido_id,cliente_id,valor_total,data_pedido,canal' END AS header
        FROM recs GROUP BY product, m, run_id, drifted""",
    "row_ordinals": "SELECT run_id, row_number, tid AS transaction_id FROM raw_rows",
    "scan_processed": f"SELECT run_id, {_DOMAIN} FROM passed",
    "scan_zone_tables": f"""
        SELECT 'processed' AS zone, run_id, {_DOMAIN}, NULL::VARCHAR AS domain, NULL::VARCHAR AS business_date,
               NULL::VARCHAR AS enriched_at, NULL::VARCHAR AS stage, NULL::BIGINT AS row_number,
               NULL::VARCHAR AS reason FROM passed
        UNION ALL
        SELECT 'curated', run_id, {_DOMAIN}, 'transaction', business_date, {_CLOCK}, NULL, NULL, NULL FROM final_rows
        UNION ALL
        SELECT 'rejected', run_id, NULL, NULL, NULL, NULL, NULL, business_date, NULL, stage, row_number, reason
        FROM rejected_zone""",
    "table_counts": """
        SELECT table_name, row_count, CASE WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM (
            SELECT 'analytics_ingestion_runs' AS table_name, count(*)::BIGINT AS row_count FROM run_facts
            UNION ALL SELECT 'analytics_ingestion_steps', count(*) FROM step_facts
            UNION ALL SELECT 'business_curated', count(*) FROM final_rows
            UNION ALL SELECT 'business_rejected', count(*) FROM rejected_zone)""",
    # configuration
    "product_config": """
        SELECT product, domain, mapping_key, destinations, pct AS max_error_percent, cnt AS max_error_count,
               coalesce(quality, '') AS quality_destinations FROM cfg""",
    "rejection_policy": """
        SELECT product, coalesce(pct, 1.0) AS max_error_percent, coalesce(cnt, 1000) AS max_error_count,
               coalesce(quality, 'data-quality-events') AS quality_destinations FROM cfg""",
    "config_validated": """
        SELECT product, config_error IS NULL AS usable, config_error FROM (
          SELECT product, 'product ' || product || CASE
            WHEN domain <> 'transaction' THEN ' must map to domain transaction'
            WHEN mapping_key IS NULL THEN ' missing mapping_key'
            WHEN destinations = '' THEN ' missing publish destinations'
            WHEN pct > 100 THEN ' rejection_policy.max_error_percent must be between 0 and 100'
            WHEN cnt < 0 THEN ' rejection_policy.max_error_count must be >= 0'
            WHEN quality = '' THEN ' rejection_policy missing destinations' END AS config_error FROM cfg)""",
    "layout_mapping": """
        SELECT mapping_key, domain, required_fields,
               CASE shape WHEN 'none' THEN '' WHEN 'short' THEN 'customer>customer_id, id>transaction_id, value>amount'
                 WHEN 'full' THEN 'customer>customer_id, day>transaction_date, id>transaction_id, value>amount'
                 ELSE 'customer>customer_id, day>transaction_date, id>transaction_id, value>amount, value_2>amount'
               END AS layout,
               CASE shape WHEN 'none' THEN '' WHEN 'short' THEN 'transaction_id<id, customer_id<customer, amount<value'
                 WHEN 'full' THEN 'transaction_id<id, customer_id<customer, amount<value, transaction_date<day'
                 ELSE 'transaction_id<id, customer_id<customer, amount<value_2, transaction_date<day' END AS inverse
        FROM maps""",
    "mapping_validated": """
        SELECT mapping_key, mapping_error IS NULL AS usable, mapping_error FROM (
          SELECT mapping_key, 'mapping for ' || mapping_key || CASE
            WHEN domain <> 'transaction' THEN ' must map to domain transaction'
            WHEN shape = 'none' THEN ' missing layout_mapping'
            WHEN k % 13 = 0 THEN ' must require fields: transaction_id, customer_id, amount, transaction_date'
            WHEN shape = 'short' THEN ' missing domain fields: transaction_date' END AS mapping_error FROM maps)""",
    # events
    "event_envelope": "SELECT message_id, routed, product, file_name, business_date, reason FROM opened",
    "events_validated": """
        SELECT message_id, outcome, reason, product, business_date,
               CASE WHEN product <> 'invoices' THEN 'transaction' END AS config_domain,
               CASE WHEN product <> 'invoices' THEN 'de-para/' || product || '-transaction.json' END AS mapping_key,
               CASE WHEN product <> 'invoices' THEN 'billing-events, analytics-events' ELSE '' END
                 AS publish_destinations
        FROM checked_events""",
    "events_skipped": "SELECT message_id, product, file_name FROM opened WHERE product = 'invoices'",
    "execution_context": f"""
        SELECT message_id,
               CASE WHEN shape = 9 THEN 'run-' || message_id ELSE '20260501000000-' || substr(sha1(
                 '{{"business_date": "' || business_date || '", "file_name": "' || file_name || '", "product": "'
                 || product || '"}}'), 1, 8) END AS run_id,
               CASE WHEN shape = 9 THEN 'ing-' || message_id ELSE run_id END AS ingestion_id,
               CASE WHEN shape = 9 AND user_id % 2 = 0 THEN 'exec-' || message_id ELSE run_id END AS execution_id,
               CASE WHEN shape = 9 AND user_id % 3 = 0 THEN 'corr-' || message_id ELSE ingestion_id END
                 AS correlation_id,
               CASE WHEN shape = 9 AND user_id % 5 = 0 THEN '20200101' ELSE replace(business_date, '-', '') END
                 AS anomesdia,
               'product-lake' AS source_system, 'product-lake' AS source_bucket,
               CASE WHEN shape = 9 AND user_id % 7 = 0 THEN 'drop/' || message_id ELSE product || '/' || file_name END
                 AS source_key
        FROM checked_events WHERE outcome <> 'quarantined'""",
    "analytics_dimensions": """
        SELECT message_id, CASE WHEN shape = 9 THEN 'ing-' || message_id ELSE 'run-' || message_id END AS ingestion_id,
               CASE WHEN shape = 9 AND user_id % 2 = 0 THEN 'exec-' || message_id ELSE 'run-' || message_id END
                 AS execution_id,
               CASE WHEN shape = 9 AND user_id % 3 = 0 THEN 'corr-' || message_id ELSE ingestion_id END
                 AS correlation_id, product, 'unknown' AS domain
        FROM opened WHERE reason IS NULL""",
    "event_batch_summary": """
        SELECT CASE WHEN outcome = 'accepted' THEN 'processed' ELSE 'skipped' END AS outcome,
               coalesce(reason, '') AS reason, count(*)::BIGINT AS messages FROM checked_events GROUP BY 1, 2""",
    # scalar functions
    "date_keys": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 2 THEN strftime(o_orderdate, '%Y%m%d') END AS anomesdia,
               CASE WHEN o_orderkey % 6 < 2 THEN strftime(o_orderdate, 'year=%Y/month=%m/day=%d') END AS prefix,
               CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d')
                 WHEN 1 THEN strftime(o_orderdate, '%Y') || month(o_orderdate) || day(o_orderdate)
                 WHEN 2 THEN strftime(o_orderdate, '%d%m%Y') WHEN 3 THEN ''
                 WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y0230') END AS day_key,
               CASE WHEN o_orderkey % 6 >= 2 THEN 'business_date must use YYYY-MM-DD' END AS reason
        FROM orders""",
    "run_ids": """
        SELECT event_id, '20260501000000-' || substr(sha1('{"business_date": "' || day || '", "file_name": "' || product
               || '-' || event_id || '.csv", "product": "' || product || '"}'), 1, 8) AS run_id FROM msgs""",
    "sanitize_keys": """
        SELECT event_id, CASE event_id % 3 WHEN 1 THEN 'item'
               WHEN 0 THEN event_type || '-' || trim(regexp_replace(props, '[^A-Za-z0-9_.=-]+', '-', 'g'), '-')
               ELSE trim(regexp_replace(props, '[^A-Za-z0-9_.=-]+', '-', 'g'), '-') END AS fragment
        FROM events""",
    "file_key_parse": f"""
        SELECT o_orderkey, key, CASE o_orderkey % 5 WHEN 0 THEN 'orders' WHEN 1 THEN 'payments' WHEN 3 THEN 'orders' END
                 AS product,
               CASE WHEN o_orderkey % 5 < 2 THEN 'run-' || o_orderkey ELSE 'unknown' END AS run_id,
               CASE WHEN o_orderkey % 5 IN (2, 4) THEN 'unexpected pipeline file key: ' || key END AS reason
        FROM (SELECT o_orderkey, CASE o_orderkey % 5
                WHEN 0 THEN 'curated/orders/' || {_FULL_RAW} || '/run-' || o_orderkey || '/f.parquet'
                WHEN 1 THEN 'rejected/harmonization/payments/' || {_FULL_RAW} || '/run-' || o_orderkey || '/f.jsonl'
                WHEN 2 THEN 'manifests/' || o_orderkey WHEN 3 THEN 'curated/orders' ELSE 'rejected/enrichment' END AS key
              FROM orders)""",
    "artifact_paths": f"""
        SELECT o_orderkey, 'processed/' || name AS source_key, 'raw/' || folder || name AS raw_key,
               'processed/' || folder || stem || '.parquet' AS processed_key,
               'curated/' || folder || stem || '.parquet' AS curated_key,
               'rejected/enrichment/' || folder || stem || '.jsonl' AS rejected_key,
               'manifests/run-' || o_orderkey || '.json' AS manifest_key, 's3://data-lake/raw/' || folder || name AS raw_uri,
               stem
        FROM (SELECT o_orderkey, 'processed/' || {_FULL_RAW} || '/run-' || o_orderkey || '/' AS folder,
                CASE o_orderkey % 4 WHEN 0 THEN 'orders-' || o_orderkey || '.csv'
                  WHEN 1 THEN 'orders-' || o_orderkey || '.tar.gz' WHEN 2 THEN '.hidden-' || o_orderkey
                  ELSE 'plain-' || o_orderkey END AS name,
                CASE o_orderkey % 4 WHEN 0 THEN 'orders-' || o_orderkey WHEN 1 THEN 'orders-' || o_orderkey || '.tar'
                  WHEN 2 THEN '.hidden-' || o_orderkey ELSE 'plain-' || o_orderkey END AS stem
              FROM orders)""",
    # harmonisation and the first gate
    "schema_check": """
        SELECT DISTINCT run_id, NOT drifted AS schema_ok, CASE WHEN drifted THEN 'valor_total' ELSE '' END AS missing_columns,
               CASE WHEN product = 'orders' AND NOT drifted THEN 'canal' ELSE '' END AS unexpected_columns FROM recs""",
    "harmonize_mapped": f"SELECT run_id, row_number, {_DOMAIN} FROM recs",
    "harmonize_accepted": f"SELECT run_id, row_number, {_DOMAIN} FROM judged WHERE gaps = '' AND NOT drifted",
    "harmonize_rejected": f"SELECT {_REJECT} FROM all_rejects WHERE stage = 'harmonization'",
    "threshold_gate": """
        SELECT run_id, product, total, rejected, pct AS rejected_percent, max_error_percent, max_error_count, exceeded
        FROM first_gate""",
    "processed": f"SELECT run_id, row_number, {_DOMAIN} FROM passed",
    "harmonize_step": """
        SELECT execution_id, status, input_records, output_records, rejected_records, error_code, validation_result,
               rule_result, threshold_value, rejection_reason, rejection_percent
        FROM step_facts WHERE step_name = 'HarmonizationGlue'""",
    # enrichment and the second gate
    "enrich_lookup_accepted": f"SELECT run_id, {_DOMAIN} FROM looked_up WHERE known",
    "enrich_lookup_rejected": f"SELECT {_REJECT} FROM all_rejects WHERE stage = 'enrichment'",
    "enrich_step": """
        SELECT run_id, total, rejected, pct AS rejected_percent, exceeded,
               CASE WHEN rejected > 0 THEN 'customer not found in enrichment base' END AS first_reason,
               good_bytes AS accepted_bytes FROM second_gate""",
    "curated": f"""
        SELECT run_id, row_number, {_DOMAIN}, 'transaction' AS domain, product, business_date, {_CLOCK} AS enriched_at
        FROM final_rows""",
    # zones and facts
    "rejected": f"SELECT {_REJECT} FROM rejected_zone",
    "file_failed": """
        SELECT run_id, stage, product, business_date, file_name, reason FROM rejected_zone WHERE stage = 'file-failed'""",
    "ingestion_runs": "SELECT * FROM run_facts",
    "ingestion_steps": "SELECT * FROM step_facts",
    "latest_step_facts": """
        SELECT execution_id, step_name, status, finished_at, output_records, '0' AS batch_id FROM step_facts""",
    "manifest": """
        SELECT run_id, run_id AS ingestion_id, run_id AS execution_id, anomesdia, product, business_date, raw_uri AS raw,
               processed_uri AS processed, curated_uri AS curated,
               concat_ws(', ', CASE WHEN h_bad > 0 THEN h_rejects END, CASE WHEN e_bad > 0 THEN e_rejects END) AS rejected,
               (h_bad + e_bad)::BIGINT AS rejected_rows, 's3://data-lake/curated/ -> curated-files' AS curated_notification,
               'analytics-lake' AS analytics_bucket
        FROM outcomes WHERE done""",
    "evidence_rollup": """
        SELECT run_id, product, file_name, business_date, CASE WHEN failed_at = '' THEN 'OK' ELSE 'FAIL' END AS status,
               CASE WHEN NOT valid THEN 2 WHEN NOT landed THEN 3 WHEN NOT harmonized THEN 4
                    ELSE 4 + (h_bad > 0)::INTEGER + CASE WHEN e_over THEN 1 ELSE 4 + (e_bad > 0)::INTEGER END
               END::INTEGER AS step_count,
               'InitExecution:OK, ' || CASE WHEN NOT valid THEN 'ValidateEvent:FAIL' ELSE 'ProductConfig:OK, ' ||
                 CASE WHEN NOT landed THEN 'LandingGlue:FAIL' ELSE 'LandingGlue:OK, ' ||
                   CASE WHEN NOT harmonized THEN 'HarmonizationGlue:FAIL' ELSE 'HarmonizationGlue:OK, ' ||
                     CASE WHEN h_bad > 0 THEN 'RejectedRecords:OK, ' ELSE '' END ||
                     CASE WHEN e_over THEN 'EnrichmentBatch:FAIL' ELSE 'EnrichmentBatch:OK, ' ||
                       CASE WHEN e_bad > 0 THEN 'RejectedRecords:OK, ' ELSE '' END ||
                       'S3Notification:OK, Manifest:OK, FinalizeExecution:OK' END END END END AS steps,
               error
        FROM outcomes""",
    "artifact_sizes": """
        SELECT execution_id, artifact_type, record_count_lineage, file_size_bytes FROM step_facts
        WHERE artifact_type IS NOT NULL""",
    "catalog_tables": """
        SELECT * FROM (
          SELECT 'ingestion_analytics' AS database_name, 'analytics_ingestion_runs' AS table_name, 24 AS column_count,
                 'anomesdia' AS partition_keys, count(*)::BIGINT AS row_count FROM run_facts
          UNION ALL SELECT 'ingestion_analytics', 'analytics_ingestion_steps', 64, 'anomesdia', count(*)
            FROM step_facts
          UNION ALL SELECT 'ingestion_business', 'business_raw', 4, 'product, year, month, day, run_id', count(*) FROM recs
          UNION ALL SELECT 'ingestion_business', 'business_processed', 7, 'product, year, month, day, run_id', count(*)
            FROM passed
          UNION ALL SELECT 'ingestion_business', 'business_curated', 9, 'product, year, month, day, run_id', count(*)
            FROM final_rows
          UNION ALL SELECT 'ingestion_business', 'business_rejected', 5, 'stage, product, year, month, day, run_id',
            count(*) FROM rejected_zone)""",
    # publication
    "notification_records": "SELECT message_id, bucket, key, reason FROM note_records",
    "route_messages": "SELECT message_id, route, product, run_id, reason FROM note_routes",
    "publish_summary": """
        SELECT count(DISTINCT message_id)::BIGINT AS received_messages,
               count(DISTINCT CASE WHEN reason IS NULL AND product <> 'invoices' THEN message_id END)::BIGINT
                 AS processed_messages,
               'analytics-events, billing-events, data-quality-events' AS published_destinations
        FROM note_routes""",
    "outbox_domain_record_ready": f"""
        SELECT event_type, destination, run_id, product, {_DOMAIN}, domain, business_date, enriched_at, source_bucket,
               source_key FROM ready""",
    "outbox_records_rejected": """
        SELECT event_type, destination, run_id, product, stage, row_number, reason, raw_row, source_bucket, source_key
        FROM bad_rows""",
    "outbox_file_failed": "SELECT * FROM bad_files",
    "outbox_payload_json": "SELECT event_type, destination, run_id, record_key, payload FROM messages_out",
    "destination_counts": """
        SELECT destination, event_type, count(*)::BIGINT AS messages FROM messages_out GROUP BY destination, event_type""",
    # views
    "vw_ingestion_status_by_day": """
        SELECT anomesdia, product, domain, status, count(*)::BIGINT AS total_runs, sum(total_records)::BIGINT AS total_records,
               sum(processed_records)::BIGINT AS processed_records, sum(rejected_records)::BIGINT AS rejected_records,
               avg(duration_seconds)::DOUBLE AS avg_duration_seconds
        FROM run_facts GROUP BY ALL""",
    "vw_troubleshooting_dashboard": """
        SELECT anomesdia, product, domain, status AS run_status, source_bucket, source_key, source_file_name, ingestion_id,
               execution_id, total_records, processed_records, rejected_records, error_records, failure_step,
               error_message AS run_error, started_at, finished_at, raw_path, processed_path, curated_path, rejected_path,
               (rejected_records > 0)::INTEGER AS has_rejections FROM run_facts""",
    "vw_ingestion_steps_summary": """
        SELECT anomesdia, product, step_order, step_name, status, count(*)::BIGINT AS attempts,
               sum(input_records)::BIGINT AS input_records, sum(output_records)::BIGINT AS output_records,
               sum(rejected_records)::BIGINT AS rejected_records, sum(error_records)::BIGINT AS error_records,
               avg(duration_seconds)::DOUBLE AS avg_duration_seconds FROM step_facts GROUP BY ALL""",
    "vw_errors_with_source": f"""
        SELECT s.anomesdia, s.product, step_name, error_type, error_code, s.error_message, error_category, occurred_at,
               s.source_bucket, s.source_key, r.source_file_name, r.ingestion_id, r.execution_id, r.status AS run_status
        FROM (SELECT * FROM step_facts WHERE {_ERR}) s LEFT JOIN run_facts r ON r.ingestion_id = s.ingestion_id""",
    "vw_quality_results": f"""
        SELECT {_STEP_KEYS}, rule_name, rule_type, rule_result, sum(valid_records)::BIGINT AS valid_records,
               sum(invalid_records)::BIGINT AS invalid_records, sum(warning_records)::BIGINT AS warning_records,
               min(threshold_value) AS threshold_value, min(measured_value) AS measured_value
        FROM step_facts WHERE rule_name <> '' GROUP BY ALL""",
    "vw_quality_results_exact": f"""
        SELECT {_STEP_KEYS}, rule_name, rule_type, rule_result, sum(valid_records)::BIGINT AS valid_records,
               sum(invalid_records)::BIGINT AS invalid_records, sum(warning_records)::BIGINT AS warning_records,
               min(threshold_value::DOUBLE) AS threshold_value, min(measured_value::DOUBLE) AS measured_value
        FROM step_facts WHERE rule_name <> '' GROUP BY ALL""",
    "vw_schema_validation_results": f"""
        SELECT {_STEP_KEYS}, schema_name, schema_version, validation_result, missing_columns, unexpected_columns,
               validation_message, validated_at FROM step_facts WHERE schema_name <> ''""",
    "vw_rejections_summary": f"""
        SELECT {_STEP_KEYS}, rejection_reason, rejection_category, sum(rejected_count_summary)::BIGINT AS total_rejected,
               avg(rejection_percent) AS avg_rejection_percent, min(rejected_detail_path) AS rejected_detail_path,
               min(sample_message) AS sample_message
        FROM step_facts WHERE rejection_reason <> '' GROUP BY ALL""",
    "vw_file_lineage": f"""
        SELECT {_STEP_KEYS}, artifact_type, artifact_role, lineage_bucket, lineage_key, lineage_format, record_count_lineage,
               file_size_bytes, parent_bucket, parent_key, lineage_created_at FROM step_facts WHERE artifact_type <> ''""",
    "vw_curated_with_run_context": f"""
        SELECT {_DOMAIN}, 'transaction' AS domain, c.product, c.business_date, {_CLOCK} AS enriched_at,
               r.status AS run_status, execution_id, ingestion_id, source_bucket, source_key, source_file_name
        FROM final_rows c {_RUN_JOIN.format('c')} AND r.status = 'SUCCEEDED'""",
    "vw_curated_with_run_context_exact": f"""
        SELECT {_DOMAIN}, 'transaction' AS domain, c.product, c.business_date, {_CLOCK} AS enriched_at,
               r.status AS run_status, execution_id, ingestion_id, source_bucket, source_key, source_file_name
        FROM final_rows c LEFT JOIN run_facts r ON r.execution_id = c.run_id""",
    "vw_rejected_with_context": f"""
        SELECT x.run_id, stage, x.product, x.business_date, file_name, row_number, reason, raw_row, r.status AS run_status,
               ingestion_id, source_file_name FROM rejected_zone x {_RUN_JOIN.format('x')}""",
    "vw_rejected_with_context_exact": """
        SELECT x.run_id, stage, x.product, x.business_date, file_name, row_number, reason, raw_row, r.status AS run_status,
               ingestion_id, source_file_name FROM rejected_zone x LEFT JOIN run_facts r ON r.execution_id = x.run_id""",
    "vw_ingested_with_source": f"""
        SELECT {_DOMAIN}, 'transaction' AS domain, c.product, c.business_date, r.anomesdia, source_bucket, source_key,
               source_file_name, ingestion_id, execution_id, r.status AS run_status, raw_path, processed_path, curated_path
        FROM final_rows c {_RUN_JOIN.format('c')} AND r.status = 'SUCCEEDED'""",
    # reports
    "runs_by_status": """
        SELECT anomesdia, product, status, count(*)::BIGINT AS total_runs, sum(total_records)::BIGINT AS total_records,
               sum(processed_records)::BIGINT AS processed_records, sum(rejected_records)::BIGINT AS rejected_records
        FROM run_facts GROUP BY ALL""",
    "troubleshooting_dashboard": """
        SELECT anomesdia, product, status AS run_status, source_bucket, source_key, source_file_name, total_records,
               processed_records, rejected_records, error_records, failure_step, error_message AS run_error, raw_path,
               processed_path, curated_path, rejected_path FROM run_facts""",
    "steps_summary": """
        SELECT anomesdia, product, step_order, step_name, status, count(*)::BIGINT AS attempts,
               sum(input_records)::BIGINT AS input_records, sum(output_records)::BIGINT AS output_records,
               sum(rejected_records)::BIGINT AS rejected_records FROM step_facts GROUP BY ALL""",
    "errors_from_steps": f"""
        SELECT {_STEP_KEYS}, error_type, error_code, error_message, error_category, source_bucket, source_key, occurred_at
        FROM step_facts WHERE {_ERR}""",
    "quality_from_steps": f"""
        SELECT {_STEP_KEYS}, rule_name, rule_type, rule_result, sum(valid_records)::BIGINT AS valid_records,
               sum(invalid_records)::BIGINT AS invalid_records FROM step_facts WHERE rule_name <> '' GROUP BY ALL""",
    "schema_from_steps": f"""
        SELECT {_STEP_KEYS}, schema_name, validation_result, missing_columns, unexpected_columns, validated_at
        FROM step_facts WHERE schema_name <> ''""",
    "rejections_from_steps": f"""
        SELECT {_STEP_KEYS}, rejection_reason, rejection_category, sum(rejected_count_summary)::BIGINT AS total_rejected,
               round(avg(rejection_percent), 2) AS avg_pct, min(rejected_detail_path) AS detail_path,
               min(sample_message) AS sample
        FROM step_facts WHERE rejection_reason <> '' GROUP BY ALL""",
    "lineage_from_steps": """
        SELECT anomesdia, product, artifact_type, count(*)::BIGINT AS files,
               sum(record_count_lineage)::BIGINT AS total_records
        FROM step_facts WHERE artifact_type <> '' GROUP BY ALL""",
    "curated_with_run_context": f"""
        SELECT c.product, c.business_date, 'transaction' AS domain, count(*)::BIGINT AS curated_records,
               r.status AS run_status
        FROM final_rows c {_RUN_JOIN.format('c')} AND r.status = 'SUCCEEDED'
        GROUP BY c.product, c.business_date, r.status""",
    "rejected_detail": """
        SELECT product, stage, reason, count(*)::BIGINT AS rows FROM rejected_zone GROUP BY product, stage, reason""",
    "error_detail_with_source": f"""
        SELECT s.anomesdia, s.product, step_name, error_type, error_code, s.error_message, error_category, occurred_at,
               s.source_bucket, s.source_key, r.source_file_name, r.status AS run_status
        FROM (SELECT * FROM step_facts WHERE {_ERR}) s LEFT JOIN run_facts r ON r.ingestion_id = s.ingestion_id""",
}


# re-delivered facts read as if they had been delivered once
_SELECTS["redelivered_runs"] = _SELECTS["ingestion_runs"]
_SELECTS["redelivered_status_by_day"] = _SELECTS["vw_ingestion_status_by_day"]
_SELECTS["redelivered_curated_with_run_context"] = _SELECTS["vw_curated_with_run_context_exact"]
_SELECTS["scan_quoted_breaks"] = """
    SELECT 'texts-' || coalesce(lang, 'none') AS run_id, doc_id, coalesce(text, '') AS text, source FROM documents"""
_SELECTS["quoted_break_numbers"] = """
    SELECT 'texts-' || coalesce(lang, 'none') AS run_id, count(*)::BIGINT AS numbers, 1::BIGINT AS least,
           count(*)::BIGINT AS most, count(*)::BIGINT AS total FROM documents GROUP BY ALL"""
_SELECTS["scan_curated"] = _SELECTS["curated"]
_SELECTS["scan_rejected"] = """
    SELECT run_id, stage, product, row_number, reason, business_date, split_part(business_date, '-', 1) AS year,
           split_part(business_date, '-', 2) AS month, split_part(business_date, '-', 3) AS day FROM rejected_zone"""
# two batches with one number, a replay and an attempt that failed leave what one delivery leaves
_SELECTS["ledger_runs"] = _SELECTS["ingestion_runs"]
_SELECTS["ledger_steps"] = _SELECTS["ingestion_steps"]
_SELECTS["ledger_messages"] = _SELECTS["outbox_payload_json"]
_SELECTS["ledger_quarantine"] = """
    SELECT (message_id // 10 % 2)::VARCHAR AS batch_id, reason, count(*)::BIGINT AS messages
    FROM checked_events WHERE outcome = 'quarantined' GROUP BY ALL"""
_SELECTS["ledger_batches"] = """
    SELECT * FROM (WITH runs AS (SELECT product <> 'orders' AS second, count(*)::BIGINT AS n FROM run_facts GROUP BY ALL),
         bad AS (SELECT message_id // 10 % 2 = 1 AS second, count(*)::BIGINT AS n FROM checked_events WHERE outcome = 'quarantined' GROUP BY ALL),
         failures AS (SELECT product <> 'orders' AS second, count(*)::BIGINT AS n FROM bad_files GROUP BY ALL),
         sent AS (SELECT count(*)::BIGINT AS n FROM messages_out)
    SELECT 0::BIGINT AS sequence, 'events-a' AS origin, 0::BIGINT AS number, 'committed' AS state,
           coalesce((SELECT n FROM runs WHERE NOT second), 0) AS ingestion_runs, coalesce((SELECT n FROM bad WHERE NOT second), 0) AS quarantine,
           coalesce((SELECT n FROM failures WHERE NOT second), 0) AS outbox
    UNION ALL SELECT 1, 'events-b', 0, 'committed', coalesce((SELECT n FROM runs WHERE second), 0),
           coalesce((SELECT n FROM bad WHERE second), 0), coalesce((SELECT n FROM failures WHERE second), 0)
    UNION ALL SELECT 2, 'curated-a', 0, 'committed', 0, 0, (SELECT n FROM sent) - (SELECT coalesce(sum(n), 0) FROM failures)::BIGINT
    UNION ALL SELECT 3, 'events-c', 0, 'open', (SELECT sum(n) FROM runs)::BIGINT, (SELECT sum(n) FROM bad)::BIGINT, (SELECT n FROM sent))"""
# SQL over the catalog finds what the lake holds, after re-delivery and batch by batch
_SELECTS["catalog_redelivered_status_by_day"] = _SELECTS["vw_ingestion_status_by_day"]
_SELECTS["catalog_curated_by_day"] = """
    SELECT product, business_date, count(*)::BIGINT AS curated_records, count(DISTINCT run_id)::BIGINT AS runs
    FROM final_rows GROUP BY ALL"""
_SELECTS["catalog_ledger_tables"] = _SELECTS["catalog_tables"].replace("ingestion_", "ledgered_").replace("ledgered_runs", "ingestion_runs").replace("ledgered_steps", "ingestion_steps")
# from files the same records come out
for _name in ("threshold_gate", "processed", "curated"):
    _SELECTS[f"file_{_name}"] = _SELECTS[_name]
_SELECTS["odd_run_ids"] = """
    SELECT o_orderpriority || ':%2F/{é} =*?' || o_orderstatus AS run_id, count(*)::BIGINT AS records,
           min(o_orderkey)::BIGINT AS least FROM orders GROUP BY ALL"""
_SELECTS["scan_jsonl_zone"] = f"""
    SELECT run_id, {_DOMAIN}, 'transaction' AS domain, business_date, product FROM final_rows"""
_SELECTS["small_number_text"] = """
    SELECT l_orderkey, l_linenumber, (l_linenumber / (l_orderkey + 1) / 8)::VARCHAR AS share FROM lineitem"""


def _escapes(column: str) -> str:
    """Bytes that ASCII JSON adds to the characters of a text."""
    held = lambda pattern: f"length({column}) - length(regexp_replace({column}, '{pattern}', '', 'g'))"
    short, odd, pairs = held(r'["\\\n\t\r]'), held(r"[^ -~\n\t\r]"), held(r"[\x{10000}-\x{10FFFF}]")
    return f"length({column}) + ({short}) + 5 * ({odd}) + 6 * ({pairs})"


_SELECTS["json_sizes"] = f"""
    SELECT doc_id, ({len('{"lang": "", "text": ""}') + 1} + {_escapes("coalesce(lang, '')")} + {_escapes("coalesce(text, '')")})::BIGINT
             AS n_bytes FROM documents"""


def oracle_sql() -> dict[str, str]:
    return {name: _sql(select) for name, select in _SELECTS.items()}
