from sluice.functions.dates import anomesdia, business_day, clock_text, date_key, partition_prefix
from sluice.functions.keys import (
    base_name,
    curated_key,
    manifest_key,
    object_uri,
    processed_key,
    raw_key,
    rejected_key,
    run_id_for,
    run_id_from_key,
    product_from_key,
    sanitize_fragment,
    source_key,
    stem,
)
from sluice.functions.text import blank, csv_line, double_text, first_filled, json_line_bytes, python_json, sorted_json

__all__ = [
    "anomesdia",
    "base_name",
    "blank",
    "business_day",
    "clock_text",
    "csv_line",
    "curated_key",
    "date_key",
    "double_text",
    "first_filled",
    "json_line_bytes",
    "manifest_key",
    "object_uri",
    "partition_prefix",
    "processed_key",
    "product_from_key",
    "python_json",
    "raw_key",
    "rejected_key",
    "run_id_for",
    "run_id_from_key",
    "sanitize_fragment",
    "sorted_json",
    "source_key",
    "stem",
]
