"""Logical object keys and ids.

Facts and messages carry logical keys (``curated/<product>/year=…/<run_id>/<file>``); the physical tables use
``product=`` and ``run_id=`` folders in the same order, so one is derived from the other by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from sluice.contracts import NAMES, LakeNames
from sluice.functions.dates import partition_prefix
from sluice.functions.text import python_json


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(file_name: Column) -> Column:
    """File name without folder and without its last suffix; a leading dot is part of the name."""
    return F.regexp_replace(base_name(file_name), r"(?<=.)\.[^.]+$", "")


def source_key(product: Column, file_name: Column) -> Column:
    return F.concat_ws("/", product, file_name)


def _zone_key(zone: Column, product: Column, day: Column, run_id: Column, leaf: Column) -> Column:
    return F.concat_ws("/", zone, product, partition_prefix(day), run_id, leaf)


def raw_key(product: Column, day: Column, run_id: Column, file_name: Column) -> Column:
    return _zone_key(F.lit("raw"), product, day, run_id, file_name)


def processed_key(product: Column, day: Column, run_id: Column, file_name: Column) -> Column:
    return _zone_key(F.lit("processed"), product, day, run_id, F.concat(stem(file_name), F.lit(".parquet")))


def curated_key(processed: Column) -> Column:
    """A processed key moved to the curated zone; only the leading zone name changes."""
    return F.regexp_replace(processed, "^processed/", "curated/")


def rejected_key(stage: Column, product: Column, day: Column, run_id: Column, file_name: Column) -> Column:
    zone = F.concat(F.lit("rejected/"), stage)
    return _zone_key(zone, product, day, run_id, F.concat(stem(file_name), F.lit(".jsonl")))


def manifest_key(run_id: Column) -> Column:
    return F.concat(F.lit("manifests/"), run_id, F.lit(".json"))


def object_uri(bucket: Column, key: Column, names: LakeNames = NAMES) -> Column:
    return F.concat(F.lit(f"{names.scheme}://"), bucket, F.lit("/"), key)


def product_from_key(key: Column) -> Column:
    """Product named by a curated or rejected key; NULL for any other key."""
    parts = F.split(key, "/")
    return F.when(F.get(parts, F.lit(0)) == "curated", F.get(parts, F.lit(1))).when(
        F.get(parts, F.lit(0)) == "rejected", F.get(parts, F.lit(2))
    )


def run_id_from_key(key: Column) -> Column:
    parts = F.split(key, "/")
    zone = F.get(parts, F.lit(0))
    found = F.when(zone == "curated", F.get(parts, F.lit(5))).when(zone == "rejected", F.get(parts, F.lit(6)))
    return F.coalesce(found, F.lit("unknown"))


def sanitize_fragment(c: Column) -> Column:
    """Runs of characters outside letters, digits and ``_.=-`` become one dash; outer dashes go; never empty."""
    dashed = F.regexp_replace(c, r"[^A-Za-z0-9_.=-]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(dashed, r"^-+|-+$", ""), F.lit("")), F.lit("item"))


def run_id_for(fields: Sequence[tuple[str, Column]], clock: Column) -> Column:
    """Second-resolution stamp plus the first eight hex digits of the event's SHA-1."""
    digest = F.sha1(python_json(fields))
    return F.concat(F.date_format(clock, "yyyyMMddHHmmss"), F.lit("-"), F.substring(digest, 1, 8))
