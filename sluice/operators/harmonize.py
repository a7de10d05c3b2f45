"""Raw records to the shared domain: layout resolution, schema drift and the required-field check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluice.contracts import DOMAIN_FIELDS, NAMES, LakeNames
from sluice.functions import object_uri
from sluice.sources.config import validate_mappings

FILE_KEY = ("run_id", "file_path")
_BITS = {field: 1 << i for i, field in enumerate(DOMAIN_FIELDS)}
_CODE = 1 << len(DOMAIN_FIELDS)


def source_field(layout: Column, field: str) -> Column:
    """Source column mapped to a domain field; when several are, the last one in the mapping."""
    hits = F.filter(F.map_entries(layout), lambda e: e["value"] == field)
    return F.try_element_at(hits, F.lit(-1))["key"]


def last_index(header: Column, name: Column) -> Column:
    """0-based index of a header name, NULL if absent; a repeated name means its last column."""
    from_end = F.array_position(F.reverse(header), name)
    return F.when(from_end > 0, F.size(header) - from_end).cast("int")


def raw_fields(header: Column) -> Column:
    """(name, index) of every distinct header name, by name, to rebuild a record as a key-sorted object."""
    names = F.array_sort(F.array_distinct(header))
    return F.transform(names, lambda n: F.struct(n.alias("name"), last_index(header, n).alias("at")))


def product_layouts(configs: DataFrame, mappings: DataFrame, names: LakeNames = NAMES) -> DataFrame:
    """Layout mapping of every product with ``mapping_error``: the mapping's first broken rule, or its absence."""
    found = validate_mappings(
        configs.select("product", "mapping_key").join(
            mappings.withColumn("_found", F.lit(True)), "mapping_key", "left"
        ),
        F.col("product"),
    )
    absent = F.concat(F.lit("s3 object not found: "), object_uri(F.lit(names.data_bucket), F.col("mapping_key"), names))
    return found.select(
        "product",
        "mapping_key",
        "layout_mapping",
        F.when(F.col("_found").isNull(), absent).otherwise(F.col("mapping_error")).alias("mapping_error"),
    )


def file_layouts(headers: DataFrame, runs: DataFrame, layouts: DataFrame) -> DataFrame:
    """Resolve every file's header against its product's layout, once per file instead of once per record.

    ``headers``: run_id, file_path, header. ``runs``: run_id, product. ``layouts``: see :func:`product_layouts`.
    """
    layout = F.col("layout_mapping")
    header = F.col("header")
    found = headers.join(runs.select("run_id", "product"), "run_id").join(layouts, "product")
    return found.select(
        "run_id",
        "file_path",
        "mapping_error",
        F.array_except(F.map_keys(layout), header).alias("missing"),
        F.array_sort(F.array_except(header, F.map_keys(layout))).alias("unexpected"),
        F.map_keys(layout).alias("layout_sources"),
        raw_fields(header).alias("raw_fields"),
        *[last_index(header, source_field(layout, f)).alias(f"at_{f}") for f in DOMAIN_FIELDS],
    )


def schema_check(layouts: DataFrame, counts: DataFrame) -> DataFrame:
    """One verdict per run. A file without records has no columns, so all mapped ones are missing.

    ``counts``: run_id, total. A run fed by several part files fails if any part lacks a mapped column.
    """
    # a set of names stays as small as the headers, however many part files a run has
    names = layouts.select("run_id", "mapping_error", "layout_sources", "missing", "unexpected")
    gaps = names.select("run_id", F.explode("missing").alias("name")).groupBy("run_id")
    extras = names.select("run_id", F.explode("unexpected").alias("name")).groupBy("run_id")
    empty = F.array().cast("array<string>")
    per_run = (
        names.groupBy("run_id")
        .agg(F.min("mapping_error").alias("mapping_error"), F.max("layout_sources").alias("layout_sources"))
        .join(gaps.agg(F.collect_set("name").alias("_gaps")), "run_id", "left")
        .join(extras.agg(F.array_sort(F.collect_set("name")).alias("unexpected")), "run_id", "left")
        .withColumns(
            {
                "missing": F.array_intersect("layout_sources", F.coalesce("_gaps", empty)),
                "unexpected": F.coalesce("unexpected", empty),
            }
        )
    )
    missing = F.when(F.coalesce("total", F.lit(0)) == 0, F.col("layout_sources")).otherwise(F.col("missing"))
    return (
        per_run.join(counts.select("run_id", "total"), "run_id", "left")
        .withColumn("missing", missing)
        .select(
            "run_id",
            "mapping_error",
            F.concat_ws(", ", "missing").alias("missing_columns"),
            F.concat_ws(", ", F.when(F.size("missing") == 0, F.col("unexpected"))).alias("unexpected_columns"),
            (F.col("mapping_error").isNull() & (F.size("missing") == 0)).alias("schema_ok"),
        )
    )


def map_records(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """Rename source cells to domain fields for all products in one pass; an absent cell is the empty string."""
    picks = {f: F.coalesce(F.get("cells", F.col(f"at_{f}")), F.lit("")) for f in DOMAIN_FIELDS}
    columns = [*FILE_KEY, "raw_fields", *[f"at_{f}" for f in DOMAIN_FIELDS]]
    return rows.join(layouts.select(*columns), list(FILE_KEY)).withColumns(picks).drop(
        *[f"at_{f}" for f in DOMAIN_FIELDS]
    )


def missing_mask() -> Column:
    """One bit per blank required field, so that counts and first rejects aggregate as plain numbers."""
    bits = [F.when(F.col(f) == "", F.lit(b)).otherwise(F.lit(0)) for f, b in _BITS.items()]
    return sum(bits[1:], bits[0])


def mask_reason(mask: Column) -> Column:
    names = [F.when(mask.bitwiseAND(F.lit(b)) != 0, F.lit(f)) for f, b in _BITS.items()]
    return F.when(mask != 0, F.concat(F.lit("missing domain fields: "), F.concat_ws(", ", *names)))


def classify(mapped: DataFrame) -> DataFrame:
    """Add ``mask``: 0 for an accepted record, otherwise its missing required fields."""
    return mapped.withColumn("mask", missing_mask())


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter("mask = 0")


def rejected(classified: DataFrame) -> DataFrame:
    """Rejected records with their reason and the original record as a key-sorted JSON object."""
    record = F.map_from_entries(
        F.transform("raw_fields", lambda f: F.struct(f["name"], F.get("cells", f["at"])))
    )
    return classified.filter("mask > 0").withColumns(
        {
            "reason": mask_reason(F.col("mask")),
            "raw_row": F.to_json(record, {"ignoreNullFields": "false"}),
        }
    )


def _measures() -> list[Column]:
    """Rejects and the first one's place and mask in one number, so that hash aggregation pre-combines."""
    bad = F.col("mask") > 0
    first = F.min(F.when(bad, F.col("row_number") * _CODE + F.col("mask")))
    return [F.count_if(bad).alias("rejected"), first.alias("_first")]


def _with_reason(counted: DataFrame) -> DataFrame:
    return counted.withColumn("first_reason", mask_reason(F.col("_first") % _CODE)).drop("_first")


def counts(classified: DataFrame) -> DataFrame:
    """Per run: records, rejects and the first reject's reason."""
    return _with_reason(classified.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"), *_measures()))


def reject_counts(totals: DataFrame, bad: DataFrame) -> DataFrame:
    """The same counts when the totals are known (run_id, total) and only the rejects are at hand."""
    per_run = bad.groupBy("run_id").agg(*_measures())
    counted = totals.join(per_run, "run_id", "left").withColumn(
        "rejected", F.coalesce("rejected", F.lit(0).cast("bigint"))
    )
    return _with_reason(counted)
