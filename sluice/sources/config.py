"""Product configs and layout mappings: parsing and validation, all rows at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.contracts import (
    DEFAULT_MAX_ERROR_COUNT,
    DEFAULT_MAX_ERROR_PERCENT,
    DEFAULT_QUALITY_DESTINATIONS,
    DOMAIN,
    DOMAIN_FIELDS,
    LAYOUT_MAPPING,
    PRODUCT_CONFIG,
)

_CONFIG_DOC = T.StructType([T.StructField("products", T.MapType(T.StringType(), PRODUCT_CONFIG))])


def parse_product_configs(docs: DataFrame, body: str = "value") -> DataFrame:
    """JSON documents ``{"products": {name: config}}`` to one row per product."""
    parsed = docs.select(F.from_json(body, _CONFIG_DOC)["products"].alias("products"))
    return parsed.select(F.explode("products").alias("product", "config")).select("product", "config.*")


def read_product_configs(spark: SparkSession, path: str) -> DataFrame:
    return parse_product_configs(spark.read.text(path, wholetext=True))


def parse_layout_mappings(docs: DataFrame, key: Column, body: str = "value") -> DataFrame:
    return docs.select(key.alias("mapping_key"), F.from_json(body, LAYOUT_MAPPING).alias("m")).select(
        "mapping_key", "m.*"
    )


def read_layout_mappings(spark: SparkSession, path: str, key_prefix: str = "de-para/") -> DataFrame:
    docs = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file_name"))
    return parse_layout_mappings(docs, F.concat(F.lit(key_prefix), "file_name"))


def rejection_policies(configs: DataFrame) -> DataFrame:
    """Effective rejection policy per product: each missing setting falls back to its default."""
    policy = F.col("rejection_policy")
    return configs.withColumns(
        {
            "max_error_percent": F.coalesce(policy["max_error_percent"], F.lit(DEFAULT_MAX_ERROR_PERCENT)),
            "max_error_count": F.coalesce(policy["max_error_count"], F.lit(DEFAULT_MAX_ERROR_COUNT).cast("bigint")),
            "quality_destinations": F.coalesce(
                policy["destinations"], F.array(*[F.lit(d) for d in DEFAULT_QUALITY_DESTINATIONS])
            ),
        }
    )


def validate_configs(configs: DataFrame) -> DataFrame:
    """Add the effective policy and ``config_error``: the first broken rule, or NULL for a usable product."""
    subject = F.concat(F.lit("product "), F.col("product"))

    def broken(rule: Column, text: str) -> Column:
        return F.when(rule, F.concat(subject, F.lit(text)))

    destinations = F.col("publish.destinations")
    return rejection_policies(configs).withColumn(
        "config_error",
        F.coalesce(
            broken(~F.col("domain").eqNullSafe(DOMAIN), f" must map to domain {DOMAIN}"),
            broken(F.coalesce("mapping_key", F.lit("")) == "", " missing mapping_key"),
            broken(F.coalesce(F.size(destinations), F.lit(-1)) <= 0, " missing publish destinations"),
            broken(
                ~F.col("max_error_percent").between(0, 100),
                " rejection_policy.max_error_percent must be between 0 and 100",
            ),
            broken(F.col("max_error_count") < 0, " rejection_policy.max_error_count must be >= 0"),
            broken(F.size("quality_destinations") <= 0, " rejection_policy missing destinations"),
        ),
    )


def validate_mappings(mappings: DataFrame, subject: Column | None = None) -> DataFrame:
    """Add ``mapping_error``: the first broken rule, or NULL. ``subject`` is the name used in the text."""
    subject = F.col("mapping_key") if subject is None else subject
    wanted = F.array(*[F.lit(f) for f in DOMAIN_FIELDS])
    required = F.coalesce("domain_required_fields", F.array().cast("array<string>"))
    mapped = F.coalesce(F.map_values("layout_mapping"), F.array().cast("array<string>"))
    missing = F.array_except(wanted, mapped)
    differs = (F.size(F.array_except(wanted, required)) > 0) | (F.size(F.array_except(required, wanted)) > 0)

    def broken(rule: Column, *text: Column | str) -> Column:
        tail = [F.lit(t) if isinstance(t, str) else t for t in text]
        return F.when(rule, F.concat(F.lit("mapping for "), subject, *tail))

    return mappings.withColumn(
        "mapping_error",
        F.coalesce(
            broken(~F.col("domain").eqNullSafe(DOMAIN), f" must map to domain {DOMAIN}"),
            broken(F.size(mapped) <= 0, " missing layout_mapping"),
            broken(differs, f" must require fields: {', '.join(DOMAIN_FIELDS)}"),
            broken(F.size(missing) > 0, " missing domain fields: ", F.concat_ws(", ", missing)),
        ),
    )
