"""Messages, notifications and config documents derived row by row from the tables, malformed variants included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.contracts import DOMAIN_FIELDS
from sluice.workload.feeds import table

_VARIANTS = 10


def _event_fields() -> dict[str, Column]:
    kind = F.col("event_type")
    product = F.when(kind.isin("click", "view"), "orders").when(kind == "purchase", "payments").otherwise("invoices")
    day = F.date_format("ts", "yyyy-MM-dd")
    return {
        "product": product,
        "file_name": F.concat(product, F.lit("-"), F.col("event_id").cast("string"), F.lit(".csv")),
        "business_date": day,
    }


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One queue message per event row: message_id and value, in ten shapes."""
    f = _event_fields()
    eid = F.col("event_id").cast("string")

    def obj(*skip: str, **changed: Column) -> Column:
        fields = {k: v for k, v in f.items() if k not in skip} | changed
        return F.struct(*[c.alias(k) for k, c in fields.items()])

    def envelope(detail: Column, source: str = "local.product-lake") -> Column:
        kind = F.lit("file-ready").alias("detail-type")
        return F.to_json(F.struct(F.lit(source).alias("source"), kind, detail.alias("detail")))

    overrides = obj(
        run_id=F.concat(F.lit("run-"), eid),
        ingestion_id=F.concat(F.lit("ing-"), eid),
        execution_id=F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("exec-"), eid)).otherwise(""),
        correlation_id=F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("corr-"), eid)).otherwise(""),
        anomesdia=F.when(F.col("user_id") % 5 == 0, "20200101").otherwise(""),
        source_key=F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("drop/"), eid)).otherwise(""),
    )
    shapes = [
        F.to_json(obj()),
        envelope(obj()),
        F.to_json(F.struct(F.to_json(obj()).alias("Detail"))),
        envelope(obj(), "other-source"),
        F.col("event_type"),
        envelope(obj("business_date")),
        envelope(obj(business_date=F.date_format("ts", "dd-MM-yyyy"))),
        envelope(F.from_json(F.lit("{}"), "map<string,string>")),
        F.to_json(obj("file_name")),
        envelope(overrides),
    ]
    body = F.lit(None)
    for i, shape in enumerate(shapes):
        body = F.when(F.col("event_id") % _VARIANTS == i, shape).otherwise(body)
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("message_id"), body.alias("value"))


def notification_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object-created message per order: message_id and value, in eight shapes."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    dated = F.concat(F.date_format("o_orderdate", "'year='yyyy'/month='MM'/day='dd"), F.lit("/run-"), text)
    product = F.when(key % 5 == 0, "payments").when(key % 17 == 0, "invoices").otherwise("orders")
    curated = F.concat(F.lit("curated/"), product, F.lit("/"), dated, F.lit("/part file.parquet"))
    rejected = F.concat(F.lit("rejected/harmonization/"), product, F.lit("/"), dated, F.lit("/f+1.jsonl"))

    def record(k: Column) -> Column:
        s3 = F.struct(F.struct(F.lit("data-lake").alias("name")).alias("bucket"), F.struct(k.alias("key")).alias("object"))
        return F.struct(s3.alias("s3"))

    def notice(*keys: Column) -> Column:
        return F.to_json(F.struct(F.array(*[record(F.url_encode(k)) for k in keys]).alias("Records")))

    def direct(**fields: Column) -> Column:
        return F.to_json(F.struct(F.lit("data-lake").alias("bucket"), *[c.alias(n) for n, c in fields.items()]))

    shapes = [
        notice(curated),
        notice(rejected),
        notice(curated, rejected),
        direct(key=curated),
        direct(
            key=rejected,
            event_type=F.lit("ingestion.file-failed"),
            product=product,
            run_id=F.concat(F.lit("given-"), text),
        ),
        F.lit('{"Event": "s3:TestEvent"}'),
        F.lit('{"hello": "world"}'),
        direct(key=F.concat(F.lit("manifests/"), text)),
    ]
    body = F.lit(None)
    for i, shape in enumerate(shapes):
        body = F.when(key % len(shapes) == i, shape).otherwise(body)
    return table(spark, sf_dir, "orders").select(key.alias("message_id"), body.alias("value"))


def config_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product-config document per customer, with each rule broken in some of them."""
    key = F.col("c_custkey")
    text = key.cast("string")

    def unless(divisor: int, value: Column) -> Column:
        return F.when(key % divisor != 0, value)

    destinations = F.when(key % 19 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.lower("c_mktsegment"), F.lit("analytics-events"))
    )
    policy = F.struct(
        F.when(key % 23 == 0, 101.0).when(key % 3 == 0, 2.5).alias("max_error_percent"),
        F.when(key % 29 == 0, -1).when(key % 2 == 0, key).alias("max_error_count"),
        F.when(key % 31 == 0, F.array().cast("array<string>"))
        .when(key % 5 == 0, F.array(F.lit("quality-"), F.lower("c_mktsegment")))
        .alias("destinations"),
    )
    config = F.struct(
        F.when(key % 11 == 0, "order").otherwise("transaction").alias("domain"),
        unless(13, F.concat(F.lit("de-para/c"), text, F.lit(".json"))).alias("mapping_key"),
        unless(17, F.struct(destinations.alias("destinations"))).alias("publish"),
        unless(7, policy).alias("rejection_policy"),
    )
    products = F.create_map(F.concat(F.lit("c"), text), config)
    return table(spark, sf_dir, "customer").select(F.to_json(F.struct(products.alias("products"))).alias("value"))


def mapping_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One layout-mapping document per part, with each rule broken in some of them."""
    key = F.col("p_partkey")
    sources = ("id", "customer", "value", "day")
    full = [x for s, d in zip(sources, DOMAIN_FIELDS) for x in (F.lit(s), F.lit(d))]
    layout = (
        F.when(key % 7 == 0, F.from_json(F.lit("{}"), "map<string,string>"))
        .when(key % 5 == 0, F.create_map(*full[:-2]))
        .when(key % 11 == 0, F.create_map(*full, F.lit("value_2"), F.lit("amount")))
        .otherwise(F.create_map(*full))
    )
    required = F.when(key % 13 == 0, F.array(*[F.lit(f) for f in DOMAIN_FIELDS[:3]])).otherwise(
        F.array(*[F.lit(f) for f in reversed(DOMAIN_FIELDS)])
    )
    doc = F.struct(
        F.when(key % 17 == 0, "order").otherwise("transaction").alias("domain"),
        required.alias("domain_required_fields"),
        layout.alias("layout_mapping"),
    )
    name = F.concat(F.lit("de-para/p"), key.cast("string"), F.lit(".json"))
    return table(spark, sf_dir, "part").select(name.alias("mapping_key"), F.to_json(doc).alias("value"))
