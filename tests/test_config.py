import json

import pytest
from pyspark.sql import functions as F

from sluice.sources.config import parse_layout_mappings, parse_product_configs, validate_configs, validate_mappings
from tests.conftest import DOMAIN_FIELDS, product


def config_row(spark, config):
    doc = json.dumps({"products": {"orders": config}})
    return validate_configs(parse_product_configs(spark.createDataFrame([(doc,)], "value string"))).first()


@pytest.mark.parametrize(
    "config, error",
    [
        (product(), None),
        (product(100, 999999), None),
        (product(0, 0), None),
        (product(domain="order"), "product orders must map to domain transaction"),
        (product(mapping_key=""), "product orders missing mapping_key"),
        (product(publish={"destinations": []}), "product orders missing publish destinations"),
        ({k: v for k, v in product().items() if k != "publish"}, "product orders missing publish destinations"),
        (product(101), "product orders rejection_policy.max_error_percent must be between 0 and 100"),
        (product(-1), "product orders rejection_policy.max_error_percent must be between 0 and 100"),
        (product(1, -1), "product orders rejection_policy.max_error_count must be >= 0"),
        (product(rejection_policy={"destinations": []}), "product orders rejection_policy missing destinations"),
        # the first broken rule wins
        (product(101, domain="order", mapping_key=""), "product orders must map to domain transaction"),
    ],
)
def test_first_broken_config_rule(spark, config, error):
    assert config_row(spark, config).config_error == error


def test_policy_defaults_and_partial_override(spark):
    row = config_row(spark, {k: v for k, v in product().items() if k != "rejection_policy"})
    assert (row.max_error_percent, row.max_error_count, row.quality_destinations) == (1.0, 1000, ["data-quality-events"])
    row = config_row(spark, product(rejection_policy={"max_error_percent": 5}))
    assert (row.max_error_percent, row.max_error_count) == (5.0, 1000)


FULL = dict(zip("abcd", DOMAIN_FIELDS))


@pytest.mark.parametrize(
    "mapping, error",
    [
        ({"layout_mapping": FULL}, None),
        ({"layout_mapping": FULL, "domain_required_fields": DOMAIN_FIELDS[::-1]}, None),
        ({"layout_mapping": FULL, "domain": "order"}, "mapping for m must map to domain transaction"),
        ({"layout_mapping": {}}, "mapping for m missing layout_mapping"),
        ({}, "mapping for m missing layout_mapping"),
        (
            {"layout_mapping": FULL, "domain_required_fields": DOMAIN_FIELDS + ["x"]},
            "mapping for m must require fields: transaction_id, customer_id, amount, transaction_date",
        ),
        (
            {"layout_mapping": {k: v for k, v in FULL.items() if v not in ("amount", "transaction_date")}},
            "mapping for m missing domain fields: amount, transaction_date",
        ),
    ],
)
def test_first_broken_mapping_rule(spark, mapping, error):
    doc = json.dumps({"domain": "transaction", "domain_required_fields": DOMAIN_FIELDS, **mapping})
    docs = spark.createDataFrame([("m", doc)], "key string, value string")
    assert validate_mappings(parse_layout_mappings(docs, F.col("key"))).first().mapping_error == error
