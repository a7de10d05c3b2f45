"""Every registered query against its SQL twin, and the shape of the plans that matter at scale."""

import pytest

import __spark_entry__ as entry
from sluice.workload import feeds, oracle, queries
from tests.check import connect, difference

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, ORACLES[name]) == ""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_aggregates_before_its_only_shuffle(spark):
    text = plan(entry.queries()["threshold_gate"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text and "SortAggregate" not in text and "SortMergeJoin" not in text


def test_processed_rows_never_shuffle(spark):
    text = plan(entry.queries()["processed"](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_no_query_evaluates_python(spark):
    for name in ("curated", "outbox_payload_json", "ingestion_steps", "event_envelope", "scan_raw"):
        text = plan(entry.queries()[name](spark, SF_DIR))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text, name


def test_zone_scans_prune_partitions_and_columns(spark):
    at = feeds.lake(spark, SF_DIR)
    text = plan(at.read("curated").filter("product = 'orders' and year = '1997'").select("amount"))
    assert "ReadSchema: struct<amount:string>" in text and "PartitionFilters: [isnotnull(product" in text
    text = plan(feeds.payments_feed(spark, SF_DIR).groupBy("run_id").count())
    assert "l_discount" not in text and "l_tax" not in text
