"""Lookups by missing keys."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import enrich
from sluice.operators.enrich import Lookup

REASON = "customer not found in enrichment base"


@pytest.fixture
def threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)

    def put(value):
        spark.conf.set(key, value)

    yield put
    spark.conf.set(key, before)


def records(spark):
    # a third of all records share one key that is missing, one in ten has none
    key = F.when(F.col("id") % 3 == 0, "gone").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 50))
    other = F.when(F.col("id") % 7 == 0, "x").otherwise("y")
    return spark.range(3000).select(F.lit("r").alias("run_id"), "id", key.alias("customer_id"), other.alias("amount"))


def verdicts(checked):
    return {r.id: r.reject_reason for r in checked.select("id", "reject_reason").collect()}


def expected(i, known=range(40)):
    key = "gone" if i % 3 == 0 else None if i % 10 == 1 else f"c{i % 50}"
    return None if key in {f"c{k}" for k in known} else REASON


@pytest.mark.parametrize("limit", ["32m", "-1"])
def test_verdicts_with_and_without_broadcast(spark, threshold, limit):
    threshold(limit)
    reference = spark.createDataFrame([(f"c{i}",) for i in range(40)] * 2 + [(None,)], "customer_id string")
    checked = enrich.check_lookups(records(spark), [Lookup(reference)])
    assert verdicts(checked) == {i: expected(i) for i in range(3000)}
    assert checked.columns == ["run_id", "id", "customer_id", "amount", "reject_reason"]


def test_the_first_of_several_lookups_gives_the_reason(spark):
    reference = spark.createDataFrame([(f"c{i}",) for i in range(40)], "customer_id string")
    amounts = Lookup(spark.createDataFrame([("y",)], "a string"), "amount", "a", "odd amount")
    checked = enrich.check_lookups(records(spark), [Lookup(reference), amounts])
    assert verdicts(checked) == {i: expected(i) or ("odd amount" if i % 7 == 0 else None) for i in range(3000)}


def test_empty_reference_and_empty_records(spark):
    nobody = Lookup(spark.createDataFrame([], "customer_id string"))
    assert set(verdicts(enrich.check_lookups(records(spark), [nobody])).values()) == {REASON}
    assert enrich.check_lookups(records(spark).limit(0), [nobody]).count() == 0


def test_records_stay_where_they_are_beside_a_large_reference(spark, threshold):
    threshold("20k")
    reference = spark.range(200_000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("customer_id"))
    checked = enrich.check_lookups(records(spark), [Lookup(reference)])
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert {r for r in verdicts(checked).values()} == {None, REASON}
