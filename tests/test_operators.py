"""Operators against brute force, hot groups included."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.operators import gate, harmonize, ordinals, publish
from sluice.session import planned_bytes, stage


@pytest.mark.parametrize(
    "total, bad, percent, count, want",
    [
        (100, 0, 0, 0, False),
        (100, 1, 1, 1000, False),
        (100, 2, 1, 1000, True),
        (0, 1, 50, 10, True),
        (0, 1, 100, 10, False),
        (10, 5, 50, 10, False),
        (10, 11, 50, 10, True),
        (100000, 11, 50, 10, True),
        (3, 1, 33.4, 10, False),
        (3, 1, 33.3, 10, True),
    ],
)
def test_threshold(spark, total, bad, percent, count, want):
    counts = spark.createDataFrame([("r", total, bad)], "run_id string, total bigint, rejected bigint")
    runs = spark.createDataFrame(
        [("r", "p", float(percent), count)],
        "run_id string, product string, max_error_percent double, max_error_count bigint",
    )
    assert gate.threshold_gate(counts, runs).first().exceeded is want


def test_number_by_key_with_a_hot_group(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(50)}", i) for i in rng.sample(range(10**6), 6000)]
    df = spark.createDataFrame(rows, "g string, k bigint").repartition(7)
    want = defaultdict(list)
    for g, k in rows:
        want[g].append(k)
    rank = {(g, k): n for g, ks in want.items() for n, k in enumerate(sorted(ks), 1)}
    got = ordinals.number_by_key(df, ["g"], ["k"]).collect()
    assert {(r.g, r.k): r.row_number for r in got} == rank


def test_renumber_without(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "CHUNK", 16)
    rng = random.Random(3)
    kept, gone = [], []
    want = {}
    for run, size in (("a", 500), ("b", 3), ("c", 40)):
        place = 0
        for n in range(1, size + 1):
            if rng.random() < 0.3:
                gone.append((run, n))
            else:
                place += 1
                if rng.random() < 0.4:
                    kept.append((run, n, f"{run}{n}"))
                    want[(run, n)] = place
    rows = spark.createDataFrame(kept, "run_id string, row_number bigint, x string")
    removed = spark.createDataFrame(gone, "run_id string, row_number bigint")
    got = ordinals.renumber_without(rows, removed).collect()
    assert {(r.run_id, r.row_number): r.position for r in got} == want
    assert all(r.x == f"{r.run_id}{r.row_number}" for r in got)


def test_mask_and_reason(spark):
    rows = [("", "c", "", "d"), ("t", "c", "a", "d"), ("", "", "", ""), (" ", "0", "a", "d")]
    df = harmonize.classify(spark.createDataFrame(rows, ", ".join(f"{f} string" for f in harmonize.DOMAIN_FIELDS)))
    got = [r.reason for r in df.select(harmonize.mask_reason(F.col("mask")).alias("reason")).collect()]
    assert got == [
        "missing domain fields: transaction_id, amount",
        None,
        "missing domain fields: transaction_id, customer_id, amount, transaction_date",
        None,
    ]


def test_first_reason_is_in_row_order(spark):
    rows = [("r", n, "t", "c" if n != 3 else "", "" if n == 9 else "a", "d") for n in (9, 5, 3, 1)]
    schema = "run_id string, row_number bigint, " + ", ".join(f"{f} string" for f in harmonize.DOMAIN_FIELDS)
    row = harmonize.counts(harmonize.classify(spark.createDataFrame(rows, schema))).first()
    assert (row.total, row.rejected, row.first_reason) == (4, 2, "missing domain fields: customer_id")


def test_duplicate_header_names_mean_the_last_column(spark):
    df = spark.createDataFrame([(["a", "b", "a"], "a"), (["a", "b", "a"], "z")], "h array<string>, n string")
    assert [r[0] for r in df.select(harmonize.last_index(F.col("h"), F.col("n"))).collect()] == [2, None]
    (fields,) = df.limit(1).select(harmonize.raw_fields(F.col("h"))).first()
    assert [(f.name, f.at) for f in fields] == [("a", 2), ("b", 1)]


def test_publish_summary(spark):
    routed = spark.createDataFrame(
        [(1, "curated", "p", None), (1, "rejected", "p", None), (2, "curated", "nope", None), (3, "curated", None, "bad")],
        "message_id int, route string, product string, reason string",
    )
    configs = spark.createDataFrame([("p", (["b", "a"],), ["q"])], "product string, publish struct<destinations: array<string>>, quality_destinations array<string>")
    row = publish.publish_summary(routed, configs, "message_id").first()
    assert row.asDict() == {"received_messages": 3, "processed_messages": 1, "published_destinations": "a, b, q"}


def test_staged_tables_know_their_size(spark):
    staged = stage(spark.range(1000).toDF("x"), "size")
    assert planned_bytes(staged) < 50_000
    assert staged.count() == 1000
