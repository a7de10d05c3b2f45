import json

from sluice.sources.config import validate_configs
from sluice.sources.events import batch_summary, open_envelopes, unconfigured, validate_events
from sluice.sources.notifications import notification_records, route_messages
from tests.conftest import event


def messages(spark, *bodies):
    rows = [(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "id int, value string")


def test_envelope_shapes(spark):
    e = event()
    opened = open_envelopes(
        messages(spark, e, {"detail": e}, {"Detail": json.dumps(e)}, {"detail": json.dumps(e)}, {"x": 1}, "not json", {"detail": {}}, "[1]")
    )
    got = {r.id: (r.product, r.reason) for r in opened.collect()}
    assert all(got[i] == ("orders", None) for i in range(4))
    assert all(got[i][1] == "message is not EventBridge file-ready event" for i in range(4, 8))


def test_verdicts_and_summary(spark, bench):
    configs = validate_configs(bench.configs())
    bodies = [
        event(),
        event("invoices"),
        {"detail": {"product": "orders", "file_name": "f.csv"}},
        {"detail": {"product": ""}},
        event(day="01-05-2026"),
        "garbage",
    ]
    validated = validate_events(open_envelopes(messages(spark, *bodies)), configs)
    got = {r.id: (r.outcome, r.reason) for r in validated.collect()}
    assert got == {
        0: ("accepted", None),
        1: ("refused", "product not configured: invoices"),
        2: ("quarantined", "event missing fields: business_date"),
        3: ("quarantined", "event missing fields: product, file_name, business_date"),
        4: ("quarantined", "business_date must use YYYY-MM-DD"),
        5: ("quarantined", "message is not EventBridge file-ready event"),
    }
    summary = {(r.outcome, r.reason): r.messages for r in batch_summary(validated).collect()}
    assert summary[("processed", "")] == 1 and sum(summary.values()) == 6
    opened = open_envelopes(messages(spark, event(), event("invoices")))
    assert [r.product for r in unconfigured(opened, configs).collect()] == ["invoices"]


def test_broken_config_refuses_the_event(spark, bench):
    from tests.conftest import product

    bench.config(orders=product(101))
    row = validate_events(open_envelopes(messages(spark, event())), validate_configs(bench.configs())).first()
    assert row.outcome == "refused" and "between 0 and 100" in row.reason


def test_notification_shapes(spark):
    def record(key, bucket="data-lake"):
        return {"s3": {"bucket": {"name": bucket}, "object": {"key": key}}}

    good = "curated/orders/year%3D2027/month%3D11/day%3D08/run-1/a+b.parquet"
    rows = notification_records(
        messages(
            spark,
            {"Records": [record(good), record("rejected/h/payments/y/m/d/run-2/f.jsonl")]},
            {"bucket": "b", "key": "curated/a%20b"},
            {"Event": "s3:TestEvent"},
            {"hello": "world"},
            {"Records": [{"s3": {}}]},
            {"Records": [record("", "b")], "bucket": "b", "key": "k"},
        )
    ).collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.bucket, r.key, r.reason))
    assert got[0][0] == ("data-lake", "curated/orders/year=2027/month=11/day=08/run-1/a b.parquet", None)
    assert len(got[0]) == 2
    assert got[1] == [("b", "curated/a%20b", None)]
    assert 2 not in got
    assert got[3] == got[4] == [(None, None, "message is not S3 notification")]
    assert got[5] == [("b", "k", None)]


def test_routes(spark):
    rejected = "rejected/harmonization/orders/year=2027/month=11/day=08/run-2/f.jsonl"
    rows = route_messages(
        notification_records(
            messages(
                spark,
                {"bucket": "b", "key": "curated/orders/year=2027/month=11/day=08/run-1/f.parquet"},
                {"bucket": "b", "key": rejected},
                {"bucket": "b", "key": rejected, "event_type": "ingestion.file-failed", "product": "p", "run_id": "r"},
                {"bucket": "b", "key": "odd/key"},
            )
        )
    ).orderBy("id").collect()
    assert [(r.route, r.product, r.run_id) for r in rows] == [
        ("curated", "orders", "run-1"),
        ("rejected", "orders", "run-2"),
        ("rejected", "p", "r"),
        ("curated", None, "unknown"),
    ]
    assert rows[3].reason == "unexpected pipeline file key: odd/key"
