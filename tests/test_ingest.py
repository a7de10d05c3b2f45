"""Batches from CSV files to zones, facts and messages.

One batch holds a run for every way a file can go; the tests look at the tables it left.
"""

import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import facts
from sluice.plans import reports, views
from sluice.plans.ingest import publish_zones
from sluice.sources.ledger import BatchKey
from tests.conftest import INVOICES_CSV, ORDERS_CSV, PAYMENTS_CSV, Bench, event, product

HEADER = "pedido_id,cliente_id,valor_total,data_pedido\n"
BLANK_AMOUNT = HEADER + "7301,C1,31.40,2027-11-08\n7302,C1,,2027-11-08\n"
UNKNOWN_CUSTOMER = HEADER + "7301,C1,31.40,2027-11-08\n7302,bad,5.00,2027-11-08\n"
TABLES = ("raw", "processed", "curated", "rejected", "ingestion_runs", "ingestion_steps", "manifests", "outbox")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    b = Bench(spark, tmp_path_factory.mktemp("world"))
    b.mapping("twice", {
        "id": "transaction_id", "c": "customer_id", "gross": "amount", "net": "amount", "d": "transaction_date", "z": "o",
    })
    b.mapping("partial", {"a": "transaction_id"})
    b.config(
        orders=product(),
        payments=product(mapping_key="de-para/payments-transaction.json"),
        lenient=product(50, 10),
        strict=product(1, 0),
        any=product(100, 100),
        twice=product(mapping_key="de-para/twice-transaction.json"),
        partial=product(mapping_key="de-para/partial-transaction.json"),
        lost=product(mapping_key="de-para/nowhere.json"),
        wrong=product(101),
    )
    files = {
        "orders-2027-11-08": ORDERS_CSV,
        "payments-2027-11-08": PAYMENTS_CSV,
        "invoices-2027-11-08": INVOICES_CSV,
        "lenient-2027-11-08": BLANK_AMOUNT,
        "strict-2027-11-08": BLANK_AMOUNT,
        "lenient-2027-11-09": UNKNOWN_CUSTOMER,
        "strict-2027-11-09": UNKNOWN_CUSTOMER,
        "any-2027-11-08": HEADER + "1,C1,1,d\n2,,1,d\n3,bad,1,d\n4,C1,,d\n5,C1,1,d\n6,bad,1,d\n",
        "any-2027-11-09": HEADER + "1,C1,5,d,surplus\n2,C1\n3,C1,0, \n",
        "strict-2026-05-03": "pedido_id,Cliente_id,valor_total,extra\n1,C,2,x\n",
        "strict-2026-05-04": "",
        "strict-2026-05-05": HEADER,
        "twice-2027-11-08": "id,c,net,gross,d,z\n1,C1,2,3,x,y\n",
        "partial-2027-11-08": ORDERS_CSV,
        "lost-2027-11-08": ORDERS_CSV,
        "wrong-2027-11-08": ORDERS_CSV,
    }
    for name, content in files.items():
        b.put(name.split("-")[0], f"{name}.csv", content)
    b.put("drop/batch", "part-0.csv", ORDERS_CSV)
    b.put("drop/batch", "part-1.csv", ORDERS_CSV.replace("730", "880"))
    b.put("drop/batch", "_SUCCESS", "")
    events = [event(n.split("-")[0], n.split("-", 1)[1], run_id=n) for n in files]
    events += [
        event(day="2026-05-09", run_id="absent"),
        event(day="2026-05-10", source_key="drop/batch", run_id="parts"),
        "garbage",
        event(day="01-05-2026"),
    ]
    b.batch = b.ingest(*events, lookups=b.reference("C1", "ana", "rui"))
    publish_zones(b.lake, b.configs(), b.lake.read("curated"), b.lake.read("rejected"))
    b.runs = {r["execution_id"]: r for r in b.rows("ingestion_runs")}
    b.steps = {(s["execution_id"], s["step_order"]): s for s in b.rows("ingestion_steps")}
    b.messages = b.rows("outbox")
    return b


def of(world, table, run):
    return [r for r in world.rows(table) if r["run_id"] == run]


def outbox(world, run):
    return [json.loads(m["payload"]) for m in world.messages if m["run_id"] == run]


def test_configured_files_reach_curated(world):
    first = min(of(world, "curated", "orders-2027-11-08"), key=lambda r: r["row_number"])
    assert {k: first[k] for k in ("transaction_id", "customer_id", "amount", "transaction_date", "domain", "product", "business_date", "enriched_at")} == {
        "transaction_id": "7301",
        "customer_id": "ana",
        "amount": "48.25",
        "transaction_date": "2027-11-08",
        "domain": "transaction",
        "product": "orders",
        "business_date": "2027-11-08",
        "enriched_at": "2027-11-09T08:00:00+00:00",
    }
    for name in ("orders-2027-11-08", "payments-2027-11-08"):
        run = world.runs[name]
        assert (run["status"], run["total_records"], run["processed_records"]) == ("SUCCEEDED", 2, 2)
        assert len(of(world, "raw", name)) == 3 and len(of(world, "processed", name)) == 2  # raw keeps the header line
        assert [(name, i) in world.steps for i in (1, 2, 3, 4)] == [True] * 4
    assert world.steps["orders-2027-11-08", 2]["file_size_bytes"] == len(ORDERS_CSV.encode())
    assert world.runs["orders-2027-11-08"]["curated_path"] == (
        "s3://data-lake/curated/orders/year=2027/month=11/day=08/orders-2027-11-08/orders-2027-11-08.parquet"
    )


def test_each_record_goes_to_each_destination(world):
    for name in ("orders-2027-11-08", "payments-2027-11-08"):
        sent = outbox(world, name)
        assert sorted(m["destination"] for m in sent) == ["analytics-events"] * 2 + ["billing-events"] * 2
        assert {m["record"]["domain"] for m in sent} == {"transaction"}
        assert sent[0]["source"]["key"].startswith("curated/" + name.split("-")[0])


def test_unconfigured_product_fails_validation_without_a_message(world):
    run = world.runs["invoices-2027-11-08"]
    assert (run["status"], run["failure_step"], run["domain"]) == ("FAILED", "ValidateEvent", "unknown")
    assert run["error_message"] == "product not configured: invoices"
    assert world.steps["invoices-2027-11-08", 1]["status"] == "SUCCEEDED" and ("invoices-2027-11-08", 2) not in world.steps
    assert outbox(world, "invoices-2027-11-08") == []
    assert "between 0 and 100" in world.runs["wrong-2027-11-08"]["error_message"]
    assert outbox(world, "wrong-2027-11-08") == []


def test_reject_under_threshold(world):
    name = "lenient-2027-11-08"
    assert [r["transaction_id"] for r in of(world, "curated", name)] == ["7301"]
    (bad,) = of(world, "rejected", name)
    assert (bad["stage"], bad["row_number"], bad["reason"]) == ("harmonization", 2, "missing domain fields: amount")
    assert json.loads(bad["raw_row"]) == {
        "pedido_id": "7302", "cliente_id": "C1", "valor_total": "", "data_pedido": "2027-11-08"
    }
    run = world.runs[name]
    assert (run["status"], run["processed_records"], run["rejected_records"]) == ("SUCCEEDED", 1, 1)
    step = world.steps[name, 3]
    assert (step["rule_result"], step["threshold_value"], step["measured_value"]) == ("FAILED", "50.0", "50.0")
    quality = [m for m in outbox(world, name) if m["destination"] == "data-quality-events"]
    assert [m["event_type"] for m in quality] == ["ingestion.records-rejected"]
    assert quality[0]["rejected_record"]["raw_row"]["valor_total"] == ""


def test_reject_over_threshold_stops_the_run(world):
    name = "strict-2027-11-08"
    assert of(world, "processed", name) == of(world, "curated", name) == of(world, "manifests", name) == []
    assert len(of(world, "rejected", name)) == 1
    run = world.runs[name]
    assert (run["status"], run["failure_step"]) == ("FAILED", "HarmonizationGlue")
    assert run["error_message"].startswith(
        "rejected rows exceeded threshold: 1/2 rows; limits 1.0% or 0 rows; rejected=s3://data-lake/rejected/harmonization/"
    )
    step = world.steps[name, 3]  # one failed row with true counts and the rejection block
    assert (step["status"], step["input_records"], step["rejected_records"]) == ("FAILED", 2, 1)
    assert (step["rejection_percent"], step["error_code"]) == (50.0, "harmonization_failed")
    failed = [m for m in outbox(world, name) if m["event_type"] == "ingestion.file-failed"]
    assert [m["rows"] for m in failed] == [{"rejected": 1, "total": 2}]


@pytest.mark.parametrize("name, stopped", [("lenient-2027-11-09", False), ("strict-2027-11-09", True)])
def test_enrichment_lookup(world, name, stopped):
    assert [r["customer_id"] for r in of(world, "curated", name)] == ([] if stopped else ["C1"])
    (bad,) = of(world, "rejected", name)
    assert (bad["stage"], bad["row_number"], bad["reason"]) == ("enrichment", 2, "customer not found in enrichment base")
    step = world.steps[name, 4]
    assert (step["status"], step["rejection_category"]) == ("FAILED" if stopped else "SUCCEEDED", "enrichment_lookup")
    run = world.runs[name]
    assert run["processed_records"] == 2 and run["failure_step"] == ("EnrichmentBatch" if stopped else "")
    assert run["curated_path"] == "" or not stopped


def test_enrichment_numbers_count_processed_records(world):
    got = {(r["stage"], r["row_number"]) for r in of(world, "rejected", "any-2027-11-08")}
    assert got == {("harmonization", 2), ("harmonization", 4), ("enrichment", 2), ("enrichment", 4)}
    paths = world.runs["any-2027-11-08"]["rejected_path"].split(", ")
    assert ["/harmonization/" in paths[0], "/enrichment/" in paths[1]] == [True, True]


def test_short_long_and_space_cells(world):
    got = sorted((r["transaction_id"], r["amount"], r["transaction_date"]) for r in of(world, "curated", "any-2027-11-09"))
    assert got == [("1", "5", "d"), ("3", "0", " ")]
    (bad,) = of(world, "rejected", "any-2027-11-09")
    assert bad["reason"] == "missing domain fields: amount, transaction_date"
    assert bad["raw_row"] == '{"cliente_id":"C1","data_pedido":null,"pedido_id":"2","valor_total":null}'


def test_schema_drift_fails_once_with_both_blocks(world):
    name = "strict-2026-05-03"
    step = world.steps[name, 3]
    assert step["error_code"] == "harmonization_schema_failed" and step["validation_result"] == "FAILED"
    assert step["missing_columns"] == "cliente_id, data_pedido"
    assert step["error_message"] == "file missing source columns: cliente_id, data_pedido"
    (failure,) = of(world, "rejected", name)
    assert (failure["stage"], failure["reason"]) == ("file-failed", step["error_message"])
    # the failure record is announced once, not a second time as a rejected record
    (message,) = outbox(world, name)
    assert message["event_type"] == "ingestion.file-failed" and message["rows"] == {}
    assert message["source"]["key"].startswith("rejected/file-failed/strict/")


@pytest.mark.parametrize("name", ["strict-2026-05-04", "strict-2026-05-05"])
def test_file_without_records_misses_every_column(world, name):
    run = world.runs[name]
    assert run["error_message"] == "file missing source columns: pedido_id, cliente_id, valor_total, data_pedido"
    assert world.steps[name, 2]["status"] == "SUCCEEDED"


def test_missing_source_file_fails_landing(world):
    run = world.runs["absent"]
    assert run["failure_step"] == "LandingGlue"
    assert run["error_message"] == "s3 object not found: s3://product-lake/orders/orders-2026-05-09.csv"
    assert world.steps["absent", 2]["error_code"] == "landing_failed"
    assert [m["event_type"] for m in outbox(world, "absent")] == ["ingestion.file-failed"]


def test_invalid_and_missing_mapping(world):
    error = world.runs["partial-2027-11-08"]["error_message"]
    assert error == "mapping for partial missing domain fields: customer_id, amount, transaction_date"
    assert world.runs["lost-2027-11-08"]["error_message"] == "s3 object not found: s3://data-lake/de-para/nowhere.json"
    assert world.runs["lost-2027-11-08"]["failure_step"] == "HarmonizationGlue"


def test_last_source_column_wins_for_a_domain_field(world):
    assert [r["amount"] for r in of(world, "curated", "twice-2027-11-08")] == ["2"]


def test_source_key_override_and_part_folder(world):
    got = sorted((r["row_number"], r["transaction_id"]) for r in of(world, "curated", "parts"))
    assert got == [(1, "7301"), (2, "7302"), (3, "8801"), (4, "8802")]
    assert world.runs["parts"]["source_key"] == "drop/batch"


def test_malformed_events_are_quarantined(world):
    assert {r["reason"] for r in world.rows("quarantine")} == {
        "message is not EventBridge file-ready event",
        "business_date must use YYYY-MM-DD",
    }
    assert len(world.runs) == 18


def test_evidence(world):
    got = {r.run_id: (r.status, r.steps) for r in facts.evidence(world.batch.states).collect()}
    assert got["invoices-2027-11-08"] == ("FAIL", "InitExecution:OK, ValidateEvent:FAIL")
    assert got["absent"] == ("FAIL", "InitExecution:OK, ProductConfig:OK, LandingGlue:FAIL")
    assert got["orders-2027-11-08"][1].endswith("S3Notification:OK, Manifest:OK, FinalizeExecution:OK")


def test_replay_redelivery_and_fan_out(bench):
    bench.config(orders=product(50, 10))
    bench.put("orders", "orders-2027-11-08.csv", BLANK_AMOUNT)
    both = (event(run_id="r1"), event(run_id="r2"))
    bench.ingest(*both, event(run_id="r1"), batch=BatchKey("nightly", 7))
    first = {t: bench.rows(t) for t in TABLES}
    # a replayed batch replaces what it wrote
    bench.ingest(*both, batch=BatchKey("nightly", 7))
    assert {t: bench.rows(t) for t in TABLES} == first
    # two runs of one day repeat rows in the views that join by day, not in the exact ones
    curated, runs = bench.lake.read("curated"), bench.lake.read("ingestion_runs")
    assert curated.count() == 2
    assert views.curated_with_run_context(curated, runs).count() == 4
    assert views.ingested_with_source(curated, runs).count() == 4
    assert views.curated_with_run_context_exact(curated, runs).count() == 2
    assert [r.curated_records for r in reports.curated_with_run_context(curated, runs).collect()] == [4]
    # a later delivery of a run replaces its rows, and its facts count from then on
    bench.put("orders", "orders-2027-11-08.csv", BLANK_AMOUNT + "7303,C3,5.00,2027-11-08\n")
    later = {"batch": BatchKey("nightly", 8), "clock": "2027-11-10T08:00:00+00:00", "finished": F.lit("2027-11-10T08:01:30+00:00")}
    bench.ingest(both[0], **later)
    assert bench.lake.history("ingestion_runs").count() == 3
    latest = {r.execution_id: r for r in bench.lake.read("ingestion_runs").collect()}
    assert {k: r.total_records for k, r in latest.items()} == {"r1": 3, "r2": 2}
    assert latest["r1"].duration_seconds == 90
    assert bench.lake.read("ingestion_steps").count() == 8
    assert len(bench.rows("curated")) == 3


def test_user_hook_rejects_rows(bench):
    bench.config(orders=product(100, 100))
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    low = F.when(F.col("amount").cast("double") < 20, F.lit("amount too low"))
    bench.ingest(event(run_id="r1"), hook=lambda df: df.withColumn("reject_reason", low))
    assert [r["reason"] for r in bench.rows("rejected")] == ["amount too low"]
    step = next(s for s in bench.rows("ingestion_steps") if s["step_order"] == 4)
    assert step["rejection_reason"] == "amount too low"


def test_empty_lake_and_batch_of_missing_files(bench):
    for build, inputs in {**views.VIEWS, **reports.REPORTS}.values():
        assert build(*[bench.lake.read(t) for t in inputs]).isEmpty()
    bench.put("payments", "other.csv", PAYMENTS_CSV)
    bench.ingest(event(run_id="r1"))
    assert [r["failure_step"] for r in bench.rows("ingestion_runs")] == ["LandingGlue"]
