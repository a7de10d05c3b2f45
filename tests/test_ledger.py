"""The batch ledger: no row lost when numbers repeat, replays recognised, half-written batches unseen."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sluice.plans.ingest import FileSource, publish_zones
from sluice.sources.ledger import BatchKey
from sluice.sources.zones import TABLES
from sluice.streaming import ingestion_stream, publication_streams
from tests.conftest import CLOCK, ORDERS_CSV, PAYMENTS_CSV, event
from tests.test_streams import drain


def fill(bench):
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    bench.put("payments", "payments-2027-11-08.csv", PAYMENTS_CSV)


def statuses(bench):
    return {r["execution_id"]: r["status"] for r in bench.rows("ingestion_runs")}


def test_two_calls_of_one_day_keep_both_runs(bench):
    fill(bench)
    bench.ingest(event(run_id="r1"), "garbage 1")
    bench.ingest(event("payments", run_id="r2"), event("payments", run_id="late", file_name="none.csv"), "garbage 2")
    assert statuses(bench) == {"r1": "SUCCEEDED", "r2": "SUCCEEDED", "late": "FAILED"}
    assert {r["execution_id"] for r in bench.rows("ingestion_steps")} == {"r1", "r2", "late"}
    assert {r["value"] for r in bench.rows("quarantine")} == {"garbage 1", "garbage 2"}
    bench.ingest(event(run_id="late2", file_name="none.csv"))
    assert [r["run_id"] for r in bench.rows("outbox", "run_id", "event_type", "destination")] == ["late", "late2"]
    assert [r.state for r in bench.lake.ledger.entries().orderBy("sequence").collect()] == ["committed"] * 3


def test_equal_numbers_of_two_origins_do_not_meet(bench):
    fill(bench)
    bench.ingest(event(run_id="r1"), "garbage 1", batch=BatchKey("one", 0))
    bench.ingest(event("payments", run_id="r2"), "garbage 2", batch=BatchKey("two/../one", 0))
    before = {t: bench.rows(t) for t in TABLES}
    # a replay is recognised whatever it holds now
    assert bench.ingest(event(run_id="r3"), batch=BatchKey("one", 0)).states is None
    assert {t: bench.rows(t) for t in TABLES} == before
    assert statuses(bench) == {"r1": "SUCCEEDED", "r2": "SUCCEEDED"} and len(before["quarantine"]) == 2


def test_a_late_replay_does_not_undo_a_redelivery(bench):
    fill(bench)
    bench.ingest(event(run_id="r1"), batch=BatchKey("one", 0))
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV + "7303,eva,5.00,2027-11-08\n")
    bench.ingest(event(run_id="r1"), batch=BatchKey("one", 1))
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    bench.ingest(event(run_id="r1"), batch=BatchKey("one", 0))
    assert len(bench.rows("curated")) == 3
    assert [r["total_records"] for r in bench.rows("ingestion_runs")] == [3]


def test_a_failed_batch_is_unseen_and_its_next_attempt_starts_clean(bench):
    fill(bench)
    key = BatchKey("jobs", 7)
    boom = RuntimeError("executor lost")

    def hook(df):
        raise boom

    with pytest.raises(RuntimeError):
        bench.ingest(event(run_id="r1"), "garbage", batch=key, hook=hook)
    assert bench.lake.history("quarantine").count() == 1 and bench.rows("quarantine") == []
    # it comes again without the unusable message: what the failed attempt wrote must go
    bench.ingest(event(run_id="r1"), batch=key)
    assert bench.lake.history("quarantine").count() == 0 and statuses(bench) == {"r1": "SUCCEEDED"}
    entries = bench.lake.ledger.entries().collect()
    assert [(r.origin, r.number, r.state) for r in entries] == [("jobs", 7, "committed")]


def test_abandoned_batches_leave_nothing(bench):
    fill(bench)

    def hook(df):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        bench.ingest("garbage", event(run_id="r1"), batch=BatchKey("jobs", 1), hook=hook)
    bench.lake.abandon(BatchKey("jobs", 1))
    assert bench.lake.history("quarantine").count() == 0 and bench.lake.ledger.open_ids() == []
    bench.ingest(event(run_id="r1"), batch=BatchKey("jobs", 2))
    with pytest.raises(ValueError):
        bench.lake.abandon(BatchKey("jobs", 2))
    assert [r.state for r in bench.lake.ledger.entries().orderBy("sequence").collect()] == ["abandoned", "committed"]


def test_sequences_are_unique_and_keep_their_key(bench):
    keys = [BatchKey(f"o{i % 3}", i // 3) for i in range(24)]
    ledger = bench.lake.ledger
    with ThreadPoolExecutor(6) as pool:
        opened = list(pool.map(ledger.open, keys))
    assert len({e.sequence for e in opened}) == 24
    assert [ledger.open(k).sequence for k in keys] == [e.sequence for e in opened]
    # the hint may be lost or stale
    ledger._create(ledger._path("last.json"), {"sequence": 3}, replace=True)
    assert ledger.open(BatchKey("new", 0)).sequence == 24
    ledger._fs.delete(ledger._path("last.json"), False)
    assert ledger.open(BatchKey("new", 1)).sequence == 25
    assert ledger.open(BatchKey("", 0)).sequence == 26


def test_streams_with_new_checkpoints_lose_nothing(bench):
    fill(bench)

    def tell(name, *bodies):
        (bench.events_dir / name).write_text("\n".join(b if isinstance(b, str) else json.dumps(b) for b in bodies))

    def both(generation):
        source = FileSource(str(bench.source))
        at = bench.root / f"ck-{generation}"
        drain(ingestion_stream(bench.lake, str(bench.events_dir), bench.configs(), bench.mappings(), source, str(at / "in"), F.lit(CLOCK)))
        return [drain(w) for w in publication_streams(bench.lake, bench.configs(), str(at / "out"))]

    tell("1.json", event(run_id="r1"), "garbage 1")
    assert both(1) == [2, 0]
    (bench.events_dir / "1.json").unlink()
    tell("2.json", event("payments", run_id="r2"), "garbage 2")
    both(2)  # its batches are numbered from 0 again
    assert statuses(bench) == {"r1": "SUCCEEDED", "r2": "SUCCEEDED"}
    assert len(bench.rows("quarantine")) == 2
    sent = {(r["run_id"], r["record_key"], r["destination"]) for r in bench.rows("outbox")}
    assert len(sent) == 8 and {s[0] for s in sent} == {"r1", "r2"}
    assert {r.origin.split("-")[0] for r in bench.lake.ledger.entries().collect()} == {"events", "curated"}


def test_publication_is_sent_once_per_batch(bench):
    fill(bench)
    bench.ingest(event(run_id="r1"))
    for _ in range(2):
        publish_zones(bench.lake, bench.configs(), bench.lake.read("curated"), bench.lake.read("rejected"), BatchKey("p", 0))
    assert len(bench.rows("outbox")) == 4
