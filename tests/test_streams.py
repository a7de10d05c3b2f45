"""Both loops as streams: restart, bad messages and idempotent publication."""

import json
import os

from pyspark.sql import functions as F

from sluice.plans.ingest import FileSource
from sluice.session import shared_root
from sluice.streaming import ingestion_stream, publication_streams
from tests.conftest import CLOCK, ORDERS_CSV, PAYMENTS_CSV, event


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def test_loops_restart(bench):
    spark = bench.spark
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    bench.put("payments", "payments-2027-11-08.csv", PAYMENTS_CSV)

    def ingestion():
        source = FileSource(str(bench.source))
        checkpoint = str(bench.root / "ck-in")
        return ingestion_stream(
            bench.lake, str(bench.events_dir), bench.configs(), bench.mappings(), source, checkpoint, F.lit(CLOCK)
        )

    def publication():
        return [drain(w) for w in publication_streams(bench.lake, bench.configs(), str(bench.root / "ck-out"))]

    def tell(name, *bodies):
        (bench.events_dir / name).write_text("\n".join(b if isinstance(b, str) else json.dumps(b) for b in bodies))

    os.makedirs(shared_root(spark), exist_ok=True)
    staged = set(os.listdir(shared_root(spark)))
    tell("1.json", {"detail": event(run_id="r1")}, "garbage")
    assert drain(ingestion()) == 2
    assert len(bench.rows("curated")) == 2 and len(bench.rows("quarantine")) == 1
    assert drain(ingestion()) == 0  # restart: nothing new
    bench.rows("rejected")
    assert bench.lake.read("rejected").isEmpty()

    ours = {"source": "local.product-lake", "detail-type": "file-ready", "detail": event("payments", run_id="r2")}
    elsewhere = [{**ours, "source": "other", "detail": event(run_id="r9")}, {**ours, "detail-type": "x", "detail": event(run_id="r8")}]
    tell("2.json", ours, event("invoices", run_id="r3"), *elsewhere)
    drain(ingestion())
    assert {r["execution_id"]: r["status"] for r in bench.rows("ingestion_runs")} == {
        "r1": "SUCCEEDED",
        "r2": "SUCCEEDED",
        "r3": "FAILED",
    }
    assert publication() == [4, 0]
    assert publication() == [0, 0]
    assert set(os.listdir(shared_root(spark))) == staged  # a batch leaves no staged table behind
    by_destination = bench.lake.read("outbox").groupBy("destination").count().collect()
    assert {r["destination"]: r["count"] for r in by_destination} == {"billing-events": 4, "analytics-events": 4}
