"""Re-delivered runs, run ids that need escaping, verdicts decided once, row numbers beyond 32 bits."""

from pyspark.sql import functions as F

from sluice.contracts import REJECTED_ZONE
from sluice.plans.views import VIEWS
from sluice.sources.ledger import BatchKey
from tests.conftest import ORDERS_CSV, event, product

HEADER = ORDERS_CSV.split("\n")[0] + "\n"


def test_odd_run_ids_ingest_beside_a_plain_one(bench):
    ids = ["plain", "r:1", "r%2F1", "a/b", "two words", "çé日", "x=y", "{z}*?[1]"]
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    bench.ingest(*[event(run_id=i) for i in ids])
    assert {r["execution_id"]: r["status"] for r in bench.rows("ingestion_runs")} == dict.fromkeys(ids, "SUCCEEDED")
    counts = {r["run_id"]: r["count"] for r in bench.lake.read("curated").groupBy("run_id").count().collect()}
    assert counts == dict.fromkeys(ids, 2)


def test_last_batch_wins_at_one_clock(bench):
    for batch, text in ((9, ORDERS_CSV), (10, ORDERS_CSV), (11, HEADER + "1,,2,\n"), (10, ORDERS_CSV)):
        bench.put("orders", "orders-2027-11-08.csv", text)
        bench.ingest(event(run_id="r1"), batch=BatchKey("events", batch))
    assert bench.lake.history("ingestion_runs").count() == 3
    assert [(r["status"], r["batch_id"]) for r in bench.rows("ingestion_runs")] == [("FAILED", "2")]
    by_day = VIEWS["vw_ingestion_status_by_day"][0](bench.lake.read("ingestion_runs")).collect()
    assert [(r.status, r.total_runs) for r in by_day] == [("FAILED", 1)]


def test_a_random_rule_decides_each_record_once(bench):
    rows = "".join(f"{i},ana,{i}.5,2027-11-08\n" for i in range(400))
    bench.config(orders={**product(), "rejection_policy": {"max_error_percent": 100, "max_error_count": 1000, "destinations": ["q"]}})
    bench.put("orders", "orders-2027-11-08.csv", HEADER + rows)
    bench.ingest(event(run_id="r1"), hook=lambda df: df.withColumn("reject_reason", F.when(F.rand() < 0.5, F.lit("unlucky"))))
    good = [r["transaction_id"] for r in bench.rows("curated")]
    bad = bench.lake.read("rejected").filter("stage = 'enrichment'").select(F.get_json_object("raw_row", "$.transaction_id").alias("i"))
    bad = [r.i for r in bad.collect()]
    assert sorted(good + bad, key=int) == [str(i) for i in range(400)] and good and bad


def test_row_numbers_beyond_32_bits(bench):
    row = {"row_number": F.lit(3_000_000_000), "run_id": F.lit("r"), "stage": F.lit("harmonization"), "product": F.lit("orders")}
    row |= {"year": F.lit("2027"), "month": F.lit("11"), "day": F.lit("08")}
    row |= {f.name: F.lit(None).cast(f.dataType) for f in REJECTED_ZONE.fields if f.name not in row}
    bench.lake.write("rejected", bench.spark.range(1).select(*[c.alias(n) for n, c in row.items()]))
    assert [r["row_number"] for r in bench.rows("rejected")] == [3_000_000_000]
