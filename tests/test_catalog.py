"""Registered tables follow the lake: latest facts, partitions by batch, names that stand for one lake."""

import pytest
from pyspark.sql import functions as F

from sluice.plans.views import VIEWS
from sluice.sources.catalog import ANALYTICS_DB, BUSINESS_DB, Catalog
from sluice.sources.ledger import BatchKey
from tests.conftest import ORDERS_CSV, PAYMENTS_CSV, Bench, event


@pytest.fixture
def catalog(bench):
    """A catalog with names of its own."""
    name = f"t{abs(hash(str(bench.root)))}"
    yield Catalog(bench.lake, f"{name}_analytics", f"{name}_business")
    for db in (f"{name}_analytics", f"{name}_business"):
        bench.spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def counts(catalog):
    return {r.table_name: r.row_count for r in catalog.describe().collect()}


def partitions(catalog, table):
    return {r.partition for r in catalog.spark.sql(f"SHOW PARTITIONS {catalog.tables()[table]}").collect()}


def test_catalog_follows_the_lake(bench, tmp_path_factory):
    """Two lakes registered one after the other under the same names, each twice."""
    spark = bench.spark
    other = Bench(spark, tmp_path_factory.mktemp("other"))
    for at, runs in ((bench, ("r1",)), (other, ("r1", "r2", "r3")), (bench, ("r1",))):
        at.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
        at.ingest(*[event(run_id=r) for r in runs])
        for _ in range(2):
            Catalog(at.lake).register(replace=True)
            rows = {r.table_name: r for r in Catalog(at.lake).describe().collect()}
        assert len(rows) == 6 and rows["business_curated"].row_count == 2 * len(runs)
        assert rows["analytics_ingestion_runs"].row_count == len(runs)
    with pytest.raises(ValueError, match="other names"):
        Catalog(other.lake).register()
    assert (rows["analytics_ingestion_runs"].column_count, rows["analytics_ingestion_steps"].column_count) == (24, 64)
    assert spark.catalog.databaseExists(ANALYTICS_DB) and spark.catalog.databaseExists(BUSINESS_DB)
    Catalog(bench.lake).register_views()
    totals = spark.sql("SELECT sum(total_runs) AS n FROM vw_ingestion_status_by_day").first()
    assert totals.n == 1


def test_sql_shows_the_last_delivery(bench, catalog):
    """A run delivered three times counts once, with its last numbers, in SQL as through the lake."""
    for i, extra in enumerate(("", "7303,eva,5.00,2027-11-08\n", "7303,eva,,2027-11-08\n")):
        bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV + extra)
        batch = bench.ingest(event(run_id="r1"), event("payments", run_id=f"p{i}", file_name="none.csv"), batch=BatchKey("n", i))
        catalog.add_runs(batch.states)
        runs = bench.spark.table(catalog.tables()["ingestion_runs"])
        seen = {r.execution_id: (r.status, r.total_records) for r in runs.collect()}
        assert seen == {r["execution_id"]: (r["status"], r["total_records"]) for r in bench.rows("ingestion_runs")}
        assert seen["r1"][1] == 2 + bool(extra) and len(seen) == 2 + i
    names = catalog.tables()
    for view in ("vw_ingestion_status_by_day", "vw_ingestion_steps_summary", "vw_quality_results", "vw_file_lineage"):
        build, inputs = VIEWS[view]
        got = build(*[bench.spark.table(names[t]) for t in inputs])
        want = build(*[bench.lake.read(t) for t in inputs])
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), view
    catalog.vacuum()
    assert len(list((bench.root / "lake" / "current" / "ingestion_runs").glob("version-*"))) == 1
    assert bench.spark.table(names["ingestion_runs"]).count() == 4


def test_facts_of_open_batches_stay_out(bench, catalog):
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV)
    batch = bench.ingest(event(run_id="r1"))
    wrong = bench.lake.ledger.open(BatchKey("crashed", 0)).batch_id
    bench.lake.write("ingestion_runs", bench.lake.read("ingestion_runs").withColumns({"status": F.lit("wrong"), "batch_id": F.lit(wrong)}))
    catalog.add_runs(batch.states)
    assert [r.status for r in bench.spark.table(catalog.tables()["ingestion_runs"]).collect()] == ["SUCCEEDED"]


def test_a_batch_adds_its_own_partitions_only(bench, catalog):
    bench.put("orders", "orders-2027-11-08.csv", ORDERS_CSV + "7303,eva,,2027-11-08\n")
    bench.put("payments", "payments-2027-11-09.csv", PAYMENTS_CSV)
    first = bench.ingest(event(run_id="r'1 %:=\\"))
    second = bench.ingest(event("payments", "2027-11-09", run_id="r2"), event(run_id="late", file_name="none.csv"))
    catalog.add_runs(second.states)
    got = counts(catalog)
    # facts are merged by day, so the first batch's facts of the same day are there; its zone folders are not
    assert got["analytics_ingestion_runs"] == 3
    assert {k: n for k, n in got.items() if k.startswith("business")} == {
        "business_raw": 3, "business_processed": 2, "business_curated": 2, "business_rejected": 1,
    }
    assert all("r2" in p or "late" in p for t in ("raw", "processed", "curated", "rejected") for p in partitions(catalog, t))
    catalog.add_runs(first.states)
    catalog.add_runs(first.states)  # again changes nothing
    everything = counts(catalog)
    assert everything["business_raw"] == bench.lake.read("raw").count()
    assert everything["analytics_ingestion_runs"] == 3
    before = {t: partitions(catalog, t) for t in ("raw", "processed", "curated", "rejected")}
    catalog.register()
    assert {t: partitions(catalog, t) for t in before} == before and counts(catalog) == everything


def test_tables_that_own_their_data_stay(bench, catalog):
    bench.spark.sql(f"CREATE DATABASE {catalog.analytics}")
    name = catalog.tables()["ingestion_runs"]
    bench.spark.sql(f"CREATE TABLE {name} (a int) USING parquet")
    with pytest.raises(ValueError, match="data of its own"):
        catalog.create(replace=True)
    bench.spark.sql(f"DROP TABLE {name}")
