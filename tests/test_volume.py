"""What a task holds, shuffles and writes stays in bounds as tables grow: plans and written columns that decide it."""

import os

import __spark_entry__ as entry
from pyspark.sql import functions as F

from sluice.contracts import PROCESSED_ZONE
from sluice.operators import ordinals
from sluice.session import configure
from sluice.sources import files
from sluice.sources.zones import Lake


def test_a_zone_write_does_not_sort_what_a_task_holds(spark, tmp_path):
    configure(spark)
    spark.sql(f"CREATE TABLE by_run (x BIGINT, run_id STRING) USING parquet PARTITIONED BY (run_id) LOCATION '{tmp_path}/by_run'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO by_run SELECT id, cast(id % 7 AS string) FROM range(100)").first()[0]
    finally:
        spark.sql("DROP TABLE by_run")
    assert "WriteFiles" in plan and "Sort" not in plan


def test_a_task_with_more_runs_than_open_files(spark, tmp_path):
    """Beyond the open files the rest is sorted; every row is written once, and partitions are replaced."""
    lake = Lake(configure(spark), str(tmp_path))
    rows = spark.range(0, 6000, 1, 1).select(
        F.concat(F.lit("r-"), F.col("id") % 150).alias("run_id"), F.lit("orders").alias("product"), F.lit("2026").alias("year"),
        F.lit("05").alias("month"), F.lit("01").alias("day"), F.col("id").alias("row_number"),
    )
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in PROCESSED_ZONE.fields if f.name not in rows.columns])
    for _ in range(2):
        lake.write("processed", rows)
    got = lake.read("processed")
    assert sorted((r.run_id, r.row_number) for r in got.collect()) == sorted((f"r-{i % 150}", i) for i in range(6000))
    assert len(got.inputFiles()) == 150


def test_numbering_writes_no_order_columns_unless_asked(spark):
    rows = spark.createDataFrame([("g", k, 9 - k) for k in (3, 1, 2)], "g string, k bigint, v bigint")
    bare = ordinals.number_by_key(rows, ["g"], ["k"], keep_order=False)
    assert sorted((r.v, r.row_number) for r in bare.collect()) == [(6, 3), (7, 2), (8, 1)]
    assert bare.columns == ["g", "v", "row_number"]
    staged = {os.path.dirname(f) for f in bare.inputFiles()}
    assert all("k" not in spark.read.parquet(folder).columns for folder in staged)


def test_headers_are_found_without_shuffling_the_lines(spark, monkeypatch):
    """However large the product of the tables behind it is estimated, the list of header places is known to be small."""
    planned, staged = {}, files.stage

    def kept(df, label):
        planned[label] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, label)

    monkeypatch.setattr(files, "stage", kept)
    line = F.when(F.col("id") == 0, "a,b").otherwise(F.sha2(F.col("id").cast("string"), 256))
    lines = spark.range(0, 5000, 1, 1).select(
        F.lit("r").alias("run_id"), F.lit("f").alias("file_path"), F.lit(0).alias("block_start"), F.col("id").alias("pos"), line.alias("line")
    )
    lines = staged(lines, "lines")
    listed = spark.createDataFrame([("r", "f", 8)], "run_id string, file_path string, file_size bigint")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        landed = files.parse_landed(lines, listed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert landed.headers.first().header == ["a", "b"]
    assert landed.totals.first().total == landed.rows.count() == 4999
    assert "SortMergeJoin" not in planned["headers"]


def test_curated_records_are_parsed_once_for_lookup_gate_and_result(spark):
    plan = entry.queries()["file_curated"](spark, entry.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "from_csv" not in plan
