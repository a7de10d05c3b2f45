import csv
import hashlib
import io
import json
import re

from pyspark.sql import functions as F

from sluice import functions as S


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column).first()[0]


def test_business_dates(spark):
    day = S.business_day(F.col("d"))
    cases = {"2027-11-08": "20271108", "2026-5-1": "20260501", "01-05-2026": None, "2026-02-30": None, "": None, "x": None}
    for text, want in cases.items():
        assert one(spark, S.anomesdia(day), d=text) == want, text
    assert one(spark, S.partition_prefix(day), d="2027-11-08") == "year=2027/month=11/day=08"


def test_clock_text_has_explicit_utc_offset(spark):
    assert one(spark, S.clock_text(F.to_timestamp(F.lit("2027-11-08 10:11:12")))) == "2027-11-08T10:11:12+00:00"


def test_sanitize_fragment(spark):
    for text, want in {"two  words?": "two-words", "-=x=--": "=x=", "": "item", "?/": "item", "a.b=c_d-e": "a.b=c_d-e"}.items():
        assert one(spark, S.sanitize_fragment(F.col("t")), t=text) == want


def test_keys_by_position(spark):
    curated = "curated/orders/year=2027/month=11/day=08/run-1/orders.parquet"
    rejected = "rejected/harmonization/orders/year=2027/month=11/day=08/run-2/orders.jsonl"
    for key, name, run in (
        (curated, "orders", "run-1"),
        (rejected, "orders", "run-2"),
        ("curated/orders", "orders", "unknown"),
        ("rejected/enrichment", None, "unknown"),
        ("other/orders/x", None, "unknown"),
    ):
        assert one(spark, S.product_from_key(F.col("k")), k=key) == name
        assert one(spark, S.run_id_from_key(F.col("k")), k=key) == run


def test_stem_drops_only_the_last_suffix(spark):
    for name, want in {"a.csv": "a", "a.tar.gz": "a.tar", ".hidden": ".hidden", "plain": "plain", "d/e.csv": "e"}.items():
        assert one(spark, S.stem(F.col("n")), n=name) == want


def test_curated_key_swaps_only_the_leading_zone(spark):
    key = "processed/processed/year=2027/month=11/day=08/r/f.parquet"
    assert one(spark, S.curated_key(F.col("k")), k=key) == "curated/processed/year=2027/month=11/day=08/r/f.parquet"


def test_run_id_matches_sorted_json_digest(spark):
    event = {"product": 'or"d', "file_name": "a\\b.csv", "business_date": "2027-11-08"}
    clock = F.to_timestamp(F.lit("2027-11-08 10:11:12"))
    got = one(spark, S.run_id_for([(k, F.col(k)) for k in event], clock), **event)
    assert re.fullmatch(r"\d{14}-[a-f0-9]{8}", got)
    assert got == "20271108101112-" + hashlib.sha1(json.dumps(event, sort_keys=True).encode()).hexdigest()[:8]


def test_blank_keeps_spaces_and_zero(spark):
    for text, want in {"": True, " ": False, "0": False}.items():
        assert one(spark, S.blank(F.col("t")), t=text) is want
    assert one(spark, S.blank(F.lit(None).cast("string"))) is True


def test_json_line_bytes_counts_escapes(spark):
    for record in ({"a": "x", "b": ""}, {"a": 'q"u\\o', "b": "é"}, {"a": "l\n\t\r\b\f\x01\x7f", "b": "\U0001f600 日"}):
        got = one(spark, S.json_line_bytes({k: F.col(k) for k in record}), **record)
        assert got == len((json.dumps(record) + "\n").encode())


def test_run_ids_of_events_beyond_ascii(spark):
    event = {"product": "café\n", "file_name": "日\U0001f600\x1f.csv", "business_date": "2027-11-08"}
    clock = F.to_timestamp(F.lit("2027-11-08 10:11:12"))
    got = one(spark, S.run_id_for([(k, F.col(k)) for k in event], clock), **event)
    assert got.endswith(hashlib.sha1(json.dumps(event, sort_keys=True).encode()).hexdigest()[:8])


def test_double_text_has_plain_small_numbers(spark):
    for x in (3.0, 0.001, 0.0005, 0.000125, -0.0005, 5e-05, 1.234e-07, 99.5, 0.0):
        assert one(spark, S.double_text(F.col("x")), x=x) == repr(x)


def test_sorted_json_keeps_nulls(spark):
    assert one(spark, S.sorted_json(b=F.lit(None), a=F.lit("x"))) == '{"a":"x","b":null}'


def test_csv_lines_keep_every_cell(spark):
    for cells in (["1", None, "x,y"], ['a"b', "", "l\nm"], ["plain"], [None]):
        line = spark.createDataFrame([(cells,)], "cells array<string>").select(S.csv_line("cells")).first()[0]
        assert next(csv.reader(io.StringIO(line, newline="")), [""]) == [c or "" for c in cells]
