"""Records with quoted line breaks, put together across file splits, against Python's csv module."""

import csv
import io
import random

import pytest

from sluice.sources import files as csv_files
from tests.test_files import land


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "96")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def expected(content):
    rows = [r for r in csv.reader(io.StringIO(content, newline="")) if r]
    return (rows[0], rows[1:]) if rows else ([], [])


def fit(rows, width):
    return [(r + [""] * width)[:width] for r in rows]


def random_file(rnd):
    end = rnd.choice(["\n", "\r\n"])
    letters = ["a", "b", " ", "é", ",", '"', "\n", "\r\n", "\n\n", "x" * 40]

    def cell():
        kind = rnd.random()
        if kind < 0.4:
            return rnd.choice(["", "7", " v ", 'a 5" pipe', 'x"', "\\"])
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(9)))
        return '"' + text.replace('"', '""') + '"'

    header = ",".join(["one", '"two\nlines"', "three"] if rnd.random() < 0.2 else ["one", "two", "three"])
    lines = [header] + [",".join(cell() for _ in range(rnd.choice([3, 3, 3, 2, 5]))) for _ in range(rnd.randrange(12))]
    blank = [line for x in lines for line in ([x, ""] if rnd.random() < 0.2 else [x])]
    text = end.join(blank)
    # some files end without a line break, some inside a quoted cell
    return text + rnd.choice(["", end, end + end, end + '9,"open', end + '9,"open' + end + "to the end" + end])


def test_random_files_across_splits(bench, small_splits):
    rnd = random.Random(11)
    files = {f"f{i:03}.csv": random_file(rnd) for i in range(120)}
    headers, rows = land(bench, files)
    assert bench.lake.read("raw").select("file_path", "block_start").distinct().count() > 250
    for name, content in files.items():
        header, records = expected(content)
        assert headers[name] == header, name
        # a record open at the end of its file may keep or lose the file's last line break
        got, want = fit(rows[name], len(header)), fit(records, len(header))
        if got and got != want:
            got[-1], want[-1] = [[c.rstrip("\r\n") for c in r[-1]] for r in (got, want)]
        assert got == want, (name, content)


def test_one_record_over_many_splits(bench, small_splits):
    long = "\n".join(f'line {i}, "quoted"' for i in range(200)).replace('"', '""')
    text = f'id,text,n\n1,"{long}",2\n3,plain,4\n5,"{long}\r\n\r\n{long}",6\n7,"x",8\n'
    headers, rows = land(bench, {"long.csv": text})
    header, records = expected(text)
    assert headers["long.csv"] == header and rows["long.csv"] == records


def test_an_inch_mark_opens_nothing(bench):
    text = "id,size\n" + "".join(f'{i},{i}" pipe\n' for i in range(50))
    _, rows = land(bench, {"inch.csv": text})
    assert rows["inch.csv"] == [[str(i), f'{i}" pipe'] for i in range(50)]


def test_files_stay_split(bench, small_splits, monkeypatch):
    """A file with one quoted line break is parsed by as many tasks as one without, and read by no other reader."""
    rows = [f"{i},value {i}" for i in range(2000)]
    with_break = [*rows[:1000], '1000,"value\n1000"', *rows[1001:]]
    tasks = {}
    for name, lines in (("plain", rows), ("broken", with_break)):
        path = bench.root / f"{name}.csv"
        path.write_text("id,v\n" + "\n".join(lines) + "\n")
        tasks[name] = csv_files.scan_lines(bench.spark, [str(path)]).rdd.getNumPartitions()
    assert tasks["plain"] == tasks["broken"] > 100
    lines = csv_files.scan_lines(bench.spark, [str(bench.root / "broken.csv")]).selectExpr("'r' AS run_id", "*")
    stitched = csv_files._stitched(lines, lines.select("run_id", "file_path").distinct())
    plan = stitched._jdf.queryExecution().toString()
    assert "FileScan csv" not in plan
    got = {r.number: r.record for r in stitched.collect()}
    assert len(got) == 2001 and got[1002] == '1000,"value\n1000"' and got[2001] == "1999,value 1999"


def test_run_of_plain_and_broken_parts(bench):
    """Part files of one run are numbered one after the other, whichever way each of them is parsed."""
    parts = ["id,v\n1,a\n2,b\n", 'id,v\n3,"c\nd"\n4,e\n', "id,v\n5,f\n", 'id,v\n\n6,g\n']
    for i, text in enumerate(parts):
        bench.put("p", f"batch/part-{i}.csv", text)
    bench.put("p", "batch/_SUCCESS", "")
    from pyspark.sql import functions as F

    from sluice.plans.ingest import FileSource
    from sluice.sources.events import execution_context

    event = [("p", "batch", "2027-11-08", "r1", "p/batch")]
    events = bench.spark.createDataFrame(event, "product string, file_name string, business_date string, run_id string, source_key string")
    landed = FileSource(str(bench.source)).land(bench.lake, execution_context(events, F.to_timestamp(F.lit("2027-11-08 00:00:00"))))
    got = [(r.row_number, r.cells[:2]) for r in landed.rows.orderBy("row_number").collect()]
    assert got == [(1, ["1", "a"]), (2, ["2", "b"]), (3, ["3", "c\nd"]), (4, ["4", "e"]), (5, ["5", "f"]), (6, ["6", "g"])]
    assert [r.total for r in landed.totals.collect()] == [6]


def test_lone_carriage_returns_end_records(bench):
    _, rows = land(bench, {"old.csv": 'a,b\r1,2\r"3\r4",5\r', "mixed.csv": "a,b\n1,2\r3,4\r\n\r\n5,6\n"})
    assert rows == {"old.csv": [["1", "2"], ["3\r4", "5"]], "mixed.csv": [["1", "2"], ["3", "4"], ["5", "6"]]}


def test_only_named_files_are_looked_up(bench):
    """The listing holds the events' objects and the files below them, zero bytes included, and nothing beside them."""
    for i in range(40):
        bench.put("p", f"old-{i}.csv", "a\n1\n")
    bench.put("p", "empty.csv", "")
    bench.put("p", "wanted é 100%+1.csv", "a\n1\n")
    bench.put("p", "parts/a.csv", "a\n1\n")
    bench.put("p", "parts/_hidden.csv", "a\n1\n")
    keys = ["p/wanted é 100%+1.csv", "p/empty.csv", "p/parts", "p/missing.csv", "", "p/old-[1-9].csv"]
    runs = bench.spark.createDataFrame([(k, k) for k in keys], "run_id string, source_key string")
    listed = csv_files.list_source_files(bench.spark, str(bench.source), runs)
    found = {(r.source_key, r.file_size) for r in listed.collect()}
    assert found == {("p/wanted é 100%+1.csv", 4), ("p/empty.csv", 0), ("p/parts/a.csv", 4)}
    matched = {(r.run_id, r.file_path.rsplit("/", 1)[1]) for r in csv_files.match_files(runs, listed).collect()}
    assert matched == {("p/wanted é 100%+1.csv", "wanted%20é%20100%25+1.csv"), ("p/empty.csv", "empty.csv"), ("p/parts", "a.csv")}
