"""CSV dialect and record numbering."""

from pyspark.sql import functions as F

from sluice.plans.ingest import FileSource
from sluice.sources.events import execution_context

HEADER = "a,b,c"


def land(bench, files, **conf):
    """Land one run per file and return its header and its cells in record order."""
    for name, content in files.items():
        bench.put("p", name, content)
    rows = [("p", name, "2027-11-08", name) for name in files]
    events = bench.spark.createDataFrame(rows, "product string, file_name string, business_date string, run_id string")
    runs = execution_context(events, F.to_timestamp(F.lit("2027-11-08 00:00:00")))
    landed = FileSource(str(bench.source)).land(bench.lake, runs)
    headers = {r.run_id: r.header for r in landed.headers.collect()}
    records = {name: [] for name in files}
    for r in landed.rows.orderBy("run_id", "row_number").collect():
        records[r.run_id].append((r.row_number, r.cells))
    totals = {r.run_id: r.total for r in landed.totals.collect()}
    assert all(totals.get(name, 0) == len(numbered) for name, numbered in records.items())
    for name, numbered in records.items():
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1)), name
    return headers, {name: [c for _, c in numbered] for name, numbered in records.items()}


def test_dialect(bench):
    headers, rows = land(
        bench,
        {
            "plain.csv": f"{HEADER}\n1,2,3\n",
            "no_newline.csv": f"{HEADER}\n1,2,3",
            "crlf.csv": f"{HEADER}\r\n1,2,3\r\n4,5,6\r\n",
            "bom.csv": b"\xef\xbb\xbf" + f"{HEADER}\n1,2,3\n".encode(),
            "blank_lines.csv": f"{HEADER}\n\n1,2,3\n\n\n4,5,6\n",
            "spaces.csv": f"{HEADER}\n , 0 ,\n",
            "empty_quoted.csv": f'{HEADER}\n"",x,""\n',
            "short.csv": f"{HEADER}\n1,2\n1\n",
            "long.csv": f"{HEADER}\n1,2,3,4,5\n",
            "quotes.csv": f'{HEADER}\n"say ""hi""","x, y",z\\\n',
            "quoted_header.csv": '"a","b, too",c\n1,2,3\n',
            "newline.csv": f'{HEADER}\n1,"two\nlines",3\n4,5,6\n',
            "header_only.csv": f"{HEADER}\n",
            "wide.csv": "a,b,c,d,e,f,g\n1,2,3,4,5,6,7\n",
            "unicode.csv": f"{HEADER}\né,ü,漢\n",
            "zero.csv": "",
        },
    )
    assert headers.pop("zero.csv") == []
    assert headers.pop("quoted_header.csv") == ["a", "b, too", "c"]
    assert headers.pop("wide.csv") == list("abcdefg")
    assert all(h == ["a", "b", "c"] for h in headers.values()), headers
    assert rows["plain.csv"] == rows["no_newline.csv"] == rows["bom.csv"] == [["1", "2", "3"]]
    assert rows["crlf.csv"] == rows["blank_lines.csv"] == [["1", "2", "3"], ["4", "5", "6"]]
    assert rows["spaces.csv"] == [[" ", " 0 ", ""]]
    assert [r[:3] for r in rows["empty_quoted.csv"]] == [["", "x", ""]]
    assert rows["short.csv"] == [["1", "2"], ["1"]]
    assert rows["long.csv"] == [["1", "2", "3", "4", "5"]]
    assert [r[:3] for r in rows["quotes.csv"]] == [['say "hi"', "x, y", "z\\"]]
    assert [r[:3] for r in rows["newline.csv"]] == [["1", "two\nlines", "3"], ["4", "5", "6"]]
    assert rows["header_only.csv"] == rows["zero.csv"] == []
    assert rows["wide.csv"] == [["1", "2", "3", "4", "5", "6", "7"]]
    assert rows["unicode.csv"] == [["é", "ü", "漢"]]


def test_numbers_hold_across_splits(bench):
    conf = bench.spark.conf
    before = conf.get("spark.sql.files.maxPartitionBytes")
    conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        many = "id,x\n" + "".join(f"{i},value-{i}\n" for i in range(1, 5001))
        _, rows = land(bench, {"many.csv": many, "few.csv": "id,x\n7,y\n"})
        assert bench.lake.read("raw").select("block_start").distinct().count() > 5
    finally:
        conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r[0] for r in rows["many.csv"]] == [str(i) for i in range(1, 5001)]
    assert rows["few.csv"] == [["7", "y"]]

