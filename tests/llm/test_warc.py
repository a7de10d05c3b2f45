"""WARC records: files round trip, links, digests, headers and text of derivatives."""

import base64
import gzip
import hashlib
import json

import pytest

from sluice.llm import warc

PAGE = "<html><head><title>A &amp; B</title><style>p{}</style></head><body><!-- x --><p>One<br>two</p><script>var t='</p>'</script><a href='/x?a=1&amp;b=2'>L</a>\r\n\r\nend</body></html>"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.example/x", PAGE), (1, "http://a.example/x", PAGE), (2, None, "WARC/1.0\r\n\r\n\r\n\r\nplain"), (3, "http://b.example/\r\nEvil: 1", None)]
    rows += [(4, "http://c.example/é", ""), (None, "", "<p>é ß" + " word" * 40000), (6, "http://d.example", "<title>open")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "url AS block", "page_id AS headers")


def records(frame):
    return [([tuple(h) for h in r.headers], bytes(r.block)) for r in frame.select("headers", "block").collect()]


def test_files_hold_the_same_records(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 3)
    made = warc.responses(pages, "page_id", "url", "html", "2026-02-03T04:05:06Z")
    warc.write(made, str(tmp_path / "files"))
    back = records(warc.read(spark, str(tmp_path / "files")))
    assert sorted(back) == sorted(records(made)) and len(back) == 7
    for headers, block in back:
        assert warc.value_of(headers, "content-length") == str(len(block))
        assert warc.value_of(headers, "WARC-Block-Digest") == sha1(block)
        assert warc.value_of(headers, "WARC-Payload-Digest") == sha1(block.partition(b"\r\n\r\n")[2])


def test_derivatives_refer_to_their_response(pages):
    made = warc.responses(pages, "page_id", "url", "html", "2026-02-03T04:05:06Z")
    sources = {warc.value_of(h, "WARC-Record-ID"): (h, b) for h, b in records(made)}
    derived = records(warc.derive(made))
    assert len(derived) == 14
    for headers, block in derived:
        of, source = sources[warc.value_of(headers, "WARC-Refers-To")]
        for name in ("WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest"):
            assert warc.value_of(headers, name) == warc.value_of(of, name)
        assert warc.value_of(headers, "WARC-Block-Digest") == sha1(block)
        if warc.value_of(headers, "WARC-Type") == "metadata":
            about = json.loads(block)["Envelope"]
            assert about["WARC-Header-Metadata"] == dict(of) and about["Block-Digest"] == sha1(source)
            http = about["Payload-Metadata"]["HTTP-Response-Metadata"]
            assert http["Headers"]["Content-Type"].startswith("text/html") and http["Entity-Digest"] == warc.value_of(of, "WARC-Payload-Digest")
    assert warc.derive(warc.derive(made)).count() == 0  # nothing but responses has derivatives


def test_page_text_and_links():
    assert warc.plain_text(PAGE) == "One\ntwo\nL\nend"
    assert warc.links(PAGE) == ["/x?a=1&b=2"]
    assert warc.plain_text("") == "" and warc.plain_text("<p>é ß 1 < 2") == "é ß 1 < 2"


def test_empty(spark, pages, tmp_path):
    none = warc.responses(pages.filter("false"), "page_id", "url", "html", "x")
    assert warc.derive(none).count() == 0
    warc.write(none, str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def record(block, kind="response", length=None):
    return b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), len(block) if length is None else length, block)


def kinds(raw):
    return [(warc.value_of(h, "WARC-Type"), b) for h, b in warc.parse(raw)]


def test_blank_lines_between_records_are_skipped():
    raw = record(b"one") + b"\r\n" + record(b"two") + b"\n\n" + record(b"")
    assert kinds(raw) == [("response", b"one"), ("response", b"two"), ("response", b"")]
    assert kinds(b"") == kinds(b"\r\n\r\n") == []


def test_damage_is_reported_and_passed():
    found = kinds(record(b"one") + b"garbage\r\nmore\r\n" + record(b"two"))
    assert found == [("response", b"one"), (warc.UNREADABLE, b"garbage\r\nmore\r\n"), ("response", b"two")]
    bad_length = b"WARC/1.0\r\nContent-Length: many\r\n\r\n"
    assert kinds(bad_length + record(b"two")) == [(warc.UNREADABLE, bad_length[:-2]), ("response", b"two")]
    # a block that is longer than its header says
    assert [k for k, _ in kinds(record(b"one and more", length=3) + record(b"two"))] == ["response", warc.UNREADABLE, "response"]


@pytest.mark.parametrize("compressed", [False, True])
def test_a_file_cut_off_anywhere_ends(compressed):
    whole = record(b"one") + record(b"two" * 50)
    raw = gzip.compress(whole) if compressed else whole
    for end in range(len(raw)):
        found = kinds(raw[:end])
        good = [b for k, b in found if k == "response"]
        assert good == [b"one", b"two" * 50][: len(good)]
        if not compressed:
            assert sum(len(b) for _, b in found) <= end
            # nothing vanishes: a cut that is not between records shows
            if end not in (0, len(record(b"one"))) and not whole[:end].endswith((b"one", b"one\r", b"one\r\n", b"one\r\n\r", b"two", b"two\r", b"two\r\n", b"two\r\n\r")):
                assert found[-1][0] == warc.UNREADABLE or not whole[len(record(b"one")) : end].strip()


def test_unreadable_records_have_no_derivatives(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(b"HTTP/1.1 200 OK\r\n\r\n<p>x") + b"junk\r\n" + record(b"HTTP/1.1 200 OK\r\n\r\n<p>y"))
    read = warc.read(spark, str(tmp_path))
    assert read.count() == 3 and warc.derive(read).count() == 4
