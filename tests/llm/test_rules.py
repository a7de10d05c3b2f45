"""Quality rules, URL filter and decontamination."""

import math
import random
import re
from fractions import Fraction

import duckdb
import pyarrow as pa
import pytest

from sluice.llm import decontaminate, quality, queries, url_filter
from sluice.llm.url_filter import Rule
from tests.llm.conftest import by_row, listed, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality ---


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(words) < 6000 else set()
    repeated = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_equal_brute_force(docs, rows):
    got = by_row(quality.measure(docs, name="m"), "doc_id", *[f"m.{c}" for c in COLUMNS])
    assert got == listed((r[0], *brute_measures(r[1])) for r in rows)


def test_binomial_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.05), (200, 20, 0.08), (7, 7, 0.5)):
        f = Fraction(p)
        exact = sum(math.comb(n, i) * f**i * (1 - f) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)


def test_cutoffs_hold_their_limit_and_catch_bad_documents(spark):
    rnd = random.Random(3)

    def sample(first, n):
        rows, labels = [], []
        for i in range(first, first + n):
            bad = i % 5 == 0
            words = prose(rnd, 30).split(" ")
            if bad:
                words = [w + rnd.choice(["***", "$$$", "###"]) for w in words]
            rows.append((i, " ".join(words), "en" if i % 2 else None))
            labels.append((i, 0 if bad else 1))
        return rows, labels

    rows, labels = sample(0, 5000)
    labels += [(0, 1), (None, 1), (7, None), (10**9, 1)]  # contradicting, null and dangling labels
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int")
    cutoffs = quality.calibrate(quality.measure(frame).drop("text"), known, "lang")
    assert {(r.stratum, r.rule) for r in cutoffs.collect()} >= {("en", "symbols"), (None, "symbols")}
    held_out, _ = sample(10000, 1000)
    judged = quality.judge(quality.measure(spark.createDataFrame(held_out, frame.schema)), cutoffs, "lang")
    kept = {r.doc_id: r.kept for r in judged.select("doc_id", "verdict.kept").collect()}
    good = [kept[i] for i, _, _ in held_out if i % 5]
    assert 1 - sum(good) / len(good) <= quality.RISK and not any(kept[i] for i, _, _ in held_out if i % 5 == 0)


def test_choice_stops_at_the_first_cutoff_that_fails():
    assert quality.choose([0, 0, 50, 0], [5, 9, 100, 200], 5000, 0.007, 0.001) == 1
    assert quality.choose([0, 1], [0, 15], 5000, 0.007, 0.001) is None  # the yield isn't worth a good document
    assert quality.choose([0], [5], 10, 0.007, 0.001) is None  # too few labels to certify anything


def test_without_labels_only_the_base_rule_acts(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = quality.quality_filter(docs, labels)
    assert kept.columns == docs.columns

    def passes(text):
        n, *_, repeated = brute_measures(text)
        return n >= 20 and 100 * repeated <= 30 * n

    assert by_row(kept, "doc_id", "text") == listed((r[0], r[1]) for r in rows if passes(r[1]))
    assert quality.quality_filter(no_docs, labels).count() == 0


# --- URL filter ---

URLS = [
    None, "", "http://", "no scheme", "http://org", "http://org/", "http://A.ORG/x?y", "https://b.example.org/es/1", "http://example.org/en/1",
    "http://example.org/en/123?a", "http://x.example.org/en/2", "http://notexample.org/es/", "ftp://u:p@shop.com/fr/#z", "http://a.com/de/",
    "http://com/de", "http://a.com?/fr/", "x://www.cheap-pills.example.com/en", "http://spam-farm.example.org/en", "http://spam-farm.net",
    "http://www.best-casino.example.net/", "http://example.net/a/b/login", "http://É.example.org/es/é", "http://a.com/fr/" + "x" * 20000,
    "http://a.com/fr/1", "http://a.com/fr/1", "http://a\nb.org/\n", "http://k://org/", "HTTP://ÀB.Org/ES/",
]


def test_urls_equal_sql(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5])], "page_id bigint, url string")
    extra = pages.selectExpr("*", "url AS host", "1 AS path", "2 AS judged_", "url AS token")
    rules = url_filter.rule_table(spark, queries.LISTED_RULES + queries.PATTERN_RULES)
    out = url_filter.judge(extra, rules, name="out")
    assert out.columns == [*extra.columns, "out"]
    got = [(i, h, p, r if t == 2 else None, v) for i, h, p, r, t, v in by_row(out, "page_id", "out.host", "out.path", "out.rule", "out.tier", "out.verdict")]
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r.page_id for r in pages.collect()], "url": [r.url for r in pages.collect()]}))
    assert listed(got) == listed(con.execute(queries.oracle_sql()["op2_url_filter"]).fetchall())
    assert {v for *_, v in got} == {"allow", "block"}


def test_rules_are_found_by_their_rarest_token(spark):
    urls = spark.createDataFrame([(f"u{i}", t) for i in range(5) for t in ("h:org", "h:example", "p:es")][:-3], "url string, token string")
    rules = url_filter.rule_table(spark, [Rule("block", "example.org/es/"), Rule("allow", "*/x"), Rule("block", "rare.org/")])
    index = {r.rule: r.token for r in url_filter.rarest_token_index(rules, urls).collect()}
    assert index == {"example.org/es/": "h:example", "*/x": "", "rare.org/": "h:rare"}
    assert Rule("block", "example.org/en/1").tokens() == ["h:example", "h:org", "p:en"]  # the path may go on after the 1
    assert Rule("block", "a*.b-c.org/d*e/f/").tokens() == ["h:b", "h:c", "h:org", "p:f"]


def test_url_filter_empty(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge(none, url_filter.rule_table(spark, queries.LISTED_RULES)).count() == 0
    assert url_filter.judge(none, url_filter.rule_table(spark, [])).count() == 0


# --- decontamination ---

PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute_contamination(texts, items, window=10):
    patterns = {}
    for item, text in items:
        w = plain_words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            patterns.setdefault(tuple(w[k : k + size]), set()).add("null" if item is None else str(item))
    sizes = {len(p) for p in patterns}
    for text in texts:
        w, hits, found = plain_words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in patterns:
                    hits |= set(range(k, k + size))
                    found |= patterns[tuple(w[k : k + size])]
        yield len(w), sorted(hits), sorted(found)


@pytest.mark.parametrize("pass_bytes", [decontaminate.PASS_BYTES, 400])
def test_contamination_equals_brute_force(spark, docs, rows, pass_bytes):
    texts = [r[1] or "" for r in rows]
    items = [(1, " ".join(texts[3].split(" ")[5:40])), (12, texts[2][:300].upper()), (2, texts[13]), (2, texts[13]), (None, "one, two; THREE")]
    items += [(5, None), (6, " .. "), (7, "word"), (8, "aeiou " * 12), (9, "na na na na na na na na na na na"), (10, prose(random.Random(9), 30))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontaminate.contamination(docs, bench, pass_bytes=pass_bytes, name="out")
    assert out.columns == [*docs.columns, "out"]
    want = [(r[0], *b) for r, b in zip(rows, brute_contamination([r[1] for r in rows], items))]
    assert by_row(out, "doc_id", "out.n_words", "out.hits", "out.items") == listed(want)
    if pass_bytes > 400:
        clean = decontaminate.decontaminate(docs, bench)
        assert clean.columns == docs.columns
        assert by_row(clean, "doc_id") == listed((w[0],) for w in want if not w[3])


def test_contamination_empty(spark, docs, rows, no_docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs, bench).count() == len(rows)
    assert decontaminate.contamination(no_docs, bench).count() == 0
