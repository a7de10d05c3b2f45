"""Near-duplicate classes, alignment, components, secrets, and the pipeline as a whole."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm import alignment, frames, order_minhash, secret_scan
from sluice.llm.grammar import Automaton, shape
from sluice.llm.links import components
from sluice.session import stage, stage_by
from tests.llm.conftest import by_row, edited, listed, prose
from tests.llm.test_rules import brute_contamination, brute_measures

SF_DIR = "/root/testdata/sf0.001"


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(line[j] + 1, new[-1] + 1, line[j - 1] + (x != y)))
        line = new
    return line[-1]


def test_distances_equal_brute_force():
    rnd = random.Random(1)
    pairs, limits = [], []
    for _ in range(150):
        a = [rnd.randrange(30) for _ in range(rnd.randrange(70))]
        b = list(a)
        for _ in range(rnd.choice([0, 1, 3, 8, 30])):
            i = rnd.randrange(len(b) + 1)
            b[i : i + rnd.randrange(2)] = [rnd.randrange(30)] * rnd.randrange(2)
        pairs.append((np.array(a, np.int32), np.array(b, np.int32)))
        limits.append(rnd.choice([0, 5, 10, 30]))
    got = alignment.distances(pairs, np.array(limits)).tolist()
    assert got == [min(edit_distance(a, b), k + 1) for (a, b), k in zip(pairs, limits)]


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.member: r.root for r in got} == {x: find(x) for x in root if find(x) != x}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicate_classes(spark, docs, rows):
    out = order_minhash.near_duplicates(docs, name="out")
    assert out.columns == [*docs.columns, "out"]
    got = by_row(out, "doc_id", "text", "out.class_id", "out.n_class", "out.first")
    assert [g[:2] for g in got] == listed((r[0], r[1]) for r in rows)
    members = {}
    for doc, text, cls, _, first in got:
        members.setdefault(cls, []).append((doc, tuple((text or "").split()), first))
    assert {c for c, m in members.items() if len(m) == 1} == {c for _, _, c, n, _ in got if n == 1}
    for cls, m in members.items():
        assert cls in [d for d, _, _ in m] and all(cls is None or cls <= d for d, _, _ in m)
        assert len({w for _, w, first in m if first}) == (2 if cls is None else 1)  # two unlike texts have a null id
    cls = {(doc, tuple((text or "").split())): c for doc, text, c, _, _ in got}
    similar = set()
    for a, x in cls:
        for b, y in cls:
            if max(len(x), len(y)) < 1500:
                if edit_distance(x, y) <= 0.2 * max(len(x), len(y)):
                    similar.add(((a, x), (b, y)))
                sx, sy = shingles(x), shingles(y)
                if x and len(sx & sy) >= 0.8 * len(sx | sy):
                    assert cls[a, x] == cls[b, y], (a, b)
    # every document of a class is like another of it
    for c, m in members.items():
        for doc, x, _ in m:
            others = [(d, w) for d, w, _ in m if (d, w) != (doc, x)]
            assert not others or any(((doc, x), o) in similar for o in others), (c, doc)


def test_hot_group_of_unlike_documents(spark):
    """Many documents share most of their sketches, yet only few are near-duplicates of each other."""
    rnd = random.Random(8)
    common = prose(rnd, 60)
    texts = [common + " " + prose(rnd, 40) for _ in range(60)]
    texts += [edited(rnd, t, 1) for t in texts[40:50]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(frame).select("doc_id", "near.class_id").collect()}
    assert got == {i: i - 20 if i >= 60 else i for i in range(70)}


def classes_by_sketch(spark, texts, sketches):
    """The least member of each text's class where the texts have the given sketches."""
    numbers = {w: k for k, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    rows = [(i, len(t.split()), s, [numbers[w] for w in t.split()]) for i, (t, s) in enumerate(zip(texts, sketches))]
    frame = stage(spark.createDataFrame(rows, "doc bigint, n_words bigint, sketches array<bigint>, words array<int>"), "texts")
    roots = {r.member: r.root for r in order_minhash.classes_of(frame, 0.8).collect()}
    return [roots.get(i, i) for i in range(len(texts))]


def test_pairs_alike_only_by_a_hot_sketch_are_found(spark):
    """Texts of one template share one sketch and no other, and two by two they are near-duplicates."""
    rnd = random.Random(9)
    template, n = prose(rnd, 60), 150
    texts = [template + " " + prose(rnd, 40) for _ in range(n)]
    texts += [edited(rnd, t, 8) for t in texts]
    sketches = [[1] + [1000 * (i + 1) + k for k in range(1, order_minhash.SKETCHES)] for i in range(2 * n)]
    got = classes_by_sketch(spark, texts, sketches)
    assert got[:n] == list(range(n))
    assert got[n:] == [i if edit_distance(texts[i].split(), texts[n + i].split()) <= 20 else n + i for i in range(n)]


@pytest.mark.parametrize("n, edits", [(10, 2), (25, 5), (60, 11), (300, 57), (300, 45), (300, 30)])
def test_sketches_fit_the_bar(n, edits):
    """Texts with scattered substitutions down to an edit similarity of 0.8 share a sketch."""
    rnd = np.random.default_rng(12)
    found = 0
    for _ in range(300):
        a = rnd.integers(0, 2**63, n, dtype=np.uint64)
        b = a.copy()
        b[rnd.choice(n, edits, replace=False)] = rnd.integers(0, 2**63, edits, dtype=np.uint64)
        x, y = order_minhash.sketches(a), order_minhash.sketches(b)
        found += bool((x[: len(y)] == y[: len(x)]).any())
    assert found >= 0.95 * 300


@pytest.mark.parametrize("more", [0, 20])
def test_explained_members_are_held_against_the_others(spark, more):
    """A is like the lead L, B is like A but unlike L, and one sketch is all they share."""
    rnd = random.Random(11)
    lead = prose(rnd, 100).split()
    a = [f"a{k}" if k < 15 else w for k, w in enumerate(lead)]
    b = [f"b{k}" if k >= 85 else w for k, w in enumerate(a)]
    texts = [" ".join(t) for t in (lead, a, b)] + [prose(rnd, 100) for _ in range(more)]
    assert classes_by_sketch(spark, texts, [[1]] * len(texts)) == [0, 0, 0, *range(3, 3 + more)]


def test_large_parts_of_equal_words_are_compared_pair_by_pair(spark):
    """Permutations of the same words share every rare word, yet only few are near-duplicates."""
    rnd = random.Random(10)
    words = [f"w{k}" for k in range(20)]
    texts = [" ".join(rnd.sample(words, 20)) for _ in range(50)]
    texts += [" ".join([*t.split()[1:], t.split()[0]]) for t in texts[10:30]]
    got = classes_by_sketch(spark, texts, [[1] for _ in texts])
    assert got == list(range(50)) + list(range(10, 30))


def test_an_insertion_leaves_a_short_text_in_company(spark):
    rows = [(1, 4, [1, 2, 3, 4]), (2, 5, [1, 2, 9, 3, 4]), (3, 4, [21, 22, 23, 24])]
    texts = spark.createDataFrame(rows, "doc bigint, n_words bigint, words array<int>")
    assert [r.doc for r in order_minhash._without_company(texts.select("doc"), texts, 0.8).collect()] == [3]


def test_members_without_company_are_left_out_of_small_groups_too(spark, monkeypatch):
    """What is held against other members are those that may be like one, whatever the size of their group."""
    rnd = random.Random(13)
    texts = [prose(rnd, 60) for _ in range(12)]
    texts.append(edited(rnd, texts[11], 3))
    tried, aligned = [], order_minhash._aligned
    monkeypatch.setattr(order_minhash, "_aligned", lambda pairs, *more: tried.append(pairs.count()) or aligned(pairs, *more))
    assert classes_by_sketch(spark, texts, [[1]] * 13) == [*range(12), 11]
    assert tried == [12, 0, 1]  # against the smallest, and the only pair that is left


def test_pairs_within_the_bound_hold_all_alike_pairs(spark, monkeypatch):
    """Over several blocks and lengths; unlike texts that share a passage make no rows."""
    monkeypatch.setattr(order_minhash, "_BLOCK", 16)
    rnd = random.Random(12)
    passage = [rnd.randrange(10**6) for _ in range(30)]
    words = [[rnd.randrange(10**6) for _ in range(rnd.randrange(25, 40))] + passage for _ in range(60)]
    for i in range(0, 60, 3):
        copy = list(words[i])
        for _ in range(rnd.randrange(1, 12)):
            at = rnd.randrange(len(copy))
            copy[at : at + rnd.randrange(2)] = [rnd.randrange(10**6)] * rnd.randrange(2)
        words.append(copy)
    texts = spark.createDataFrame([(i, len(w), w) for i, w in enumerate(words)], "doc bigint, n_words bigint, words array<int>")
    members = texts.selectExpr("doc", "array(7L, if(doc = 3, 8L, 9L)) as open", "doc as class")
    profiles = order_minhash._profiles(members.drop("class"), texts, 0.8).join(members.select("doc", "class"), "doc")
    found = [(r.lead, r.doc) for r in order_minhash._within_bound(profiles, 0.8, False).collect()]
    alike = {
        (i, j) for j in range(len(words)) for i in range(j) if edit_distance(words[i], words[j]) <= int(0.2 * max(len(words[i]), len(words[j])) + 1e-9)
    }
    assert alike and alike <= set(found) and len(found) == len(set(found)) <= 2 * len(alike)


def test_words_stay_where_they_were_dealt(spark):
    texts = spark.range(1000).selectExpr("id as doc", "array(cast(id as int)) as words")
    pairs = stage(spark.range(1, 1000).selectExpr("id - 1 as a", "id as b"), "some-pairs")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with stage_by(texts, "doc", "dealt") as dealt:
            joined = pairs.join(dealt.withColumnRenamed("doc", "a"), "a")
            assert joined.count() == 999
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.split("Initial Plan")[0].count(" Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_keep_first_leaves_one_row_a_class(docs, no_docs):
    kept = order_minhash.keep_first(docs)
    assert kept.columns == docs.columns
    classes = order_minhash.near_duplicates(docs, name="out").select("out.class_id").distinct().count()
    assert kept.count() == classes + 1  # two unlike texts have a null id
    assert order_minhash.keep_first(no_docs).count() == 0


# --- secrets ---

SECRETS = [
    "x password=abcdefgh1 y", "PassWd : \"s3cr3t_val-1\"", "token:abc secret=xyzxyzxyz", "token=secret:abcdefgh", "api-key=12345678", "apikey='12345678'",
    "api_key==a.b/c+d_e=f", "AKIA" + "A1" * 8 + " AKIASHORT", "f" * 31 + " " + "0123456789abcdef" * 2 + "é", "ſecret=abcdefgh1", "toKen=abcdefgh1",
    None, "", "plain words only", "x" * 5000 + " password=abcdefgh12 " + "y" * 5000, "password=password=abcdefgh",
]


def brute_base(text):
    text, spans = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for kind, pattern, least, group in ((0, assign, 8, 2), (1, re.compile("AKIA[A-Z0-9]+"), 16, 0), (2, re.compile("[0-9a-f]+"), 32, 0)):
        spans += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return [(secret_scan.KINDS[k], a, b) for a, k, b in sorted(spans)]


def test_base_spans_and_masks(spark, docs, rows, no_docs):
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate([*SECRETS, SECRETS[0]])], "doc_id bigint, text string, n_chars bigint")
    out = secret_scan.scan(frame, secret_scan.sample_credentials(frame), name="out")
    for doc, text, base, added in by_row(out, "doc_id", "text", "out.base", "out.added"):
        assert [tuple(s) for s in base] == brute_base(text)
        assert all(tuple(s)[0] == "format" for s in added)
    clean = {r.doc_id: r for r in secret_scan.mask_secrets(frame).collect()}
    assert clean[0].text == "x [secret] y" and clean[0].n_chars == len("x [secret] y")
    assert clean[11].text is None and clean[13].text == "plain words only" and clean[13].n_chars == 13
    masked = secret_scan.mask_secrets(docs)
    assert masked.columns == docs.columns
    assert by_row(masked, "doc_id", "text") == listed((r[0], secret_scan.MASK if brute_base(r[1]) else r[1]) for r in rows)
    assert secret_scan.mask_secrets(no_docs).count() == 0


def test_automata_tell_formats_apart():
    rnd = random.Random(6)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(300)]
    keys = ["AKIA" + "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(300)]
    plain = [prose(rnd, 3).replace(" ", "-") + f"/page-{rnd.randrange(1000)}.html" for _ in range(300)]
    sample = {"hex": hexes[:200], "access": keys[:200], "plain": plain[:200]}
    scorer = secret_scan.Scorer(sample)
    assert len(scorer.formats[0].seen) > 0
    held_out = [(s, True) for s in hexes[200:] + [k.replace("AKIA", "ASIA") for k in keys[200:]]] + [(s, False) for s in plain[200:]]
    right = sum((scorer.score(s) >= secret_scan.MARGIN) == label for s, label in held_out)
    assert right >= 0.97 * len(held_out)
    _, added = scorer.spans("see " + keys[0].replace("AKIA", "ASIA") + " there")
    assert added == [(4, 3, 24)]


def test_automaton_merges_alike_states():
    strings = [shape("ab" * n) for n in range(1, 9) for _ in range(2 ** (10 - n))]
    merged = Automaton(strings)
    reached, edge = {0}, [0]
    while edge:
        for t in merged.next[edge.pop()].values():
            if t not in reached:
                reached.add(t)
                edge.append(t)
    assert len(reached) < 8  # the prefix tree has 17
    assert merged.log_likelihood(shape("abab")) > merged.log_likelihood(shape("0000")) + 10
    assert Automaton([]).log_likelihood("a") < 0


# --- pipeline ---


def test_pipeline_equals_brute_force(spark):
    table = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "secret_masking", "bpe_ids"]
    docs, frames = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF_DIR), name)
        frames.append(docs)
    assert all(f.columns == columns for f in frames[:-1])
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]

    def fine(text):
        n, *_, repeated = brute_measures(text)
        return n >= 20 and 100 * repeated <= 30 * n

    texts = {r["doc_id"]: r["text"] for r in table}
    assert ids[0] == {i for i, t in texts.items() if fine(t)}  # too few labels here to certify a cutoff
    # of every pair alike in shingles one goes, and whatever goes has a smaller document like it
    left = {i: (texts[i] or "").split() for i in ids[0]}
    sets = {i: shingles(w) for i, w in left.items()}
    for i in left:
        like = [j for j in left if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
        assert not (like and i in ids[1])
        if i not in ids[1]:
            assert any(len(sets[i] & sets[j]) > 0.2 * len(sets[i] | sets[j]) for j in left if j < i)
    found = brute_contamination([texts[i] for i in sorted(ids[1])], bench)
    assert ids[2] == {i for i, (_, hits, _) in zip(sorted(ids[1]), found) if not hits}
    masked = {r.doc_id: r.text for r in frames[3].collect()}
    for i, text in masked.items():
        assert not brute_base(text) or brute_base(text) == []
        assert text == texts[i] or secret_scan.MASK in text
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in frames[4].collect():
        assert r.ids == library.encode(masked[r.doc_id], add_special_tokens=False).ids and r.round_trip and r.n_tokens == len(r.ids)
    assert Counter(ids[3]) == Counter(ids[4]) == Counter(ids[2])


@pytest.mark.parametrize("step", range(5))
def test_stages_take_awkward_tables(spark, docs, no_docs, step):
    name, f = corpus_pipeline.STAGES[step]
    out = f(spark, docs, SF_DIR)
    assert step == 4 or out.columns == docs.columns
    assert out.count() <= docs.count()
    assert f(spark, no_docs, SF_DIR).count() == 0


def test_texts_go_to_workers_by_slices(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for size, wanted in (("10000", "1024"), ("0", "1024"), ("100", "100")):
        spark.conf.set(key, size)
        frames.append(docs, "text", order_minhash._digests, "digest string", "found")
        assert spark.conf.get(key) == wanted
    spark.conf.set(key, before)
