"""BPE and token files against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm import bpe, texts, token_file
from sluice.llm.frames import append, struct
from tests.llm.conftest import by_row, listed

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = " \n\ta'sTreΣİıſ1½é́日 \x85\x1c<|endoftext|>!.,À"


def odd_texts(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(1, 40))) for _ in range(n)]


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_bpe_column_equals_library(docs, rows):
    texts = [r[1] for r in rows]
    want = list(zip([r[0] for r in rows], library(BYTES, texts), [t or "" for t in texts]))
    encoded = bpe.encode_column(docs, BYTES, name="e")
    encoded = encoded.select("doc_id", F.col("e.ids").alias("tokens"))
    decoded = bpe.decode_column(encoded, BYTES, ids="tokens", name="d")
    assert listed((i, list(t), x) for i, t, x in by_row(decoded, "doc_id", "tokens", "d.text")) == listed(want)


def test_bpe_on_odd_texts_and_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 50)
    own, texts = bpe.ByteBpe(BYTES), odd_texts(1500)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        ids, counts = own.encode(part)
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == library(BYTES, part)
        assert own.decode(ids, counts) == part


def test_bpe_decodes_unknown_ids_to_nothing():
    own = bpe.vocabulary(BYTES)
    ids = np.array([-1, 10**6, 64])
    assert own.decode(ids, np.array([3])) == own.decode(ids[2:], np.array([1]))


def test_number_coding_round_trip():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rnd.integers(0, 2**32, n, dtype=np.uint64) >> rnd.integers(0, 33, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_file.encode_numbers(values)
        assert len(control) == -(-n // 4)
        back = token_file.decode_numbers(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert back.tolist() == values.tolist()
    counts = np.array([2, 0, 1])
    assert [x.tolist() for x in token_file.unpack(token_file.pack(counts, np.array([7, 300, 70000])))] == [[2, 0, 1], [7, 300, 70000]]
    with pytest.raises(ValueError):
        token_file.unpack(b"\0" * 12)


def test_words_equal_library_on_odd_texts(monkeypatch):
    monkeypatch.setattr(token_file, "CACHE_WORDS", 50)
    own, texts = token_file.WordTokens(WORDS), odd_texts(1500)
    for at in range(0, len(texts), 100):
        ids, counts = own.encode([t.encode() for t in texts[at : at + 100]])
        ends = np.cumsum(counts)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == library(WORDS, texts[at : at + 100])


def test_token_file_equals_library(spark, docs, rows, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 500)  # several blocks a shard
    path = str(tmp_path / "tokens")
    token_file.write(docs, path, WORDS)
    got = token_file.read(spark, path).collect()
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is not None for r in ordered] == sorted(r.doc_id is not None for r in ordered)
    ids = [r.doc_id for r in ordered if r.doc_id is not None]
    assert ids == sorted(ids) and len(ordered) == len(rows)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    want = [(r[0], zlib.crc32(np.array([*t, 1], "<u4").tobytes())) for r, t in zip(rows, library(WORDS, [r[1] for r in rows]))]
    assert listed((r.doc_id, zlib.crc32(bytes(r.ids))) for r in got) == listed(want)
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    counts = np.bincount(np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in got]))
    assert [r.id for r in sorted(ranks, key=lambda r: r["rank"])] == sorted(np.flatnonzero(counts), key=lambda i: (-counts[i], i))
    empty = str(tmp_path / "empty")
    token_file.write(no_docs, empty, WORDS)
    assert token_file.read(spark, empty).count() == 0


def test_bpe_empty(no_docs):
    assert bpe.encode_column(no_docs, BYTES).count() == 0
    assert bpe.ByteBpe(BYTES).encode([])[0].tolist() == []


def test_round_trip_takes_one_worker(docs, rows, no_docs):
    """Ids and what they decode to come from one pass of Python; two passes are two workers a task, each with its vocabulary."""
    texts = [r[1] for r in rows]
    found = bpe.round_trip_column(docs, BYTES, name="e")
    want = list(zip([r[0] for r in rows], library(BYTES, texts), [t or "" for t in texts]))
    assert listed((i, list(t), x) for i, t, x in by_row(found, "doc_id", "e.ids", "e.text")) == listed(want)
    assert bpe.round_trip_column(no_docs, BYTES).count() == 0
    plan = corpus_pipeline.bpe_ids(docs.sparkSession, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_marks_at_the_end_of_words_are_learned_once(monkeypatch):
    own, learned = token_file.WordTokens(WORDS), []
    whole = own._whole
    monkeypatch.setattr(own, "_whole", lambda words: learned.extend(w for x in words for w in x.split()) or whole(words))
    texts = ["abc abc, abc$$$ ABC!", "abc&&& été, été", "12. 12"]
    ids, counts = own.encode([t.encode() for t in texts])
    assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == library(WORDS, texts)[0]
    assert sorted(learned) == sorted(["abc", ",", "$$$", "!", "&&&", "été", "12", "."])


@pytest.mark.parametrize("cache", [10, 800_000])
def test_words_equal_library_where_marks_are_cut(monkeypatch, cache):
    monkeypatch.setattr(token_file, "CACHE_WORDS", cache)
    starts = ["İ", "ı", "“", "é", "×", "÷", "ß", "ŉ", "ſ", "½", "don't", "x'", "a\0b", "\0", "ab", "é", "日", "a" * 15, "b" * 16, "c" * 17, "z<|", ""]
    ends = [",", "',", "''s", "<", "≠", "$$$", "\0", "\x1c,", "'s", "<|endoftext|>", "!\x85", ".　,", "_", "-x-", "a" * 8 + ";", "\x7f", ""]
    texts = [f"{a}{b}{c}q" for a in starts for b in ends for c in " \n\t̸"] + ["", " ", "a", "a\n", None]
    own = token_file.WordTokens(WORDS)
    for part in (texts, texts[::-1], texts[::7]):
        ids, counts = own.encode([(t or "").encode() for t in part])
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library(WORDS, part)
    assert [x.tolist() for x in own.encode([])] == [[], []]


def test_numbers_of_words_that_share_slots():
    rnd = np.random.default_rng(3)
    low, high = np.arange(1, 40_001, dtype=np.uint64), rnd.integers(0, 2, 40_000, dtype=np.uint64)
    table, order = token_file._Numbers(4), rnd.permutation(40_000)
    for at in range(0, 40_000, 999):
        some = order[at : at + 999]
        assert (table.find(low[some], high[some]) == -1).all()
        table.add(low[some], high[some], some.astype(np.int32))
    assert (table.find(low, high) == np.arange(40_000)).all()
    assert (table.find(low, high + np.uint64(2)) == -1).all()


def test_ids_are_counted_as_they_are_made(docs, rows):
    found = token_file.tokenize(docs.coalesce(2).select("doc_id", "text"), WORDS, 1).collect()
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in found if r.ids is not None])
    counts = [np.frombuffer(bytes(r.counts), "<i8") for r in found if r.counts is not None]
    assert len(ids) == sum(len(t) + 1 for t in library(WORDS, [r[1] for r in rows]))
    assert sum(np.pad(c, (0, 50_000 - len(c))) for c in counts).tolist() == np.bincount(ids, minlength=50_000).tolist()
    assert sum(r.ids is not None for r in found) == len(rows)


def test_workers_give_memory_back_at_the_end_of_a_task(docs, monkeypatch):
    """The powers of the hash base and the cache of units are gone when a task ends; workers live on with what they keep."""

    def compute(column):
        texts.powers(100)
        return struct(n=pa.array(bpe.vocabulary(BYTES).encode(column.to_pylist())[1]))

    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)  # what a task runs, run here
    run = append(docs.select("text"), "text", compute, "n bigint", "_p", done=lambda: bpe.vocabulary(BYTES).forget())
    column = pa.array([f"some words {i}" for i in range(3000)])
    out = list(run(iter([pa.RecordBatch.from_arrays([column], ["text"])])))
    assert sum(b.num_rows for b in out) == 3000
    assert not texts._powers and bpe.vocabulary(BYTES).n_units == 0
    assert len(texts.powers(100)[0]) == 100  # made again
