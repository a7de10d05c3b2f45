"""Token ids as a binary file of frequency-ranked, byte-aligned variable-length numbers.

Ids are replaced by their rank in the corpus (the most frequent id is 0), and each rank is written in one to four
little-endian bytes. The lengths stand apart from the numbers: control bytes hold four two-bit lengths each. A reader
looks the lengths up in a table by control byte, turns them into positions by one running sum, and gathers the numbers
from there, a whole block at a time.

A file is a folder of Parquet part files that Spark writes, in which every row is a block: ``shard`` and ``ahead`` (ids
before it in the shard) give its place, ``doc_ids`` the documents, ``payload`` its bytes. Parquet is only the envelope,
so that writing is atomic, works on any store Spark reaches and survives lost executors. The payload is, in
little-endian 32-bit numbers: the magic, the number of documents, the number of ids; then the ids per document; then
control bytes; then data bytes. Small tables beside it hold the ranks and where each shard starts. Documents stand in ascending order of id; rows with equal ids by text hash.

Defined cases: a null or empty text has only the end id; a null document id comes first; repeated rows are all kept;
a document longer than a block makes a block of its own; an empty table makes a file without blocks.
"""

from __future__ import annotations

import re
import struct as binary
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sluice.llm.texts import ranges
from sluice.session import new_path

MAGIC = 0x31564254
BLOCK_IDS = 1 << 18
CACHE_WORDS = 800_000
_TOGETHER = 200  # distinct words given to the tokenizer in one string
_MARK = re.compile(rb"(?<=[A-Za-z])([.,;:!?])(?=[ \n])")


# --- number coding ---


def encode_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers below 2**32."""
    values = np.ascontiguousarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    control = padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    raw = values.view(np.uint8).reshape(-1, 4)
    kept = raw[np.arange(4) <= extra[:, None]]  # row by row, so the bytes of a number stay together
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), kept.tobytes()


#: the four byte lengths behind each control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def decode_numbers(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    length = LENGTHS[control].ravel()[:n]
    ends = np.cumsum(length, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    start = ends - length
    out = padded[start].astype(np.uint32)
    for k in (1, 2, 3):
        some = np.flatnonzero(length > k)
        out[some] |= padded[start[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# --- blocks ---


def pack(counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = encode_numbers(ranks)
    return binary.pack("<III", MAGIC, len(counts), len(ranks)) + counts.astype("<u4").tobytes() + control + data


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids per document, and all ranks."""
    magic, n_docs, n_ids = binary.unpack_from("<III", payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    raw = np.frombuffer(payload, np.uint8)
    at = 12 + 4 * n_docs
    split = at + -(-n_ids // 4)
    return np.frombuffer(payload, "<u4", n_docs, 12), decode_numbers(raw[at:split], raw[split:], n_ids)


# --- tokens ---


class _Numbers:
    """Numbers of words of at most 16 bytes, none of them 0: a hash table whose keys are the bytes themselves."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.number = np.full(1 << bits, -1, np.int32)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for a word without one."""
        slot = self._slot(low, high)
        out = self.number[slot]
        left = np.flatnonzero((out >= 0) & ((self.low[slot] != low) | (self.high[slot] != high)))
        slot = slot[left]
        while len(left):
            slot = slot + 1 & len(self.number) - 1
            out[left] = found = self.number[slot]
            other = (found >= 0) & ((self.low[slot] != low[left]) | (self.high[slot] != high[left]))
            left, slot = left[other], slot[other]
        return out

    def add(self, low: np.ndarray, high: np.ndarray, number: np.ndarray) -> None:
        """File distinct words that have no number yet."""
        if 2 * (self.n + len(low)) > len(self.number):
            at = np.flatnonzero(self.number >= 0)
            old = self.low[at], self.high[at], self.number[at]
            self.__init__((4 * (self.n + len(low))).bit_length())
            self.add(*old)
        self.n += len(low)
        slot = self._slot(low, high)
        while len(low):
            free = np.flatnonzero(self.number[slot] < 0)
            self.number[slot[free]] = number[free]  # of several in one slot, one stays
            here = np.zeros(len(low), bool)
            here[free] = self.number[slot[free]] == number[free]
            self.low[slot[here]], self.high[slot[here]] = low[here], high[here]
            low, high, number, slot = low[~here], high[~here], number[~here], slot[~here] + 1 & len(self.number) - 1


class WordTokens:
    """The tokenizers library behind a cache of words; white space must be no part of any token.

    The vocabulary must lower-case, drop white space and mark the last token of a word, so that many words can go to
    the library in one string. Words between ASCII white space are encoded apart, and so are ASCII marks that end one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        ends = [i for t, i in self.library.get_vocab().items() if t.endswith("</w>")]
        self.ends_word = np.zeros(self.library.get_vocab_size() + 1, bool)
        self.ends_word[ends] = True
        self._clear()

    def _clear(self) -> None:
        self.short, self.number, self.n_words = _Numbers(), {}, 0
        self.ids, self.at = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Numbers for new words, which are encoded here."""
        words = [w.decode("utf-8", "replace") for w in new]
        plain = np.array([w.isalpha() and max(w) <= "\u012f" for w in words], bool)  # one pre-token each, normal form letter by letter
        letters = [w for w, p in zip(words, plain) if p]
        other = [w for w, p in zip(words, plain) if not p]
        joined = self._whole([" ".join(letters[i : i + _TOGETHER]) for i in range(0, len(letters), _TOGETHER)])
        ids = np.array([i for x in joined for i in x], np.int32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(letters):
            raise ValueError("the vocabulary doesn't mark word ends")
        rest = self._whole(other)
        ends = np.concatenate([ends, len(ids) + np.cumsum([len(x) for x in rest])]).astype(np.int64)
        ids = np.concatenate([ids, np.array([i for x in rest for i in x], np.int32)])
        self.ids, self.at = _extended(self.ids, self.at, self.n_words, ids, ends)
        number = np.empty(len(new), np.int64)
        number[np.argsort(~plain, kind="stable")] = self.n_words + np.arange(len(new))
        self.n_words += len(new)
        return number

    def _listed(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words one by one, for those that don't fit the table."""
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            self.number.update(zip(new, self._learn(new).tolist()))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, and the number of words of each.

        Words stand between white space, in lower case as far as they are ASCII. ASCII marks at the end of a word,
        after a letter or digit, are words of their own. The library does the same.
        """
        ends = 1 + np.cumsum([len(t) + 1 for t in texts])
        raw = (b" %b %b" % (b" ".join(texts), bytes(16))).lower()
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data[:-16]]
        at = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        before, after = kind[at - 1], kind[at]
        mark = np.zeros(len(at), bool)
        if len(at):
            mark[:-1] = (after[:-1] == 1) & (before[:-1] == 2) & (after[1:] == 0)
        some = np.flatnonzero(mark)
        mark[some] = _LETTER[data[at[some] - 2], data[at[some] - 1]]
        start, end = at[(before == 0) | mark], at[(after == 0) | mark]
        size = end - start
        low, high = _eight(data, start, size), np.zeros(len(start), np.uint64)
        long = np.flatnonzero(size > 8)
        high[long] = _eight(data, start[long] + 8, size[long] - 8)
        number = self.short.find(low, high).astype(np.int64)
        odd = np.arange(len(size)) if b"\0" in raw[:-16] else np.flatnonzero(size > 16)  # 0 fills the keys up
        missing = number < 0
        missing[odd] = False
        missing = np.flatnonzero(missing)
        if len(missing):
            order = missing[np.lexsort((high[missing], low[missing]))]
            first = np.ones(len(order), bool)
            first[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
            new = order[first]
            made = self._learn([raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())])
            self.short.add(low[new], high[new], made.astype(np.int32))
            number[order] = made[np.cumsum(first) - 1]
        if len(odd):
            number[odd] = self._listed([raw[a:b] for a, b in zip(start[odd].tolist(), end[odd].tolist())])
        return number, np.diff(np.searchsorted(start, ends), prepend=0)

    def _cut_special(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Like ``_cut`` of one text that may hold special tokens, which the library finds before it lower-cases."""
        words = self._listed(_MARK.sub(rb" \1", text).split())  # bytes split at ASCII white space
        return words, np.array([len(words)])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of ids of each."""
        if self.n_words > CACHE_WORDS:
            self._clear()
        parts = []
        for special, run in groupby(texts, lambda t: b"<|" in t):
            parts += map(self._cut_special, run) if special else [self._cut(list(run))]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        word, counts = (np.concatenate(x) for x in zip(*parts))
        size = self.at[word + 1] - self.at[word]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[ranges(self.at[word], size)], np.diff(ends)


_KIND = np.full(256, 2, np.uint8)  # 0 white space, 1 ASCII marks, 2 all else
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 1
_KIND[list(b" \t\n\r\x0b\x0c")] = 0
#: whether two bytes end with a letter or digit that stays one when it is lower-cased: ASCII, or of U+00C0 to U+017F
_LETTER = np.zeros((256, 256), bool)
_LETTER[:, [c for c in range(128) if chr(c).isalnum()]] = True
for _c in range(0xC0, 0x180):
    _LETTER[tuple(chr(_c).encode())] = chr(_c).isalpha() and chr(_c).lower().isalpha()
_FILLED = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _eight(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Up to 8 bytes from each place as one number; data must go on for 8 more bytes."""
    at = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    return at[start] & _FILLED[np.minimum(size, 8)]


def _extended(ids: np.ndarray, at: np.ndarray, n: int, more: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists filed one after another, with n of them so far, and more."""
    used = int(at[n])
    if used + len(more) > len(ids):
        ids = np.concatenate([ids, np.zeros(max(len(ids), len(more)), ids.dtype)])
    if n + len(ends) + 1 > len(at):
        at = np.concatenate([at, np.zeros(max(len(at), len(ends)), at.dtype)])
    ids[used : used + len(more)] = more
    at[n + 1 : n + 1 + len(ends)] = used + ends
    return ids, at


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _groups(texts: pa.Array, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts.cast(pa.binary()).to_pylist():
        group.append(t or b"")
        size += len(group[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, ids, ahead, counts) of (doc_id, text), in the order of the rows: ids as little-endian 32-bit numbers with
    the end id last, and the number of ids before them in their partition. One more row a partition has no ids but
    counts, how often each id from 0 on occurs there, as little-endian 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, done, total = word_tokens(path), 0, np.zeros(0, np.int64)
        for batch in batches:
            at = 0
            for group in _groups(batch.column(1)):
                ids, counts = library.encode(group)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int64)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(group), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)]
                )
                total = _added(total, np.bincount(ids))
                firsts = batch.column(0).slice(at, len(group))
                columns = [firsts, raw.cast(pa.binary()), pa.array(done + ends[:-1]), pa.nulls(len(group), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
                at += len(group)
                done += int(ends[-1])
        if done:
            columns = [pa.nulls(1, firsts.type), pa.nulls(1, pa.binary()), pa.array([done]), pa.array([total.astype("<i8").tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "ids", "ahead", "counts"]
    return docs.mapInArrow(run, f"doc_id {kind}, ids binary, ahead bigint, counts binary")


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two counts by id; ids beyond the end have none."""
    out = np.zeros(max(len(a), len(b)), np.int64)
    out[: len(a)] = a
    out[: len(b)] += b
    return out


# --- files ---


def rank_table(tokens: DataFrame) -> DataFrame:
    """(id, rank) of every id that ``tokenize`` counted, the most frequent first; ties go to the smaller id. As large as the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column(0):
                total = _added(total, np.frombuffer(row.as_py(), "<i8"))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = tokens.select("counts").where("counts IS NOT NULL").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "id")
    return counts.select("id", (F.row_number().over(order) - 1).cast("long").alias("rank"))


def write(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1) -> None:
    """Tokenize ``docs`` and write them to the folders ``path``/ranks, ``path``/shards and ``path``/blocks.

    Texts are dealt out by ranges of document ids, so that shards follow each other, and tokenized once. The ids are
    counted as they are written, and rewritten as blocks without another shuffle.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = docs.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    tokens = tokenize(ordered, tokenizer, end_id).withColumn("shard", F.spark_partition_id())
    raw = new_path(spark, "token-ids")
    tokens.write.option("compression", "zstd").parquet(raw)
    tokens = spark.read.schema(tokens.schema).parquet(raw)
    rank_table(tokens).coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(_table(spark, path, "id", "rank"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emit(kind: pa.DataType) -> pa.RecordBatch:
            counts = np.array([len(ids) // 4 for _, ids, _, _ in held])
            ids = np.frombuffer(b"".join(h[1] for h in held), "<u4")
            columns = [[held[0][3]], [held[0][2]], [len(ids)], [[h[0] for h in held]], [pack(counts, shared.value[ids])]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            kind = batch.column(0).type
            for row in zip(*(batch.column(c).to_pylist() for c in range(4))):
                # a block is a run of one shard, wherever the task's input was cut
                if held and (held[-1][3] != row[3] or held[-1][2] + len(held[-1][1]) // 4 != row[2] or size + len(row[1]) > 4 * BLOCK_IDS):
                    yield emit(kind)
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield emit(kind)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    names = ["shard", "ahead", "n_ids", "doc_ids", "payload"]
    schema = f"shard int, ahead bigint, n_ids bigint, doc_ids array<{kind}>, payload binary"
    written = tokens.where("ids IS NOT NULL").select("doc_id", "ids", "ahead", "shard").mapInArrow(blocks, schema)
    written.write.option("compression", "none").parquet(f"{path}/blocks")
    # a row for each shard, of which there are as many as partitions
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("shard", F.coalesce(before, F.lit(0)).alias("start")).coalesce(1).write.parquet(f"{path}/shards")


def _table(spark: SparkSession, path: str, key: str, value: str) -> np.ndarray:
    """ranks as an array; no larger than the vocabulary."""
    rows = spark.read.parquet(f"{path}/ranks").collect()
    out = np.zeros(1 + max((r[key] for r in rows), default=0), np.uint32)
    out[[r[key] for r in rows]] = [r[value] for r in rows]
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a file; ids as little-endian 32-bit numbers."""
    shared = spark.sparkContext.broadcast(_table(spark, path, "rank", "id"))
    starts = spark.read.parquet(f"{path}/shards").collect()  # as many as the file has shards
    of_shard = spark.sparkContext.broadcast({r.shard: r.start for r in starts})
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts, ranks = unpack(batch.column(3)[i].as_py())
                ids = shared.value[ranks].astype("<u4")
                ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                start = ends[:-1] + batch.column(1)[i].as_py() + of_shard.value[batch.column(0)[i].as_py()]
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)]
                )
                firsts = batch.column(2).slice(i, 1).flatten()
                columns = [firsts, pa.array(start), pa.array(counts.astype(np.int64)), raw.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    blocks = spark.read.parquet(f"{path}/blocks").select("shard", "ahead", "doc_ids", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
