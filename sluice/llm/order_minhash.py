"""Near-duplicate classes of documents by order MinHash and banded alignment.

A document is its sequence of words. Its ``K``-word shingles are labelled by how often each has occurred before. Every sketch
picks the ``PICKED`` labelled shingles of smallest hash and keeps them in the order of the text, so two documents share a
sketch if these shingles agree and stand in the same order: likely if few edits lead from one to the other, unlikely if
only their sets of shingles are alike. Documents that share a sketch are candidates. A link is a candidate pair whose edit
similarity, 1 - edits / words of the longer, reaches ``SIMILARITY``, by banded alignment of the whole texts.

Exact copies count once. The documents that share a sketch are compared with the smallest of them, not with each other. First
each document is aligned with the one it is most often held against; what this links forms classes. Then come the
candidate pairs between different classes. Groups of which the smallest doesn't explain all members are open: their members,
explained or not, may be like each other. Documents are left out of whose pairs of neighbouring words too many occur in no other
member of any open group. Of those that are left, up to ``_FEW`` beside a group's largest class are compared with all others. Those of
groups with more are dealt by length into blocks, and every pair of blocks whose lengths allow the similarity is one small task: from counts of
words by hash (``_WIDTH`` numbers a text) it bounds how many words two texts have in common. Pairs of different classes that share an
open group and whose bound reaches the bar are aligned, first the likeliest of each text, so that classes grow, then all others.
The bound loses no pair, and what is written are only the pairs within it; the comparisons of counts grow with the square of the
members of large open groups of about one length.

The words of all texts are dealt out once, by text, and stay there: only pairs and the texts of pairs are shuffled to align them.

Two documents of which no sketch agrees are never compared. The sketches serve the bar of 0.8: of texts of 300 words with
scattered substitutions 97.8 % share one at edit similarity 0.8, 99.8 % at 0.85. Documents of up to ``SHORT`` words, in which
few edits spoil all shingles, have sketches of single words too.

Defined cases: documents without words (null, empty, blank) are copies of each other; a document shorter than a shingle is
one shingle; repeated rows are copies; a null id counts as the smallest, and a class of it is null; different texts under
one id are different documents; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.alignment import distances
from sluice.llm.anchors import shuffles_freed
from sluice.llm.frames import append, free_name, give_back, list_array, small_batches, struct
from sluice.llm.links import components
from sluice.llm.texts import Words, chunks, flat, mixed, rolling, span_hash
from sluice.session import scratch, stage, stage_by

K = 3
SKETCHES = 32
PICKED = 2
SHORT = 25  # words up to which a text has sketches of single words too
_SHORT_SKETCHES = 8
SIMILARITY = 0.8
_FEW = 16  # members of an open group beside its largest class that are compared with all of it
_WIDTH = 256  # counts of words by hash
_BLOCK = 1024  # texts whose counts are compared with those of as many others in one task
_ROWS = 64  # of a block at a time
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2**63, SKETCHES + _SHORT_SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = np.uint64(0x9E3779B97F4A7C15)


def sketches(words: np.ndarray) -> np.ndarray:
    """The sketches of a sequence of word hashes."""
    keys = _picked(words, min(K, len(words)), _FACTORS[:SKETCHES])
    return np.concatenate([keys, _picked(words, 1, _FACTORS[SKETCHES:])]) if len(words) <= SHORT else keys


def _picked(words: np.ndarray, size: int, factors: np.ndarray) -> np.ndarray:
    """A sketch of the shingles of ``size`` words for each of the factors."""
    at = np.arange(len(words) - size + 1)
    shingle = span_hash(rolling(words), at, at + size)
    order = np.argsort(shingle, kind="stable")
    new = np.concatenate([[True], shingle[order[1:]] != shingle[order[:-1]]])
    seen = np.empty(len(at), np.int64)
    seen[order] = at - np.maximum.accumulate(np.where(new, at, 0))  # earlier occurrences of the same shingle
    labelled = mixed(shingle + seen.astype(np.uint64) * _JOIN)
    value = labelled[None, :] * factors[:, None]
    value ^= value >> np.uint64(29)
    if len(at) > PICKED:
        picked = np.argpartition(value, PICKED - 1, axis=1)[:, :PICKED]
    else:
        picked = np.repeat(at[None, :], len(factors), 0)
    picked.sort(axis=1)
    key = np.zeros(len(factors), np.uint64)
    for k in range(picked.shape[1]):
        key = key * _JOIN + labelled[picked[:, k]]
    return mixed(key)


def _sketch(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with a struct column: ``digest`` of the words, their number, ``sketches`` and ``words`` as numbers."""

    def run(texts: pa.Array) -> pa.StructArray:
        digest, counts, keys, numbers = [], [], [], []
        for _, _, data, offsets in chunks(texts):
            words = Words(data, offsets)
            hashes = words.hashes()
            digest += [row.tobytes().hex() for row in _word_digests(words)]
            a, b = words.row_start[:-1], words.row_start[1:]
            counts.append(words.counts())
            numbers.append((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32))
            for x, y in zip(a.tolist(), b.tolist()):
                keys.append(sketches(hashes[x:y]) if y > x else np.zeros(0, np.uint64))
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        flat_keys = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        flat_words = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
        return struct(
            digest=pa.array(digest, pa.string()),
            n_words=n.astype(np.int64),
            sketches=list_array(flat_keys, np.array([len(k) for k in keys], np.int64)),
            words=list_array(flat_words, n),
        )

    fields = "digest string, n_words bigint, sketches array<bigint>, words array<int>"
    return append(docs, text, run, fields, name)


def _aligned(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose edit similarity reaches the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                sides = []
                for c in (2, 3):
                    lists = batch.column(c)
                    values, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
                    sides.append([values[e - k : e] for e, k in zip(ends, lists.value_lengths().to_numpy())])
                longer = np.array([max(len(x), len(y)) for x, y in zip(*sides)])
                # the tolerance keeps e.g. 2 edits in 10 words within 1 - 0.8
                limits = np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)
                good = pa.array(distances(list(zip(*sides)), limits) <= limits)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["a", "b"])
        whole = batch = None
        give_back()

    small_batches(texts.sparkSession)
    # written first: few pairs go to the texts, and only texts of pairs meet
    pairs = stage(pairs.select("a", "b"), "pairs")
    left = texts.select(F.col("doc").alias("a"), F.col("words").alias("left")).join(pairs, "a")
    both = left.join(texts.select(F.col("doc").alias("b"), F.col("words").alias("right")), "b").select("a", "b", "left", "right")
    return stage(both.mapInArrow(run, "a bigint, b bigint"), "aligned")


def _classes(docs: DataFrame, roots: DataFrame, doc: str, name: str) -> DataFrame:
    """``docs`` with the class of the document in column ``doc``."""
    own, root = f"_{name}_member", f"_{name}_root"
    found = roots.select(F.col("member").alias(own), F.col("root").alias(root))
    joined = docs.join(found, F.col(doc) == F.col(own), "left")
    return joined.withColumn(name, F.coalesce(root, doc)).drop(own, root)


def _held_against(groups: DataFrame) -> DataFrame:
    """(group, doc, n_words, lead, lead_words, size): each member of a group beside the group's smallest."""
    lead = groups.groupBy("group").agg(F.min(F.struct("doc", "n_words")).alias("lead"), F.count(F.lit(1)).alias("size"))
    lead = lead.filter("size > 1").select("group", F.col("lead.doc").alias("lead"), F.col("lead.n_words").alias("lead_words"), "size")
    return groups.join(lead, "group").filter("doc <> lead")


def _possible(pairs: DataFrame, similarity: float) -> DataFrame:
    """Lengths alone allow the similarity."""
    longer, shorter = F.greatest("n_words", "lead_words"), F.least("n_words", "lead_words")
    return pairs.filter(shorter >= similarity * longer - 1e-6)


def classes_of(texts: DataFrame, similarity: float, of: DataFrame | None = None) -> DataFrame:
    """(member, root) of distinct documents (doc, n_words, sketches, words) that are near-duplicates of one of smaller number;
    only of those listed in ``of`` (doc), if given."""
    groups = texts if of is None else texts.join(of, "doc", "left_semi")
    groups = groups.select("doc", "n_words", "sketches", F.posexplode("sketches").alias("nth", "group"))
    groups = groups.select("doc", "n_words", F.xxhash64("nth", "group").alias("group"))
    held = stage(_held_against(groups), "candidates")
    # of each document and lead, how many groups they share, and whether any of them has further members
    every = held.groupBy("doc", "lead").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"), F.max("lead_words").alias("lead_words"), F.max("size").alias("size")
    )
    every = stage(every, "candidate-pairs")
    pairs = _possible(every, similarity).select("doc", "lead", "n")
    best = pairs.groupBy("doc").agg(F.max_by("lead", F.struct("n", F.bitwise_not("lead"))).alias("lead"))
    links = _aligned(best.select(F.col("lead").alias("a"), F.col("doc").alias("b")), texts, similarity)
    roots = components(links)

    def apart(rows: DataFrame) -> DataFrame:
        both = _classes(_classes(rows, roots, "doc", "class"), roots, "lead", "lead_class")
        return both.filter(F.col("class") != F.col("lead_class"))

    rest = apart(pairs).join(best, ["doc", "lead"], "left_anti").select(F.col("lead").alias("a"), F.col("doc").alias("b"))
    links = links.unionByName(_aligned(rest, texts, similarity))
    roots = components(links)
    # a group is open if its smallest doesn't explain a member and there are others that may
    unexplained = apart(every.filter("size > 2").select("doc", "lead"))
    opened = held.filter("size > 2").join(unexplained, ["doc", "lead"], "left_semi").select("group", "lead", "lead_words").distinct()
    opened = stage(opened, "open-groups")
    if opened.isEmpty():
        return roots
    # what the smallest explains stays: it may be like what the smallest doesn't explain
    members = held.join(opened.select("group"), "group", "left_semi").select("group", "doc", "n_words")
    members = members.unionByName(opened.select("group", F.col("lead").alias("doc"), F.col("lead_words").alias("n_words")))
    members = stage(_classes(members, roots, "doc", "class"), "open-members")
    # whatever the sizes of their groups, so that this grows with the texts in open groups and not with what passes a bound
    members = stage(members.join(_without_company(members.select("doc").distinct(), texts, similarity), "doc", "left_anti"), "company")

    def tried(both: DataFrame) -> None:
        """Align pairs of different classes."""
        nonlocal links, roots
        found = _aligned(both.select(F.col("lead").alias("a"), F.col("doc").alias("b")), texts, similarity)
        if not found.isEmpty():
            links = stage(links.unionByName(found), "links")
            roots = components(links)

    # groups with few members beside their largest class: these few are held against all, pairs in proportion to the group
    sizes = members.groupBy("group", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("group")
    sizes = sizes.agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("top")).withColumn("others", F.col("n") - F.col("top.n"))
    sizes = stage(sizes.filter("others > 0"), "open-sizes")
    probed = members.join(sizes.filter(F.col("others") <= _FEW).select("group", F.col("top.class").alias("top")), "group")
    others = probed.filter("class <> top").select("group", F.col("doc").alias("lead"), F.col("n_words").alias("lead_words"), F.col("class").alias("_class"))
    beside = probed.join(others, "group").filter("class <> _class")
    tried(_possible(beside, similarity).select(F.greatest("doc", "lead").alias("doc"), F.least("doc", "lead").alias("lead")).distinct())
    inside = members.join(sizes.filter(F.col("others") > _FEW).select("group"), "group", "left_semi")
    inside = stage(inside.groupBy("doc").agg(F.collect_set("group").alias("open")), "open-lists")  # as many as sketches
    if inside.isEmpty():
        return roots
    profiles = _profiles(inside, texts, similarity)
    for best in (True, False):
        tried(_within_bound(_classes(profiles, roots, "doc", "class"), similarity, best).select("doc", "lead").distinct())
    return roots


def _spoilt(similarity: float) -> Column:
    """The most pairs of neighbouring words of a text that a text alike doesn't have: two for each edit that its own length allows.

    A longer text allows more edits, but what makes it longer spoils one pair of the shorter at most.
    """
    return F.floor(2 * (1 - similarity) * F.col("n_words") + 1e-9)


def _counts(lists: pa.Array) -> pa.StructArray:
    """How often words occur in each list, by hash, as little-endian 32-bit numbers."""
    values, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    at = mixed(values.astype(np.uint64)) % np.uint64(_WIDTH)
    row = np.repeat(np.arange(len(sizes)), sizes)
    n = np.bincount(row * _WIDTH + at.astype(np.int64), minlength=len(sizes) * _WIDTH).astype("<u4").reshape(-1, _WIDTH)
    return struct(counts=pa.array([x.tobytes() for x in n], pa.binary()))


def _profiles(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(doc, n_words, open, counts, band, block) of the given (doc, open), and blocks by length: texts alike are of one band or
    of neighbours."""
    step = max(-np.log(similarity), 0.01) * (1 + 1e-9)
    own = texts.select("doc", "n_words", "words").join(members, "doc")
    own = append(own, "words", _counts, "counts binary", "c").select("doc", "n_words", "open", "c.counts")
    own = stage(own.withColumn("band", F.floor(F.log("n_words") / F.lit(float(step))).cast("int")), "profiles")
    return own.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(1 << 30)))


def _within_bound(profiles: DataFrame, similarity: float, best: bool) -> DataFrame:
    """(doc, n_words, lead, lead_words): the pairs of different classes that share an open group and may have as many words in
    common as the similarity takes; with ``best`` only the likeliest of each text in each task."""
    spark = profiles.sparkSession
    sizes = {r.band: r.n for r in profiles.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each factor of length
    blocks = {band: -(-n // _BLOCK) for band, n in sizes.items()}
    tasks = [((b, i), (b, j)) for b, n in blocks.items() for i in range(n) for j in range(i, n)]
    tasks += [((b, i), (b + 1, j)) for b, n in blocks.items() for i in range(n) for j in range(blocks.get(b + 1, 0))]
    sides = [(t, side, *at) for t, pair in enumerate(tasks) for side, at in enumerate(pair) if side == 0 or pair[0] != pair[1]]
    dealt = spark.createDataFrame(sides, "task int, side int, band int, nth int")
    of_band = spark.createDataFrame(list(blocks.items()), "band int, parts int")
    numbered = profiles.join(F.broadcast(of_band), "band").withColumn("nth", F.pmod("block", "parts").cast("int"))
    rows = numbered.join(F.broadcast(dealt), ["band", "nth"]).select("task", "side", "doc", "n_words", "class", "open", "counts")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        side = group["side"].to_numpy()
        docs, words, classes = (group[c].to_numpy() for c in ("doc", "n_words", "class"))
        data, offsets = flat(group["counts"])
        counts = data[offsets[0] : offsets[-1]].view("<u4").reshape(-1, _WIDTH)
        if words.max() < 1 << 16:
            counts = counts.astype(np.uint16)  # so are the sums
        x = np.flatnonzero(side == 0)
        within = len(x) == len(side)
        y = x if within else np.flatnonzero(side == 1)
        columns = np.ascontiguousarray(counts[y].T)
        found = []
        for at in range(0, len(x), _ROWS) if len(y) else ():
            own = x[at : at + _ROWS]
            longer = np.maximum(words[own, None], words[y])
            limit = np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)
            open_pairs = (classes[own, None] != classes[y]) & (np.abs(words[own, None] - words[y]) <= limit)
            if within:
                open_pairs &= docs[own, None] < docs[y]
            if not open_pairs.any():
                continue
            shared = np.zeros(longer.shape, counts.dtype)
            for k in np.flatnonzero(counts[own].any(0)):
                shared += np.minimum(counts[own, k][:, None], columns[k])
            i, j = np.nonzero(open_pairs & (shared.astype(np.int64) + limit >= longer))
            found.append(np.stack([own[i], y[j], 1_000_000 * shared[i, j].astype(np.int64) // longer[i, j]]))
        a, b, like = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
        groups = {k: frozenset(group["open"][k].as_py()) for k in np.unique(np.concatenate([a, b])).tolist()}
        meet = np.array([not groups[i].isdisjoint(groups[j]) for i, j in zip(a.tolist(), b.tolist())], bool)
        a, b, like = a[meet], b[meet], like[meet]
        if best:
            order = np.argsort(-like, kind="stable")
            kept = np.union1d(order[np.unique(a[order], return_index=True)[1]], order[np.unique(b[order], return_index=True)[1]])
            a, b = a[kept], b[kept]
        high, low = np.where(docs[a] > docs[b], a, b), np.where(docs[a] > docs[b], b, a)
        return pa.table([docs[high], words[high], docs[low], words[low]], ["doc", "n_words", "lead", "lead_words"])

    return rows.groupBy("task").applyInArrow(run, "doc bigint, n_words bigint, lead bigint, lead_words bigint")


def _labelled(lists: pa.Array) -> pa.StructArray:
    """The numbers of each list as hashes of the number and how often it has occurred before."""
    values, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
    row, at = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values))
    order = np.lexsort((values, row))
    new = np.ones(len(values), bool)
    new[1:] = (values[order[1:]] != values[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    seen = np.empty(len(values), np.int64)
    seen[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    tokens = mixed(values.astype(np.uint64) + seen.astype(np.uint64) * _JOIN)
    return struct(tokens=list_array(tokens.view(np.int64), sizes))


def _paired(lists: pa.Array) -> pa.StructArray:
    """The pairs of neighbours in each list as hashes of the pair and how often it has occurred before."""
    values, sizes = lists.flatten().to_numpy().view(np.uint32).astype(np.uint64), lists.value_lengths().to_numpy().astype(np.int64)
    inner = np.ones(len(values), bool)
    inner[np.cumsum(sizes)[sizes > 0] - 1] = False  # the last of a list begins no pair
    pairs = mixed(values[:-1] * _JOIN + values[1:])[inner[:-1]] if len(values) else values
    return _labelled(list_array(pairs.view(np.int64), np.maximum(sizes - 1, 0)))


def _without_company(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(doc) of the given documents that none of the others can be like: an edit spoils two pairs of neighbouring words at
    most, and more pairs than that occur in no other of them. Counts only meet, by pair and by document."""
    own = texts.join(members, "doc", "left_semi").select("doc", "n_words", "words")
    paired = append(own, "words", _paired, "tokens array<bigint>", "p").select("doc", F.explode("p.tokens").alias("pair"))
    alone = paired.groupBy("pair").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n")).filter("n = 1")
    alone = alone.groupBy("doc").agg(F.count(F.lit(1)).alias("alone")).join(own.select("doc", "n_words"), "doc")
    return alone.filter(F.col("alone") > _spoilt(similarity)).select("doc")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, name: str = "near"
) -> DataFrame:
    """``docs`` with a struct column: ``class_id``, the smallest id of the document's class, ``n_class`` rows in it, ``digest`` of
    the document's words, and ``first``, true for the rows with the smallest id (and of those, the smallest digest)."""
    spark = docs.sparkSession
    smallest = F.lit(-(2**63))
    own_id = F.coalesce(F.col(doc_id).cast("bigint"), smallest)
    with shuffles_freed(spark), scratch(spark) as staged:
        given = docs.select(own_id.alias("id"), F.col(text).alias("text"))
        sketched = _sketch(given, "text", "s").select("id", "s.*", F.monotonically_increasing_id().alias("doc"))
        with stage_by(sketched, "doc", "sketches") as sketched:
            # the first row of every text stands for it, found by numbers only
            copies = sketched.groupBy("digest").agg(F.min(F.struct("id", "doc")).alias("least"), F.count(F.lit(1)).alias("n"))
            copies = stage(copies.select("digest", "least.*", "n"), "copies")
            texts = sketched.filter("n_words > 0").select("doc", "n_words", "sketches", "words")
            roots = stage(classes_of(texts, similarity, copies.select("doc")), "roots")
        classed = _classes(copies, roots, "doc", "root")
        of_class = classed.groupBy("root").agg(F.sum("n").alias("n_class"), F.min(F.struct("id", "digest")).alias("least"))
        classes = classed.select("digest", "root").join(of_class, "root").select("digest", "n_class", "least")
        classes = stage(classes, "classes")
        staged.pop()  # all but the classes is deleted
    mark = free_name(docs, "_digest")
    digested = append(docs, text, _digests, "digest string", mark)
    found = digested.join(classes, F.col(mark)["digest"] == classes["digest"], "left")
    near = F.struct(
        F.when(F.col("least.id") > smallest, F.col("least.id")).alias("class_id"),
        classes["n_class"],
        classes["digest"],
        ((F.coalesce(digested[doc_id].cast("bigint"), smallest) == F.col("least.id")) & (classes["digest"] == F.col("least.digest"))).alias("first"),
    )
    return found.select(*[digested[c] for c in docs.columns], near.alias(name))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of ``docs``: the one with the smallest id."""
    near = free_name(docs, "near")
    firsts = near_duplicates(docs, doc_id, text, similarity, near).filter(F.col(near)["first"])
    # rows that share id and words are repeated; only rows with a repeated id are gathered
    several = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(doc_id).alias("_several"))
    several = stage(several, "repeated-ids")
    if several.isEmpty():
        return firsts.select(docs.columns)
    same = firsts[doc_id].eqNullSafe(several["_several"])
    again = firsts.join(several, same, "left_semi").withColumn(near, F.col(near)["digest"]).dropDuplicates([doc_id, near])
    return firsts.join(several, same, "left_anti").select(docs.columns).unionByName(again.select(docs.columns))


def _word_digests(words: Words) -> np.ndarray:
    """Two 64-bit hashes of each row's words."""
    hashes = words.hashes()
    a, b = words.row_start[:-1], words.row_start[1:]
    return np.stack([span_hash(rolling(hashes), a, b), span_hash(rolling(mixed(hashes ^ _JOIN)), a, b)], 1)


def _digests(texts: pa.Array) -> pa.StructArray:
    out = [row.tobytes().hex() for _, _, data, offsets in chunks(texts) for row in _word_digests(Words(data, offsets))]
    return struct(digest=pa.array(out, pa.string()))
