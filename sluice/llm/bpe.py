"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

A text is cut into units that no token crosses (a word with the space before it, mostly). Units not met before are cut
by the tokenizer's pattern, and all their pieces are merged together: the symbols of many pieces lie in one flat array,
each round finds the rank of every neighbouring pair by binary search over the sorted pair keys, and every piece merges
its lowest-ranked pair wherever it occurs, left to right. Ids of units are kept for the next batches, in a cache of
bounded size per Python process.

The vocabulary is read from a tokenizers file of the byte-level kind (no normaliser, one merge for each merged symbol).
Its special tokens are recognised in texts, as that library does.

Defined cases: null and empty texts have no ids and decode to the empty string; texts of any length are encoded whole;
repeated rows are encoded alike; ids unknown to the vocabulary decode to nothing; bytes that are not UTF-8 decode to the
replacement character.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sluice.llm.frames import append, list_array, struct
from sluice.llm.texts import ranges

#: fixed value: the pattern of the byte-level pre-tokenizer
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_UNITS = 150_000
GROUP_CHARACTERS = 1 << 18  # numpy holds some 100 bytes for each while a group is encoded and decoded
_NONE = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kind = (spec.get("pre_tokenizer") or {}).get("type"), spec.get("normalizer"), model.get("ignore_merges")
        if kind[0] != "ByteLevel" or kind[1] or kind[2] or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        characters = byte_characters()
        self.byte_ids = np.array([vocab[c] for c in characters], np.int64)
        left, right, made = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]))
        key = left << 32 | right
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of = {c: bytes([b]) for b, c in enumerate(characters)}
        size = 1 + max([*vocab.values(), *self.special.values()])
        tokens = [b""] * size
        for token, i in vocab.items():
            tokens[i] = b"".join(of[c] for c in token)
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.pattern = regex.compile(PATTERN)
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(names) + ")").split if names else None
        self.unit_number: dict[str, int] = {}
        self.new: list[str] = []
        self._clear()

    def forget(self) -> None:
        """Give the memory of the cache back."""
        self._clear()

    def _clear(self) -> None:
        self.unit_number.clear()
        self.ids, self.n_ids = np.zeros(1 << 16, np.int32), 0
        self.at, self.n_units = np.zeros(1 << 16, np.int64), 0

    # --- merging ---

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after another, and the number of ids of each."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        symbol = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), sizes)
        done_symbol, done_piece = [], []
        while len(symbol):
            rank = self._pair_ranks(symbol, piece)
            first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(piece)))
            low = np.repeat(lowest, sizes)
            busy = low != _NONE
            if not busy.all():
                done_symbol.append(symbol[~busy])
                done_piece.append(piece[~busy])
                symbol, piece, rank, low = symbol[busy], piece[busy], rank[busy], low[busy]
                if not len(symbol):
                    break
            take = rank == low
            # of overlapping pairs (a run of one symbol), every second merges, from the left
            run = take & np.concatenate([[False], take[:-1]])
            if run.any():
                index = np.arange(len(take))
                begin = np.maximum.accumulate(np.where(take & ~run, index, -1))
                take &= (index - begin) % 2 == 0
            at = np.flatnonzero(take)
            symbol[at] = self.made[low[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, piece = symbol[keep], piece[keep]
        if not done_symbol:
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        symbol, piece = np.concatenate(done_symbol), np.concatenate(done_piece)
        order = np.argsort(piece, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(piece, minlength=len(pieces))

    def _pair_ranks(self, symbol: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each symbol; the last symbol of a piece has none."""
        rank = np.full(len(symbol), _NONE)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        key = symbol[inner] << 32 | symbol[inner + 1]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        rank[inner[known]] = self.ranks[at[known]]
        return rank

    # --- texts ---

    def _numbers(self, text: str) -> list[int]:
        """Units of a text, by number; new ones are numbered here and learned before they are used.

        The usual unit is what stands between single spaces, and its space. It is filed without that space; the first
        of a text, and units of texts with other white space around a space, are filed under a mark.
        """
        known = self.unit_number
        parts = text.split(" ")
        parts[0] = _FIRST + parts[0]
        found = list(map(known.get, parts))
        if None in found:
            new = dict.fromkeys(p for p, n in zip(parts, found) if n is None)
            if not (_solid(parts[0][1:]) and all(p[0] == _FIRST or _solid(p) for p in new if p) and "" not in new):
                cut = [0, *[m.start() for m in _CUT.finditer(text)], len(text)]
                parts = [_FIRST + text[i:j] for i, j in zip(cut[:-1], cut[1:])]
                new = dict.fromkeys(p for p in parts if p not in known)
            for p in new:
                known[p] = len(known)
                self.new.append(p)
            found = [known[p] for p in parts]
        return found

    def _learn(self) -> None:
        """Encode the new units."""
        of: dict[str, int] = {}  # distinct pieces
        pieces, ends = [], [0]
        for unit in self.new:
            if unit.isalpha():
                pieces.append(of.setdefault(" " + unit, len(of)))
            elif unit[:-1].isalpha() and unit[-1] in _STOPS:
                pieces.append(of.setdefault(" " + unit[:-1], len(of)))
                pieces.append(of.setdefault(unit[-1], len(of)))
            else:
                unit = unit[1:] if unit[0] == _FIRST else " " + unit
                for k, part in enumerate(self.split_special(unit) if self.split_special else [unit]):
                    if k % 2:
                        pieces.append(-self.special[part] - 1)
                    else:
                        pieces += [of.setdefault(p, len(of)) for p in self.pattern.findall(part)]
            ends.append(len(pieces))
        self.new.clear()
        merged, sizes = self.merge([p.encode("utf-8") for p in of])
        piece = np.array(pieces, np.int64)
        special = piece < 0
        piece_at = np.concatenate([[0], np.cumsum(sizes)])
        start = np.where(special, len(merged), piece_at[np.where(special, 0, piece)])
        size = np.where(special, 1, np.append(sizes, 0)[np.where(special, -1, piece)])
        start[special] += np.arange(special.sum())
        ids = np.append(merged, -piece[special] - 1).astype(np.int32)[ranges(start, size)]
        n = len(ends) - 1
        self.at = _grown(self.at, self.n_units + n + 1)
        self.at[self.n_units : self.n_units + n + 1] = self.n_ids + np.concatenate([[0], np.cumsum(size)])[ends]
        self.ids = _grown(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_units += n
        self.n_ids += len(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of ids of each."""
        if self.n_units > CACHE_UNITS:
            self._clear()
        cut = [self._numbers(t) if t else [] for t in texts]
        if self.new:
            self._learn()
        counts = [len(c) for c in cut]
        unit = np.fromiter(chain.from_iterable(cut), np.int64, sum(counts))
        size = self.at[unit + 1] - self.at[unit]
        ids = self.ids[ranges(self.at[unit], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of flat ids, ``counts`` of them each."""
        known = (ids >= 0) & (ids < len(self.token_at) - 1)
        ids = np.where(known, ids, 0)
        start = self.token_at[ids]
        size = np.where(known, self.token_at[ids + 1] - start, 0)
        raw = self.token_bytes[ranges(start, size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


_FIRST = "\ud800"  # a lone surrogate, which no text holds
_STOPS = ".,;:!?"
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def _solid(part: str) -> bool:
    """No white space at either end, so that a single space before it belongs to its first piece."""
    return part != "" and not part[0].isspace() and not part[-1].isspace()


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def _groups(texts: pa.Array):
    """Runs of rows of bounded size."""
    group, size = [], 0
    for t in texts.to_pylist():
        group.append(t)
        size += len(t or "")
        if size >= GROUP_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_column(docs: DataFrame, path: str, text: str = "text", name: str = "encoded") -> DataFrame:
    """``docs`` with a struct column holding ``ids``, the token ids of each text."""

    def run(texts: pa.Array) -> pa.StructArray:
        bpe = vocabulary(path)
        parts = [bpe.encode(g) for g in _groups(texts)]
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
        counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        return struct(ids=list_array(ids, counts))

    return append(docs, text, run, "ids array<int>", name, done=lambda: vocabulary(path).forget())


def decode_column(docs: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with a struct column holding ``text``, the text of each id list; a null list decodes to the empty string."""

    def run(column: pa.Array) -> pa.StructArray:
        bpe, out = vocabulary(path), []
        for at in range(0, len(column), 256):
            rows = column.slice(at, 256)
            counts = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            out += bpe.decode(rows.flatten().fill_null(-1).to_numpy(zero_copy_only=False), counts)
        return struct(text=pa.array(out, pa.string()))

    return append(docs, ids, run, "text string", name)


def round_trip_column(docs: DataFrame, path: str, text: str = "text", name: str = "encoded") -> DataFrame:
    """``docs`` with a struct column holding ``ids``, the token ids of each text, and ``text``, what they decode to.

    Like ``decode_column`` of ``encode_column``, but a task keeps one Python worker and one vocabulary instead of two of each.
    """

    def run(texts: pa.Array) -> pa.StructArray:
        bpe, ids, counts, decoded = vocabulary(path), [], [], []
        for group in _groups(texts):
            found, n = bpe.encode(group)
            ids.append(found)
            counts.append(n)
            decoded += bpe.decode(found, n)
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return struct(ids=list_array(flat(ids, np.int32), flat(counts, np.int64)), text=pa.array(decoded, pa.string()))

    return append(docs, text, run, "ids array<int>, text string", name, done=lambda: vocabulary(path).forget())
