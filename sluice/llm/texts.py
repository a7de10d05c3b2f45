"""Arrow text columns as flat byte arrays: chunks of bounded size, word boundaries and word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SEED = 0x5EED


def _odd_power_base() -> int:
    return 0x9E3779B97F4A7C17 | 3  # congruent to 3 mod 4: swapped neighbours lose one bit of the hash only


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A random 64-bit number for each byte value."""
    return np.random.default_rng(_SEED).integers(1, 2**64, 256, dtype=np.uint64)


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 2)  # a chunk and both its ends
        base = _odd_power_base()
        for name, b in (("up", base), ("down", pow(base, -1, 2**64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def forget_powers() -> None:
    """Give the powers' memory back; they are made again when needed."""
    _powers.clear()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes evenly."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def rolling(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of the base; differences of it are hashes of spans, see ``span_hash``."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span, the same wherever the span stands."""
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets from 0) for runs of rows of about ``limit`` bytes; a longer row stands alone."""
    if len(column) == 0:
        return
    data, offsets = flat(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def byte_table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


#: separators of plain words: space and the control characters 9 to 13
BLANKS = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")


class Words:
    """Word boundaries of a chunk of rows. Words never cross rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = BLANKS):
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~separators[data]
        edge = inside[1:] != inside[:-1]  # edge[i]: a word starts or ends before byte i
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = np.unique(cut[(inside[cut] & inside[cut + 1]) == 1])  # rows that meet inside a word
        marks = np.flatnonzero(edge)
        if len(cut):
            marks = np.sort(np.concatenate([marks, cut, cut]))
        self.start, self.end = marks[0::2], marks[1::2]
        self.data, self.offsets = data, offsets
        #: index of the first word of each row, and the number of words at the end
        self.row_start = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.row_start)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.row_start) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return span_hash(rolling(byte_values()[self.data]), self.start, self.end)

    def text(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """Words of a row joined by one space; ``keep`` marks the words of the chunk to keep."""
        a, b = self.row_start[row], self.row_start[row + 1]
        start, end = self.start[a:b], self.end[a:b]
        if keep is not None:
            start, end = start[keep[a:b]], end[keep[a:b]]
        return joined(self.data, start, end)


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, gap: int = 1) -> bytes:
    """Spans of a byte array one after another, with a space between if ``gap`` is 1."""
    if not len(start):
        return b""
    return take(data, start, end, gap)[0].tobytes()[: -1 if gap else None]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for each span, one after another."""
    length = np.asarray(length, np.int64)
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(np.asarray(start, np.int64) - ends + length, length)


def take(data: np.ndarray, start: np.ndarray, end: np.ndarray, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Gather spans into one array, each followed by ``gap`` spaces; also their offsets there."""
    length = end - start
    out = np.full(int(length.sum()) + gap * len(start), 32, data.dtype)
    offsets = np.concatenate([[0], np.cumsum(length + gap)])
    out[ranges(offsets[:-1], length)] = data[ranges(start, length)]
    return out, offsets


def window_hashes(prefix: np.ndarray, row_start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` symbols that lie in one row, and where they start."""
    n = len(prefix) - 1
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    fits = np.ones(n + 1, bool)
    fits[n - size + 1 :] = False
    late = np.maximum(row_start[:-1], row_start[1:] - size + 1)  # starts too close to the row's end
    fits[ranges(late, row_start[1:] - late)] = False
    start = np.flatnonzero(fits)
    return span_hash(prefix, start, start + size), start


def covered(start: np.ndarray, size: int, n: int) -> np.ndarray:
    """Marks the symbols covered by windows of ``size`` at the given starts."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, start, 1)
    np.add.at(step, np.minimum(np.asarray(start) + size, n), -1)
    return np.cumsum(step[:-1]) > 0
