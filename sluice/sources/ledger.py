"""The batch ledger: an identity of its own for every batch that writes to a lake.

Whoever numbers batches (a stream's checkpoint, a scheduler's job) is an origin; origin and number are a batch's key.
Opening a key gives a sequence number that no other batch of the lake has, the same one each time the key is opened. What a
batch writes to the shared tables (facts, quarantine, messages) is partitioned by it, so two batches never share a
partition, whatever numbers their origins use.

A batch is open until it commits. Readers pass over rows of open batches, so a batch appears as a whole or not at all. A
replay of a committed batch is recognised and left out; a replay of an open one first removes what the failed attempt left.

Every entry is one small file, created only if absent, and addressed by its name: opening and committing cost the same on
the first day and after years. Numbers grow in the order of opening; one is skipped if its opener fails before using it.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.contracts import struct

_OPENED = struct("sequence bigint, origin string, number bigint, opened_at string")
_CLOSED = struct("sequence bigint, state string, closed_at string")
_lock = threading.Lock()  # local file systems check and create in two steps


@dataclass(frozen=True)
class BatchKey:
    """Who numbers a batch, and its number there."""

    origin: str
    number: int


@dataclass(frozen=True)
class Entry:
    """An opened batch. ``replayed``: opened before; ``committed``: and finished."""

    sequence: int
    key: BatchKey
    replayed: bool = False
    committed: bool = False

    @property
    def batch_id(self) -> str:
        return str(self.sequence)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    @property
    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _create(self, path, body: dict, replace: bool = False) -> bool:
        """Write a small file; False if it is there already."""
        with _lock:
            if not replace and self._fs.exists(path):
                return False
            try:
                out = self._fs.create(path, replace)
            except Py4JJavaError as error:
                if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                    return False
                raise
            try:
                out.write(bytearray(json.dumps(body).encode()))
            finally:
                out.close()
        return True

    def _load(self, path) -> dict | None:
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode() or "null")
        finally:
            stream.close()

    def _names(self, *parts: str) -> Iterator[str]:
        path = self._path(*parts)
        if self._fs.exists(path):
            for status in self._fs.listStatus(path):
                if not status.getPath().getName().startswith((".", "_")):
                    yield status.getPath().getName()

    def _key_path(self, key: BatchKey):
        return self._path("keys", quote(key.origin, safe="") or "%", f"{key.number}.json")

    def _next(self, key: BatchKey) -> int:
        """Take the least free sequence number from the last known one on."""
        last = self._load(self._path("last.json"))
        if last is None:
            at = 1 + max((int(n.removesuffix(".json")) for n in self._names("opened")), default=-1)
        else:
            at = last["sequence"] + 1
        while not self._create(self._opened(at), {"sequence": at, "origin": key.origin, "number": key.number, "opened_at": _now()}):
            at += 1
        self._create(self._path("last.json"), {"sequence": at}, replace=True)  # a hint only
        return at

    def _opened(self, sequence: int):
        return self._path("opened", f"{sequence:012d}.json")

    def _closed(self, sequence: int):
        return self._path("closed", f"{sequence:012d}.json")

    def open(self, key: BatchKey | None = None) -> Entry:
        """The entry of a batch; without a key a new one that nobody can replay."""
        key = key or BatchKey(f"call-{uuid.uuid4().hex}", 0)
        known = self._load(self._key_path(key))
        if known is None:
            sequence = self._next(key)
            # readers must know the batch as open before its key can be found
            self._create(self._path("open", str(sequence)), {"sequence": sequence})
            if self._create(self._key_path(key), {"sequence": sequence}):
                return Entry(sequence, key)
            self._close(sequence, "skipped")
            known = self._load(self._key_path(key))
        closed = self._load(self._closed(known["sequence"]))
        return Entry(known["sequence"], key, True, bool(closed) and closed["state"] == "committed")

    def _close(self, sequence: int, state: str) -> None:
        self._create(self._closed(sequence), {"sequence": sequence, "state": state, "closed_at": _now()}, replace=True)
        self._fs.delete(self._path("open", str(sequence)), False)

    def commit(self, entry: Entry) -> None:
        """Make what the batch wrote visible, for good."""
        self._close(entry.sequence, "committed")

    def abandon(self, entry: Entry) -> None:
        """Give up a batch that will not be tried again; remove its rows first."""
        self._close(entry.sequence, "abandoned")

    def open_ids(self) -> list[str]:
        """Ids of the batches that have not committed; normally those being written now."""
        return sorted(self._names("open"))

    def entries(self) -> DataFrame:
        """One row per batch: sequence, origin, number, state (open, committed, abandoned, skipped) and times."""
        opened, closed = [
            self.spark.read.schema(schema).json(self._path(name).toString()) if self._fs.exists(self._path(name)) else self.spark.createDataFrame([], schema)
            for name, schema in (("opened", _OPENED), ("closed", _CLOSED))
        ]
        state = F.coalesce("state", F.lit("open"))
        return opened.join(closed, "sequence", "left").select("sequence", "origin", "number", state.alias("state"), "opened_at", "closed_at")
