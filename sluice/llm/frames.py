"""Append Arrow-computed columns to a DataFrame, and read the tables the queries work on."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from sluice.llm import texts

SLICE_ROWS = 1024
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Have Spark send texts to Python workers by slices: the JVM and the worker each hold a batch, and buffers that have grown stay."""
    if not 0 < int(spark.conf.get(_BATCH)) <= SLICE_ROWS:
        spark.conf.set(_BATCH, str(SLICE_ROWS))


def give_back() -> None:
    """Return free memory of this Python worker to the system: workers live on, and an executor counts all it ever held at once."""
    texts.forget_powers()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that clashes with none of ``df``, letter case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append(
    df: DataFrame, column: str | list[str], compute: Callable[..., pa.StructArray], fields: str, name: str, done: Callable[[], None] | None = None
) -> DataFrame:
    """Add struct column ``name`` holding ``compute`` of ``column``, batch by batch; all other columns pass through.

    ``name`` must be free (see ``free_name``). ``compute`` gets an Arrow array of each column and returns a struct array.
    ``done`` is called at the end of each task, since Python workers live on; free memory is given back.
    """
    small_batches(df.sparkSession)
    at = [df.columns.index(c) for c in ([column] if isinstance(column, str) else column)]
    added = StructType.fromDDL(fields)
    schema = StructType([*df.schema.fields, StructField(name, added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE_ROWS):  # what is computed of a slice is sent off before the next
                batch = whole.slice(first, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([*batch.columns, compute(*[batch.column(k) for k in at])], [*batch.schema.names, name])
        if done:
            done()
        whole = batch = None  # else the last rows stay
        give_back()

    return df.mapInArrow(run, schema)


def struct(**columns) -> pa.StructArray:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.StructArray.from_arrays(arrays, list(columns))


def list_array(values: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    """A list column from flat values and the number of values in each row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))
