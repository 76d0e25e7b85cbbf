"""Arrow batches inside tasks: bounded slices, byte views, typed results."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time (one longer text is taken alone), and of the batches it gets.
SLICE_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
#: Bound of a batch; a session that names none gets BATCH_BYTES, any other stays as it is.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the modules that tasks import to the executors, once an application.

    Spark copies the archive from the driver to every executor by itself.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace_llm.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for name in ("__init__.py", "session.py", *(f"llm/{f}" for f in sorted(os.listdir(os.path.dirname(os.path.abspath(__file__)))) if f.endswith(".py"))):
            archive.write(os.path.join(package, name), f"millrace/{name}")
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def mapped(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with the modules that ``run`` imports at hand in the tasks, and in small batches.

    Workers serve one task after another: each gives back what it does not need any more.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def bounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    # ``run`` takes columns by place: plain names spare it those that Spark would have to quote
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(bounded, schema)


def give_back() -> None:
    """Return memory that is free inside this process to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def columns(names: list[str]) -> list[Column]:
    """Columns by their plain names, whatever characters these hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names`` with as many underscores in front as it takes to be none of ``taken``."""
    used, lead = {t.lower() for t in taken}, "_"
    while any((lead + n).lower() in used for n in names):
        lead += "_"
    return [lead + n for n in names]


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes in column ``text``, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = byte_view(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, type=kind))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    some = counts > 0
    first, many = np.asarray(starts, np.int64)[some], np.asarray(counts, np.int64)[some]
    at = np.cumsum(many) - many
    steps[at[0]] = first[0]
    steps[at[1:]] = first[1:] - (first[:-1] + many[:-1] - 1)
    return np.cumsum(steps)
