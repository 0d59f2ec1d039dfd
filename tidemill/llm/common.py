"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import materialize

# Rows of one Arrow batch: a batch of long texts must fit a Python worker.
ROWS_PER_BATCH = "1000"


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of this session's Python stages; returns `df`."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return df


def give_back() -> None:
    """Hand freed memory back to the system: Python workers wait for their next task with what they hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` over the batches of a task, with its memory given back at the end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(df: DataFrame, row: str) -> DataFrame:
    """`df` with its rows numbered in the column `row`, as a written table.

    The numbers follow the plan's splits, which may differ from one job to the next, so they are made once.
    """
    return materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, so that extra ones can never clash with what an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """Texts of a string column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def by_bytes(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about `limit` at most, one item at least."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def read_bounded(path: str, limit: int = 64 << 20) -> bytes:
    """A vocabulary file, read on the driver and shipped with the tasks; its size is checked."""
    with open(path, "rb") as f:
        blob = f.read(limit + 1)
    if len(blob) > limit:
        raise ValueError(f"{path} holds more than {limit} bytes")
    return blob


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)
