"""Helpers of the operators: blocks of text as byte arrays inside a task, and tables kept in the shared folder.

A task sees its rows in blocks of half a MB, so the arrays made from a block stay bounded however many rows the
task has; a block holds at least one whole text.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.session import fresh_dir

BLOCK_BYTES = 500_000
# Rows of an Arrow batch at most, each a whole text: a batch lies in the JVM, where its buffers double, and in Python.
BATCH_ROWS, BATCH_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
SMALL_TABLE = 32 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Words of contracts that split at ASCII white space, as a Java pattern and as a table over bytes.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 32

U64 = np.uint64


# ---- Spark side --------------------------------------------------------------------------------------------


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts lineage and survives a lost executor."""
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def few(frame: DataFrame) -> DataFrame:
    """Rows that are short and cheap to make, in fewer tasks than shuffles have: an eighth, or two per core if that is
    more. Each task and each file takes its time, however few rows it has."""
    return frame.coalesce(max(shuffle_partitions(frame.sparkSession) // 8, 2 * frame.sparkSession.sparkContext.defaultParallelism))


def small_side(table: DataFrame, row_bytes: int) -> DataFrame:
    """A table for one side of a join: broadcast if its rows, which are counted, take up to SMALL_TABLE bytes at
    ``row_bytes`` each; any other joins by shuffle."""
    return F.broadcast(table) if table.count() * row_bytes <= SMALL_TABLE else table


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application, and texts to it in batches of few rows."""
    if not 0 < int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_formweave_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="formweave-"), "formweave.zip")
    with zipfile.ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(target)
    context._formweave_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no classifier learns from: crc32 of the id as text leaves 2 when divided by 4 (a null id does not)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---- inside a task -----------------------------------------------------------------------------------------


@dataclass
class Block:
    """Whole texts in one byte array, each followed by one separator byte (a space)."""

    texts: list[bytes]
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Index of the text that holds each position."""
        return np.searchsorted(self.starts, positions, side="right") - 1


def block_of(texts: list[bytes]) -> Block:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    data = np.frombuffer(b" ".join([*texts, b""]) if texts else b"", np.uint8)
    return Block(texts, data, ends - lengths, ends)


def give_back() -> None:
    """Return free memory to the system: the workers of an executor live on between tasks, and what one has freed is
    of no use to the others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, a few at a time: what Python copies of them stays small."""
    give_back()  # what the task before has left
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[slice, Block]]:
    """The rows of a batch in blocks; a null text counts as empty."""
    column_data = batch.column(batch.schema.get_field_index(column))
    raw = [x or b"" for x in column_data.cast(pa.large_binary()).to_pylist()]
    start = size = 0
    for i, text in enumerate(raw):
        if size and size + len(text) > limit:
            yield slice(start, i), block_of(raw[start:i])
            start, size = i, 0
        size += len(text) + 1
    if start < len(raw):
        yield slice(start, len(raw)), block_of(raw[start:])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0x9FB21C651E98DF25)
    return h ^ (h >> U64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            table = np.full(max(n, BLOCK_BYTES * 2), base, U64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0], _powers[1]


class Spans:
    """Hashes of any byte spans of an array, from one prefix sum; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray):
        powers, self.inverse = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(BYTE_VALUES[data] * powers[: len(data)], out=self.sums[1:])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(U64))

    def windows(self, width: int) -> np.ndarray:
        """One hash for each start at which a span of this width fits."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U64)
        return mix((self.sums[width:] - self.sums[:-width]) * self.inverse[:n] + U64(width))


def words(block: Block, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts (as indexes) of the words of a block; ``breaks`` tells the bytes between words."""
    inside = np.zeros(len(block.data) + 1, np.int8)
    inside[:-1] = ~breaks[block.data]
    turns = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    return starts, ends, block.owner(starts)


def grams(points: np.ndarray, ends: np.ndarray, owner: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of code points, as numbers of ``bits`` bits, and their texts; none crosses a text's end."""
    if len(points) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = len(points) - n + 1
    values = np.full(size, n, U64)
    for k in range(n):
        values = values * U64(0xD1342543DE82EF95) + points[k: k + size].astype(U64) + U64(1)
    values = (values ^ (values >> U64(29))) * U64(0x9FB21C651E98DF25)
    inside = np.arange(n, size + n) <= ends[owner[:size]]
    return (values[inside] >> U64(64 - bits)).astype(np.int64), owner[:size][inside]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of texts one after the other, the end of each text, and the text of each code point."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.cumsum(lengths), np.repeat(np.arange(len(texts)), lengths)


def sort_within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sort the values of each text in place; ``bounds`` are the first indexes and the end."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    return values


def sums_by(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sum of unsigned values per owner; owners ascend."""
    out = np.zeros(n, values.dtype)
    if len(values):
        first = np.flatnonzero(np.diff(owners, prepend=-1))
        out[owners[first]] = np.add.reduceat(values, first)
    return out
