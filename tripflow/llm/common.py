"""Shared pieces of the text operators: batches of texts as byte arrays, word spans, stable hashes.

A batch is handled as one byte buffer with row offsets, so that splitting into words and hashing them are
a few numpy passes. Nulls count as empty texts.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
PACKAGE_HOME = str(Path(__file__).resolve().parents[2])

U64 = np.uint64


def session(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a batch of very long texts must fit beside the executor's heap.

    Python workers import this package, so they get the path the driver has it from (a cluster that ships the
    package by other means is not affected).
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_HOME])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "400")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def free_name(columns: list[str], name: str) -> str:
    """`name`, with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_rest(spark_col, modulus: int):
    """crc32 of the id written as text, modulo `modulus`; null ids count as the empty text."""
    return F.crc32(F.coalesce(spark_col.cast("string"), F.lit("")).cast("binary")) % modulus


def lean(run):
    """A function over record batches that gives its memory back when its task ends.

    Workers are used again by later stages, and the allocator would keep what the largest of them needed.
    """

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return bounded


# A writer holds one row group per task: small ones for frames with whole texts.
ROW_GROUP_BYTES = 16 << 20


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back: later steps start from the files."""
    from tripflow.session import scratch

    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame made by `stored`, once nothing reads it any more."""
    from tripflow.session import shared_folder

    spark = frame.sparkSession
    home = shared_folder(spark)
    for folder in {f.rpartition("/")[0] for f in frame.inputFiles()}:
        # Only sub-folders of the shared folder are ever made by `stored`.
        if home.removeprefix("file://") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 row offsets into them."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about `limit` bytes of text, or one longer row."""
    if batch.num_rows == 0:
        return
    _, offsets = row_bytes(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def byte_class(*parts: tuple[int, int]) -> np.ndarray:
    """A 256-entry truth table of the bytes inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in parts:
        table[low : high + 1] = True
    return table


# Runs of anything but space and the five ASCII control spaces.
SPACED_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# Runs of digits, ASCII letters and everything beyond ASCII.
PLAIN_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)) | byte_class((0x41, 0x5A))

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


def word_spans(body: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Starts and ends of the words in byte order, and for each row the index of its first word (n + 1)."""
    is_word = inside[body]
    if not is_word.any():
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1]
    last[:-1] &= ~is_word[1:]
    opens = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[opens] = is_word[opens]
    closes = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[closes] = is_word[closes]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SYMBOLS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    if len(have) < n:
        have = np.full(n + n // 8, base, np.uint64)
        have[0] = 1
        _powers[name] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


class RangeHash:
    """64-bit hashes of arbitrary byte ranges of one buffer, from one running sum."""

    def __init__(self, body: np.ndarray, fold: np.ndarray | None = None):
        symbols = _SYMBOLS if fold is None else _SYMBOLS[fold]
        self.sums = np.zeros(len(body) + 1, np.uint64)
        np.cumsum(symbols[body] * _power("up", _BASE, len(body)), out=self.sums[1:])
        self.down = _power("down", _INVERSE, len(body) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * U64(0xA24BAED4963EE407))


_STEPS = np.random.default_rng(977).integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` neighbouring word hashes; the caller drops runs across rows."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _STEPS[0]
    for k in range(1, size):
        total = total + words[k : k + n] * _STEPS[k]
    return mix(total)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of each run of equal keys; batches come sorted by the keys, and a run may span several."""
    held: list[pa.RecordBatch] = []
    current = None

    def flush():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        first = 0
        for k in range(1, batch.num_rows + 1):
            if k == batch.num_rows or values[k] != values[first]:
                if held and values[first] != current:
                    yield current, flush()
                    held = []
                current = values[first]
                held.append(batch.slice(first, k - first))
                first = k
    if held:
        yield current, flush()
