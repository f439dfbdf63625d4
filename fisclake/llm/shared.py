"""What several operators need: tables kept in the shared folder, and Arrow text as flat numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.session import shared_folder

#: Bytes of text that a task turns into numpy arrays at a time; a single longer text is taken whole.
CHUNK_BYTES = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written below ``spark.checkpoint.dir``: computed once, read by any executor, safe against lost ones."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, ``kept``: their names can clash with nothing."""
    return F.struct(*(F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(df.columns))).alias("kept")


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` again, from ``kept``."""
    return df.select(*(F.col(f"kept.c{n}").alias(c) for n, c in enumerate(like.columns)))


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now; otherwise they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Returns memory that is free but held to the system: a worker process that waits for its next task takes room from the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class Texts:
    """The texts of some rows as one byte array: text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``. Null counts as empty."""

    def __init__(self, array: pa.Array) -> None:
        array = array.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, 8 * array.offset) if len(array) else np.zeros(1, np.int64)
        data = array.buffers()[2] if len(array) else None
        size = int(offsets[-1] - offsets[0])
        self.bytes = np.frombuffer(data, np.uint8, size, int(offsets[0])) if data is not None and size else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches that hold about ``size`` bytes of text each, with that text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        give_back()
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        place = (np.cumsum(lengths) - lengths) // size
        cuts = np.flatnonzero(np.diff(place)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            part = batch.slice(start, end - start)
            yield part, Texts(part.column(column))
    _powers.clear()
    give_back()


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes belong to words: all but the given ranges. Bytes from 0x80 on are parts of characters beyond ASCII."""
    table = np.ones(256, bool)
    for first, last in excluded:
        table[first : last + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def find_words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and where the words of each text begin (one more entry than texts)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = member[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edge - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Odd multipliers of the word hashes (golden ratio and splitmix constants).
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        table = np.full(max(n, 1), base, np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """64-bit hash of each of the ascending, disjoint spans of ``data``; equal bytes, equal hash, wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first, last = int(starts[0]), int(ends[-1])
    sums = np.zeros(last - first + 1, np.uint64)
    np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * powers(base, last - first), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    value = (sums[ends - first] - sums[starts - first]) * powers(inverse, last - first)[starts - first]
    return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(base))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, ...`` of each run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
