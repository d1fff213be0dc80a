"""Texts as byte blocks inside tasks: words, word hashes, shingles, without a Python loop per word."""

from __future__ import annotations

import ctypes
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
U64 = np.uint64

# Byte classes. Words of most operators end at ASCII white space; words of
# decontamination are runs of ASCII letters, digits and non-ASCII characters.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~SPACE
ALNUM = np.ones(256, bool)
ALNUM[: 0x30] = ALNUM[0x3A:0x61] = ALNUM[0x7B:0x80] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_seeded = np.random.default_rng(20)
BYTE_VALUE = _seeded.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
BASE = int(0x9E3779B97F4A7C15 | 5)
_powers: dict[str, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python a few MB at a time; a task holds several copies of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Give freed memory back to the system, Arrow's and numpy's: a worker lives on through all later stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(key: Column | str, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % folds


@dataclass
class Block:
    """Some whole documents of a batch: ids and the bytes of their texts, end to end."""

    ids: np.ndarray
    data: np.ndarray
    offsets: np.ndarray  # len(ids) + 1, into data
    rows: slice  # of the batch

    def texts(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]


def blocks(batch: pa.RecordBatch, key: str = "doc_id", text: str = "text", most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a batch in blocks of about `most` bytes; null texts are empty.

    A longer document makes a block of its own, so memory follows the longest
    document, not the batch. What Arrow has freed goes back to the system after each
    batch: a worker lives on through all later stages.
    """
    n = batch.num_rows
    if not n:
        return
    ids = batch.column(key).to_numpy(zero_copy_only=False)
    texts = pc.fill_null(batch.column(text), "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        lo, hi = int(offsets[a]), int(offsets[b])
        yield Block(ids[a:b], data[lo:hi], offsets[a : b + 1] - lo, slice(a, b))
        a = b
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int, name: str) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for later calls."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES // 2)
        row = np.full(size, base & (2**64 - 1), np.uint64)
        row[0] = 1
        have = np.multiply.accumulate(row, dtype=np.uint64)
        if size <= BLOCK_BYTES * 16:
            _powers[name] = have
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums (one more than bytes), for the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data), "up"), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans' bytes."""
    down = powers(pow(BASE, -1, 2**64), len(sums), "down")
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the `size` bytes from each place on, as span_hashes gives them."""
    down = powers(pow(BASE, -1, 2**64), len(sums), "down")
    return mix((sums[size:] - sums[:-size]) * down[: len(sums) - size] + U64(size))


def hashes_of(ids: np.ndarray) -> np.ndarray:
    """64-bit hash of integer ids, for bit filters."""
    return mix(ids.astype(np.int64).view(np.uint64))


@dataclass
class Words:
    """Word spans of a block; the words of document i are first[i]:first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD) -> Words:
    """Runs of bytes of a class, never across documents."""
    inside = kind[data]
    before = np.zeros(len(data), bool)
    after = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    real = np.unique(offsets)
    before[real[:-1]] = False
    after[real[1:] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the `size` words from each word on, and whether they lie in one document."""
    n = len(hashes)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out[: max(0, n - i)] = out[: max(0, n - i)] * U64(BASE) + hashes[i:]
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return mix(out), left >= size


def crc32_of(ids: np.ndarray, crc: int = 0) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"), crc)


def arrow(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
