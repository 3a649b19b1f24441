"""Helpers shared by the operators: Arrow text buffers, words, hashes, scratch tables.

Text is handled as flat UTF-8 buffers (one byte array and row offsets) taken
straight from Arrow, in slices of bounded size, so that memory does not depend
on how many rows a batch holds.  A word is a maximal run of bytes other than
space and 0x09-0x0D; a null text is an empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path

SLICE_BYTES = 1 << 21
U64 = np.uint64
#: odd multiplier of the polynomial hashes
P1 = U64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts the
    lineage, so that a lost executor costs no earlier stage, and has Spark delete
    the write's shuffle files when it ends instead of when the driver collects."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Columns ``k1, k2, id, text`` and no others but, on ``carry``, the whole ``row``.

    ``(k1, k2)`` names a distinct (id, text) pair, nulls included: ``k1`` is the
    id (0 for null), ``k2`` a 64-bit hash of the text and of both null marks.
    Other columns of the input are dropped, so no name can clash.
    """
    i, t = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return docs.select(
        F.coalesce(i, F.lit(0).cast("long")).alias("k1"),
        F.xxhash64(i.isNull(), t.isNull(), t).alias("k2"),
        i.alias("id"), t.alias("text"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes together stay near ``limit`` (one row at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), in wrap-around arithmetic."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * P1)
_POW = np.ones(64, np.uint64)
np.cumprod(np.full(63, P1, np.uint64), out=_POW[1:])


def _powers(n: int) -> np.ndarray:
    global _POW
    if n > len(_POW):
        p = np.full(n, P1, np.uint64)
        p[0] = U64(1)
        _POW = np.cumprod(p)
    return _POW


def word_bounds(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per row the first word's index (n+1 values).

    ``gaps`` marks the bytes between words."""
    ink = ~gaps[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    o = offsets[:-1][offsets[:-1] < len(data)]
    first[o] = ink[o]
    e = offsets[1:]
    e = e[e > 0] - 1
    last[e] = ink[e]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes; the bounds must be those of all words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    base = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length, out=base[1:])
    at = np.arange(base[-1]) - np.repeat(base[:-1] - starts, length)
    within = at - np.repeat(starts, length)
    v = _BYTE[data[at]] * _powers(int(length.max()))[within]
    return mix(np.add.reduceat(v, base[:-1]) + length.astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``h[i:i+k]`` for every i with k units left (order matters)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    acc, done, part, width = None, 0, h, 1
    bits = k
    while True:
        if bits & 1:
            acc = part[: len(h) - k + 1 + done][done:] if acc is None else acc * P1 ** U64(width) + part[done: done + len(h) - k + 1]
            done += width
        bits >>= 1
        if not bits:
            return mix(acc + U64(k))
        part = part[:-width] * P1 ** U64(width) + part[width:]
        width *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    if len(x) < w:
        return x[:0]
    m, width = x, 1
    while 2 * width <= w:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[: len(x) - w + 1], m[w - width: w - width + len(x) - w + 1])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # a C library without it
    _TRIM = None


def give_back() -> None:
    """Return free memory to the system: a Python worker outlives its task, and what
    it keeps for later is memory that the tasks beside it cannot use."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def frugal(run):
    """A batch function that returns free memory before and after its task."""
    def task(batches):
        give_back()
        yield from run(batches)
        give_back()
    return task


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
