"""Suffix-array dedup: bytes covered by a 200-byte string that also starts
elsewhere are removed.

Candidate segments come from ``dup_windows``, by anchors of ``GRAM`` bytes: shorter
ones recur by chance, the more often the larger the table, and would keep more and
more text that has no copy and put unlike segments under one key.  A task feeds the distinct
segments of a key to a logarithmic family of suffix-array levels: a batch gets a
suffix array of its own, is merge-scanned against every level for matches of
the full length (both sides of a match are marked), and then levels of the same
size class merge.  A scan builds the suffix array of both sides anew; the merge of
the same two takes it over, and later merges build theirs when the next batch
comes.  So segments are sorted again with each later batch of their key; the bound on a
key's segments in ``dup_windows`` bounds that.  Levels above a size bound are not
merged further, only scanned.  A key that fits
one batch, which may reach ``KEY_BATCHES`` times its usual size for one key, is one level.

Two modes: ``keep="none"`` removes every copy (the same document included);
``keep="first"`` removes only what also starts in a document with a smaller id,
so one document keeps each passage.

Cases: null texts are empty; texts shorter than the length lose nothing; with
``keep="none"`` repeated rows remove each other's bytes, and a null id is a
document like others; with ``keep="first"`` rows with a null id or the same id
neither cause nor suffer removals.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import flat, frugal, row_key, runs, table
from fleetlake.llm.dup_windows import Scheme, covered, decide, occurrences, per_row, span_lists

#: bytes of an anchor
GRAM = 64
BATCH_BYTES = 1 << 17
#: times a batch's bytes that segments of one key may fill before a new batch begins
KEY_BATCHES = 4
LEVEL_BYTES = 1 << 23
NEVER = np.iinfo(np.int64).max


def _settled(high: np.ndarray, low: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of the pairs (high, low); equal pairs share a rank.  Pair and
    position are sorted as one number where they fit 64 bits."""
    n = len(high)
    shift = np.uint64(max(1, int(n - 1).bit_length()))
    key = high if low is None else (high << np.uint64(bits)) | low
    width = bits if low is None else 2 * bits
    if width + int(shift) <= 64:
        packed = (key << shift) | np.arange(n, dtype=np.uint64)
        packed.sort()
        order = (packed & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
        packed >>= shift
    else:
        order = np.argsort(key, kind="stable")
        packed = key[order]
    rank = np.empty(n, np.uint64)
    step = np.zeros(n, np.uint64)
    np.cumsum(packed[1:] != packed[:-1], out=step[1:])
    rank[order] = step
    return order, rank


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """x[i + by], past the end the least value."""
    return np.concatenate((x[by:], np.zeros(min(by, len(x)), np.uint64)))


def suffix_ranks(raw: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """(rank of every suffix by its first ``width`` bytes, width), by prefix doubling
    to the last width below ``length``."""
    rank, width = raw.astype(np.uint64) + np.uint64(1), 1
    while width < 4 and 2 * width < length:
        rank = (rank << np.uint64(9 * width)) | _shifted(rank, width)
        width *= 2
    _, rank = _settled(rank, None, 9 * width)
    bits = max(1, int(len(raw)).bit_length())
    while 2 * width < length:
        _, rank = _settled(rank, _shifted(rank, width), bits)
        width *= 2
    return rank, width


class Level:
    """Segments with the suffix array of their windows."""

    def __init__(self, segs: list[bytes], owners: np.ndarray, length: int):
        self.segs, self.owners, self.length = segs, owners, length
        self.bytes = sum(map(len, segs))
        raw = np.frombuffer(b"".join(segs), np.uint8)
        size = np.array([len(s) for s in segs], np.int64)
        base = np.cumsum(size) - size
        n = size - length + 1
        owner = np.repeat(np.arange(len(segs)), n)
        start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rank, width = suffix_ranks(raw, length)
        at = base[owner] + start
        # the first ``length`` bytes are two overlapping prefixes of ``width`` bytes
        order, rank = _settled(rank[at], rank[at + length - width], max(1, int(len(raw)).bit_length()))
        self.owner, self.start = owner[order], start[order]
        self.edge = np.flatnonzero(np.diff(rank[order].astype(np.int64), prepend=-1))

    def classes(self):
        """Windows in suffix order: (segment, start, first window of each class)."""
        return self.owners[self.owner], self.start, self.edge


def _together(a: Level, b: Level) -> Level:
    return Level(a.segs + b.segs, np.concatenate((a.owners, b.owners)), a.length)


class LevelFamily:
    """Marks, for each window, its total weight and least id over all levels."""

    def __init__(self, segs: list[bytes], lo: np.ndarray, c: np.ndarray, length: int):
        self.segs, self.lo, self.c, self.length = segs, lo, c, length
        n = np.array([len(s) - length + 1 for s in segs], np.int64)
        self.at = np.concatenate(([0], np.cumsum(n)))
        self.weight, self.least = np.zeros(self.at[-1], np.int64), np.full(self.at[-1], NEVER)
        self.levels: list[Level] = []
        self.met: Level | None = None  # the last two levels together, if a scan has built that

    def _scan(self, level: Level, new: int | None = None) -> None:
        """Credit every window with what the others of its class bring.  ``new``:
        segments from this number on meet the rest; else all meet all."""
        seg, start, edge = level.classes()
        at = self.at[seg] + start
        sizes = np.diff(np.append(edge, len(seg)))
        for part in ([np.ones(len(seg), bool)] if new is None else [seg < new, seg >= new]):
            w = np.add.reduceat(np.where(part, self.c[seg], 0), edge)
            lo = np.minimum.reduceat(np.where(part, self.lo[seg], NEVER), edge)
            gain = slice(None) if new is None else ~part
            np.add.at(self.weight, at[gain], np.repeat(w, sizes)[gain])
            np.minimum.at(self.least, at[gain], np.repeat(lo, sizes)[gain])

    def add(self, first: int, last: int) -> None:
        """Insert the batch of segments ``first..last``."""
        self._merge()
        owners = np.arange(first, last)
        batch = Level(self.segs[first:last], owners, self.length)
        self._scan(batch)
        for level in self.levels:
            self.met = _together(level, batch)
            self._scan(self.met, new=first)
        self.levels.append(batch)

    def _merge(self) -> None:
        """Merge the last levels while they are of one size class."""
        while len(self.levels) > 1 and self.levels[-2].bytes <= 2 * self.levels[-1].bytes and self.levels[-2].bytes + self.levels[-1].bytes <= LEVEL_BYTES:
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(self.met or _together(a, b))
            self.met = None
        self.met = None

    def clear(self) -> None:
        self.levels, self.met = [], None


def level_answers(length: int, batch_bytes: int, first: bool):
    def index(segs: list[bytes], lo: np.ndarray, c: np.ndarray, keys: list[int]) -> list[bytes]:
        family = LevelFamily(segs, lo, c, length)
        at = 0
        while at < len(segs):
            end, size = at, 0
            while end < len(segs) and (size < batch_bytes or keys[end] == keys[end - 1] and size < KEY_BATCHES * batch_bytes):
                size += len(segs[end])
                end += 1
            if at and keys[at] != keys[at - 1]:
                family.clear()  # equal windows share a key: no later segment can match these
            family.add(at, end)
            at = end
        out = []
        for i in range(len(segs)):
            a, b = family.at[i], family.at[i + 1]
            if first:
                least = family.least[a:b]
                edge = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1, [len(least)]))
                out.append(np.stack((edge[:-1], np.diff(edge), least[edge[:-1]]), axis=1).astype("<i8").tobytes())
            else:
                x, y = runs(family.weight[a:b] > 1)
                out.append(np.stack((x, y - x, np.zeros(len(x), np.int64)), axis=1).astype("<i8").tobytes())
        return out
    return index


def _finish(length: int, first: bool, carry: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            n_removed, n_spans, digest, kept_text = [], [], [], []
            for i, (key, null, spans) in enumerate(zip(batch.column("k1").to_pylist(), batch.column("id").is_null().to_pylist(),
                                                       span_lists(batch.column("spans")), strict=True)):
                own, removed, pieces = data[offs[i]:offs[i + 1]], 0, 0
                if spans and not (first and null):
                    found = np.concatenate([np.frombuffer(a, "<i8").reshape(-1, 3) + [p, 0, 0] for p, a in spans])
                    if first:
                        found = found[found[:, 2] < key]
                    gone = covered(len(own), found[:, 0], found[:, 0] + found[:, 1] - 1 + length)
                    pieces, removed = len(runs(gone)[0]), int(gone.sum())
                    own = own[~gone]
                n_removed.append(removed)
                n_spans.append(pieces)
                kept = own.tobytes()
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(offs)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                              pa.array(digest, pa.string()), pa.array(kept_text, pa.binary()),
                                              *([pa.array([x.decode("utf-8", "ignore") for x in kept_text]), batch.column("row")] if carry else [])],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *(["kept_text", "row"] if carry else [])])
    return run


def suffix_dedup(docs: DataFrame, length: int = 200, keep: str = "none", id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = BATCH_BYTES, carry: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per row; ``kept`` is binary,
    for a cut may split a character.  ``carry``: also the whole characters of it as
    ``kept_text`` and the input row as ``row``."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    first = keep == "first"
    keyed = row_key(docs, id_col, text_col)
    gram = max(1, min(GRAM, length // 3))
    scheme = Scheme("byte", length, max(gram, length * 9 // 10), gram, 256, 1 << 19)
    found = occurrences(keyed.where("id IS NOT NULL") if first else keyed, scheme, first)
    spans = per_row(found, decide(found, level_answers(length, batch_bytes, first), batch_bytes, scheme))
    if carry:
        keyed = row_key(docs, id_col, text_col, carry=True)
    schema = [("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()),
              ("kept", T.BinaryType()), *([("kept_text", T.StringType()), ("row", docs.schema)] if carry else [])]
    return keyed.join(spans, ["k1", "k2"], "left").drop("k2").mapInArrow(frugal(_finish(length, first, carry)), T.StructType([T.StructField(*x) for x in schema]))


def without_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """The documents without what an earlier document (by id) holds too, with all
    their columns and, if there is one, a new ``n_chars``.  A character that a cut
    splits goes; documents of which nothing is left go too."""
    done = suffix_dedup(docs, length, "first", carry=True)
    gone = F.col("n_removed") > 0
    text = F.when(gone, F.col("kept_text")).otherwise(F.col("row.text"))

    def column(c: str) -> F.Column:
        if c == "text":
            return text.alias(c)
        if c == "n_chars":
            return F.when(gone, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(F.col("row.n_chars")).alias(c)
        return F.col("row").getField(c).alias(c)
    return done.where(~gone | (F.length("kept_text") > 0)).select(*map(column, docs.columns))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")
