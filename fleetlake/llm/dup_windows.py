"""Shared frame of the two substring operators: which fixed-length windows of a
table's texts also occur elsewhere.

A unit is a word or a byte.  The work is dealt by content, so that equal windows
always meet in one task and no text is compared with the whole corpus:

1. ``anchors``: every sub-window of ``sub`` units is represented by the least
   k-unit hash inside it.  Equal sub-windows have equal representatives, so a
   representative that occurs once in the table rules its sub-windows out.
   Counts are combined before the shuffle.
2. ``occurrences``: a window whose sub-windows all survive is a candidate.
   Consecutive candidates with the same least hash form a run; a run is stored
   as one segment (run plus the L-1 units that its last window needs), keyed by
   that hash.
3. ``distinct segments``: equal segments are one row with their least document
   id and number of occurrences, combined in each task before the shuffle; so a passage that
   a third of all documents share costs its holders one pre-aggregated row.
   What stays under one key are segments of unequal extent or content.
4. An index (FM-index or suffix-array levels) over the segments of one key says
   for each window of each distinct segment what holds of it.  A key of more than
   ``KEY_SEGMENTS`` distinct segments (near copies, cut at different edits) is split:
   the windows of its segments are dealt to the index by longer grams (``decide``).
5. The answer is joined back to the occurrences and then to the documents.

Every stage covers whole texts; the anchors only remove windows that cannot
occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import _BYTE, U64, cut, flat, frugal, gram_hashes, runs, slices, sliding_min, word_bounds, word_hashes

TOP = U64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Scheme:
    unit: str        # "word" or "byte"
    length: int      # units of a window
    sub: int         # units of a sub-window
    gram: int        # units of an anchor
    longest: int     # windows of a segment
    slice_bytes: int


def units(data: np.ndarray, offs: np.ndarray, unit: str):
    """(hash of each unit, first unit of each row, buffer, start of each unit in it).

    For words the buffer holds each word and one space; a unit's bytes end one
    before the next unit's start.  For bytes the buffer is the data."""
    if unit == "byte":
        return _BYTE[data], offs, data, None
    starts, ends, first = word_bounds(data, offs)
    n = ends - starts + 1
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=at[1:])
    src = np.arange(at[-1]) - np.repeat(at[:-1] - starts, n)
    src[at[1:] - 1] = 0
    buf = data[src] if len(src) else np.zeros(0, np.uint8)
    buf[at[1:] - 1] = 32
    return word_hashes(data, starts, ends), first, buf, at


def _least(h: np.ndarray, first: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hashes, least gram hash of each window, window lies in one row)."""
    g = gram_hashes(h, gram)
    m = sliding_min(g, length - gram + 1)
    inside = np.ones(len(m), bool)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        inside[max(a, b - length + 1):b] = False
    return g, m, inside


def _anchor_rows(s: Scheme):
    w = s.sub - s.gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            for a, b in slices(offs, s.slice_bytes):
                h, first, _, _ = units(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], s.unit)
                g, m, inside = _least(h, first, s.sub, s.gram)
                if not inside.any():
                    continue
                # a gram is an anchor if it is the least of some window that it lies in
                pad = np.full(w - 1, TOP, np.uint64)
                top = ~sliding_min(np.concatenate((pad, np.where(inside, ~m, TOP), pad)), w)
                at = np.flatnonzero((g == top[:len(g)]) & (top[:len(g)] > 0))
                row = np.searchsorted(first, at, side="right") - 1
                order = np.lexsort((g[at], row))
                row, val = row[order], g[at][order]
                new = np.ones(len(val), bool)
                new[1:] = (row[1:] != row[:-1]) | (val[1:] != val[:-1])
                where = np.flatnonzero(new)
                take = pa.array(row[where] + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(val[where].view(np.int64)), batch.column("k1").take(take), batch.column("k2").take(take),
                     pa.array(np.diff(np.append(where, len(val))).astype(np.int32))], ["h", "k1", "k2", "c"])
    return run


def _pieces(ok: np.ndarray, key: np.ndarray, first: np.ndarray | None, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive candidates (``ok``) of one key, in pieces of at most ``longest``:
    first window and the one behind the last.  ``first``: rows, where windows of two of
    them may lie side by side."""
    head, tail = ok.copy(), ok.copy()
    apart = key[1:] != key[:-1]
    if first is not None:
        apart[first[(first > 0) & (first < len(key))] - 1] = True
    head[1:] &= ~ok[:-1] | apart
    tail[:-1] &= ~ok[1:] | apart
    lo, hi = np.flatnonzero(head), np.flatnonzero(tail) + 1
    pieces = -(-(hi - lo) // longest)
    step = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * longest
    lo, hi = np.repeat(lo, pieces) + step, np.repeat(hi, pieces)
    return lo, np.minimum(hi, lo + longest)


def _cut_out(buf: np.ndarray, at: np.ndarray | None, lo: np.ndarray, end: np.ndarray) -> list[bytes]:
    """The units ``lo..end`` of a buffer, as bytes."""
    raw = buf.tobytes()
    if at is None:
        return [raw[x:y] for x, y in zip(lo.tolist(), end.tolist(), strict=True)]
    return [raw[x:y] for x, y in zip(at[lo].tolist(), (at[end] - 1).tolist(), strict=True)]


def _digests(segs: list[bytes]) -> list[bytes]:
    return [hashlib.blake2b(x, digest_size=16).digest() for x in segs]


def _segment_rows(s: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            known = batch.column("hashes")
            for a, b in slices(offs, s.slice_bytes):
                h, first, buf, at = units(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], s.unit)
                _, m, inside = _least(h, first, s.sub, s.gram)
                # the hashes of neighbouring rows only add candidates, which the index decides
                dup = np.unique(known.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                if not len(dup) or not len(m):
                    continue
                near = np.minimum(np.searchsorted(dup, m), len(dup) - 1)
                held = np.concatenate(([0], np.cumsum((dup[near] == m) & inside)))
                span = s.length - s.sub + 1
                if len(m) < span:
                    continue
                ok = held[span:] - held[:-span] == span
                key = sliding_min(m, span)
                lo, hi = _pieces(ok, key, None, s.longest)
                if not len(lo):
                    continue
                row = np.searchsorted(first, lo, side="right") - 1
                segs = _cut_out(buf, at, lo, hi + s.length - 1)
                take = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k1").take(take), batch.column("k2").take(take), pa.array((lo - first[row]).astype(np.int32)),
                     pa.array(key[lo].view(np.int64)), pa.array(_digests(segs), pa.binary()),
                     pa.array(segs, pa.binary())], ["k1", "k2", "pos", "key", "digest", "seg"])
    return run


OCCURRENCES = "k1 long, k2 long, pos int, key long, digest binary, seg binary"


def occurrences(keyed: DataFrame, s: Scheme, by_row: bool) -> DataFrame:
    """Candidate segments of every row.  An anchor is kept if it occurs under two
    values of k1 (``by_row``), else if it occurs twice."""
    anchors = cut(keyed.select("k1", "k2", "text").mapInArrow(frugal(_anchor_rows(s)), "h long, k1 long, k2 long, c int"), "anchors")
    if by_row:
        kept = anchors.groupBy("h").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).where("lo <> hi").select("h")
    else:
        kept = anchors.groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h")
    hashes = anchors.select("h", "k1", "k2").join(kept, "h").groupBy("k1", "k2").agg(F.collect_set("h").alias("hashes"))
    found = keyed.select("k1", "k2", "text").join(hashes, ["k1", "k2"]).mapInArrow(frugal(_segment_rows(s)), OCCURRENCES)
    return cut(found, "segments")


COMBINE_BYTES = 32 << 20


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal segments of a task as one row, before the shuffle."""
    held: dict[bytes, list] = {}
    size = 0

    def out() -> pa.RecordBatch:
        cols = list(zip(*held.values(), strict=True))
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                                          ["digest", "key", "seg", "lo", "c"])
    for batch in batches:
        for digest, key, seg, lo, c in zip(*(batch.column(x).to_pylist() for x in ("digest", "key", "seg", "lo", "c")), strict=True):
            if (row := held.get(digest)) is None:
                held[digest] = [key, seg, lo, c]
                size += len(seg)
            else:
                row[2] = min(row[2], lo)
                row[3] += c
        if size > COMBINE_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


#: distinct segments of one key that go to one index; the windows of a fuller key are
#: dealt anew by longer grams
KEY_SEGMENTS = 2048
DECIDED = "digest binary, answer binary"


def _finer_rows(s: Scheme, gram: int):
    """The windows of each segment as segments of their own, keyed by the least
    ``gram``-unit hash of a window: what agrees in it shares at least ``gram`` units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("seg"))
            for a, b in slices(offs, 1 << 17):
                h, first, buf, at = units(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], s.unit)
                _, key, inside = _least(h, first, s.length, gram)
                lo, hi = _pieces(inside[:len(key)], key, first, s.longest)
                segs, row = _cut_out(buf, at, lo, hi + s.length - 1), np.searchsorted(first, lo, side="right") - 1
                take = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("digest").take(take), pa.array((lo - first[row]).astype(np.int32)), pa.array(key[lo].view(np.int64)),
                     pa.array(_digests(segs), pa.binary()), pa.array(segs, pa.binary()), batch.column("lo").take(take), batch.column("c").take(take)],
                    ["parent", "pos", "key", "digest", "seg", "lo", "c"])
    return run


def _joined_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One answer for a segment from those of its parts."""
    for batch in batches:
        out = [np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 3) + [p, 0, 0] for p, x in parts]).astype("<i8").tobytes()
               for parts in span_lists(batch.column("parts"))]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out, pa.binary())], ["digest", "answer"])


def decide(found: DataFrame, index: Callable, chunk_units: int, s: Scheme) -> DataFrame:
    """``index(segs, lo, c, keys)`` -> one answer (bytes) for each distinct segment:
    int64 triples (first window, windows, value), which start at the segment's first window.

    Equal segments are combined in each task and then dealt by key; a task hands
    whole keys to the index, as many as fit ``chunk_units`` bytes.  A key of more than
    ``KEY_SEGMENTS`` distinct segments is split: their windows are dealt anew by the least
    hash of grams of 7/8 of a window, then of whole windows.  Equal windows still meet, and
    the index decides them all; under a whole window's key there are only copies of it."""
    rows = found.select("digest", "key", "seg", F.col("k1").alias("lo"), F.lit(1).cast("long").alias("c"))
    return _decide(rows, index, chunk_units, s, [max(1, s.length * 7 // 8), s.length])


def _decide(rows: DataFrame, index: Callable, chunk_units: int, s: Scheme, grams: list[int]) -> DataFrame:
    combined = "digest binary, key long, seg binary, lo long, c long"
    full = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > KEY_SEGMENTS).select("key")
    full = cut(full, "full-keys")
    if full.isEmpty():
        return _decide_keys(rows.mapInArrow(frugal(_combined), combined), index, chunk_units)
    # segments of these keys, repeats gone whatever the number of tasks
    distinct = cut(rows.join(full, "key", "left_semi").select(*rows.columns).mapInArrow(frugal(_combined), combined)
                   .groupBy("digest").agg(F.first("key").alias("key"), F.first("seg").alias("seg"), F.min("lo").alias("lo"), F.sum("c").alias("c")), "full")
    rest = rows.join(full, "key", "left_anti").select(*rows.columns).mapInArrow(frugal(_combined), combined)
    if not grams:
        return _decide_keys(rest.unionByName(distinct), index, chunk_units)
    crowded = cut(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > KEY_SEGMENTS).select("key"), "crowded-keys")
    plain = _decide_keys(rest.unionByName(distinct.join(crowded, "key", "left_anti")), index, chunk_units)
    if crowded.isEmpty():
        return plain
    parts = cut(distinct.join(crowded, "key", "left_semi").mapInArrow(
        frugal(_finer_rows(s, grams[0])), "parent binary, pos int, key long, digest binary, seg binary, lo long, c long"), "parts")
    answers = _decide(parts.select(*rows.columns), index, chunk_units, s, grams[1:])
    whole = (parts.select("parent", "pos", "digest").join(answers.where("length(answer) > 0"), "digest")
             .groupBy(F.col("parent").alias("digest")).agg(F.collect_list(F.struct("pos", "answer")).alias("parts"))
             .mapInArrow(_joined_answers, DECIDED))
    return plain.unionByName(whole)


def _decide_keys(combined: DataFrame, index: Callable, chunk_units: int) -> DataFrame:
    dealt = combined.repartition("key").sortWithinPartitions("key", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        size = 0

        def flush() -> pa.RecordBatch:
            out = index([x[2] for x in held], np.array([x[3] for x in held], np.int64), np.array([x[4] for x in held], np.int64), [x[1] for x in held])
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.binary()), pa.array(out, pa.binary())], ["digest", "answer"])
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("digest", "key", "seg", "lo", "c")), strict=True):
                if held and held[-1][0] == row[0]:
                    held[-1][3] = min(held[-1][3], row[3])
                    held[-1][4] += row[4]
                    continue
                if held and row[1] != held[-1][1] and size >= chunk_units:
                    yield flush()
                    held, size = [], 0
                held.append(list(row))
                size += len(row[2])
        if held:
            yield flush()
    return dealt.mapInArrow(frugal(run), DECIDED)


def per_row(found: DataFrame, answers: DataFrame) -> DataFrame:
    """(k1, k2, spans): for each row its segments' starts and answers."""
    return (found.select("k1", "k2", "pos", "digest").join(answers.where("length(answer) > 0"), "digest")
            .groupBy("k1", "k2").agg(F.collect_set(F.struct("pos", "answer")).alias("spans")))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Units of a row of ``n`` that lie in any of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def span_lists(column) -> list[list[tuple[int, bytes]]]:
    return [[(x["pos"], x["answer"]) for x in r] if r else [] for r in column.to_pylist()]


__all__ = ["Scheme", "units", "occurrences", "decide", "per_row", "covered", "span_lists", "runs"]
