"""Hard negatives by exact integer products of anchor and candidate tiles.

Components become integers (``floor(scale * x)``).  Anchors are dealt to blocks of
bounded size; a block is broadcast and the candidates are read past it where they
lie, so neither side is copied or shuffled.  A tile of anchors and candidates is
multiplied by Strassen's recursion on int64, halves padded with zeros to even
sizes; its sums and products are exact modulo 2**64, and a tile whose scores could
pass 63 bits is multiplied in Python integers instead, so every score is exact.

1. *Positives.*  A heap per anchor keeps its best rows of the same label; the
   tasks' heaps are merged.
2. *Windows.*  With the positives known, a heap per (anchor, positive) keeps the
   best rows of other labels whose score lies in the positive's window; the tasks'
   heaps are merged again.

What travels is a task's heaps: a few rows for each anchor, whatever the number of
candidates.  A block costs two reads of the candidates.

Cases: rows without an id or a label, and rows whose vector is null or holds a null
or non-finite component, take no part; vectors meet only vectors of the same number
of components (two empty ones score 0); rows that hold an anchor's id are no
partners of it, other repeated rows are separate rows; an anchor row that occurs
twice is asked once; equal scores rank by the smaller id; an anchor without
positives, a positive without negatives and an empty table give no rows; a score
beyond 63 bits that would have to be returned fails the job (``OverflowError``).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import cut, table
from fleetlake.session import scratch_path

#: most bytes of the vectors of one broadcast block of anchors
BLOCK_BYTES = 32 << 20
TILE = 1024
#: the recursion ends where a side has so many rows or columns
LEAF = 16
LOWEST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, modulo 2**64, with seven products for eight."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as int64, or as Python integers where that is too narrow."""
    with np.errstate(over="ignore"):
        f = np.floor(x * scale)
    if not f.size or np.abs(f).max() < 2.0**52:
        return f.astype(np.int64)
    # from 2**52 on a double is an integer itself, and the product must not round
    exact = [int(v) * scale if abs(v) >= 2.0**52 else math.floor(v * scale) if scale & (scale - 1) == 0 else (lambda p, q: p * scale // q)(*v.as_integer_ratio())
             for v in x.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b``, exact."""
    top = [int(max(abs(v.max()), abs(v.min()))) if v.size else 0 for v in (a, b)]
    if top[0] * top[1] * max(1, a.shape[1]) < 1 << 62:
        return strassen(a.astype(np.int64), np.ascontiguousarray(b.T.astype(np.int64)))
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    return a.astype(object) @ b.T.astype(object)


class Heaps:
    """The ``k`` best (score, then smaller id) of each of ``n`` lists."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.worst = np.full(n, LOWEST, np.int64)

    def offer(self, first: int, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Rows of ``scores`` belong to the lists from ``first`` on; columns to ``ids``, ascending."""
        if scores.dtype != object:
            floor = self.worst[first:first + len(scores)]
            if len(ids) > self.k:
                masked = np.where(allowed, scores, LOWEST)
                floor = np.maximum(floor, np.partition(masked, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            equal = allowed & (scores == floor[:, None])
            # of a row's equal scores only the first ids can enter: copies of one vector cost no heap steps
            equal &= equal.cumsum(axis=1, dtype=np.int32) <= self.k
            allowed = allowed & (scores > floor[:, None]) | equal
        rows, cols = np.nonzero(allowed)
        for i, s, v in zip((first + rows).tolist(), scores[rows, cols].tolist(), ids[cols].tolist(), strict=True):
            heap = self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, (s, -v))
            elif (s, -v) > heap[0]:
                heapq.heapreplace(heap, (s, -v))
        for i in np.unique(first + rows).tolist():
            if len(self.heaps[i]) == self.k:
                self.worst[i] = min(max(self.heaps[i][0][0], LOWEST), -LOWEST - 1)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """(list, id, score)"""
        return ((i, -v, s) for i, heap in enumerate(self.heaps) for s, v in heap)


class Anchors:
    """One block: per number of components the ids, labels and integer vectors, numbered throughout."""

    def __init__(self, rows: list, scale: int):
        self.groups, self.ids, by_size = {}, [], {}
        for row in rows:
            by_size.setdefault(len(row["v"]), []).append(row)
        for size, own in sorted(by_size.items()):
            vectors = integers(np.array([r["v"] for r in own], np.float64).reshape(len(own), size), scale)
            self.groups[size] = (len(self.ids), np.array([r["vec_id"] for r in own], np.int64), [r["label"] for r in own], vectors)
            self.ids += [r["vec_id"] for r in own]


def tiles(anchors: Anchors, batches: Iterator[pa.RecordBatch], scale: int):
    """(number of the tile's first anchor, scores, same label, other id, candidate ids)"""
    for batch in batches:
        column = batch.column("v")
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            if size not in anchors.groups:
                continue
            start, own, labels, vectors = anchors.groups[size]
            at = np.flatnonzero(sizes == size)
            at = pa.array(at[np.argsort(batch.column("vec_id").to_numpy()[at], kind="stable")])
            ids = batch.column("vec_id").take(at).to_numpy()
            flat = column.take(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            met = integers(flat.reshape(len(ids), size), scale)
            kinds = pa.array(labels).dictionary_encode()
            code = kinds.indices.to_numpy()
            other = pc.fill_null(pc.index_in(batch.column("label").take(at), value_set=kinds.dictionary), -1).to_numpy()
            for c in range(0, len(ids), TILE):
                d = min(c + TILE, len(ids))
                for a in range(0, len(own), TILE):
                    b = min(a + TILE, len(own))
                    yield (start + a, products(vectors[a:b], met[c:d]), code[a:b, None] == other[None, c:d], own[a:b, None] != ids[None, c:d], ids[c:d])


def _emit(rows: Iterator[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _positives(shared, k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        best = Heaps(len(anchors.ids), k)
        for first, scores, same, other, ids in tiles(anchors, batches, scale):
            best.offer(first, scores, same & other, ids)
        yield _emit(best.rows(), ["anchor_no", "vec_id", "score"])
    return run


def _windows(shared, k: int, scale: int, low: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, places = shared.value
        n, width = len(anchors.ids), max((len(p) for p in places), default=0)
        held = [Heaps(n, k) for _ in range(width)]
        # integer bounds of each window; an absent positive has an empty one
        top = np.array([[p[j][1] if j < len(p) else -1 for p in places] for j in range(width)], dtype=object).reshape(width, n)
        bottom = np.array([[-(-low[0] * p[j][1] // low[1]) if j < len(p) else 0 for p in places] for j in range(width)], dtype=object).reshape(width, n)
        narrow = all(abs(v) < 1 << 63 for v in (*top.ravel(), *bottom.ravel()))
        bounds = (bottom.astype(np.int64), top.astype(np.int64)) if narrow else (bottom, top)
        for first, scores, same, other, ids in tiles(anchors, batches, scale):
            unlike, m = ~same & other, len(scores)
            for j in range(width):
                lo, hi = (x[j, first:first + m, None] for x in bounds)
                held[j].offer(first, scores, unlike & (scores >= lo).astype(bool) & (scores <= hi).astype(bool), ids)
        yield _emit(((i, j, v, s) for j in range(width) for i, v, s in held[j].rows()), ["anchor_no", "place", "vec_id", "score"])
    return run


def _merge(rows: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    """The ``k`` best of each list; at most ``k`` rows of it come from one task."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def blocks_of(anchors: DataFrame, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """``anchors`` dealt to blocks by a hash of the row, none above ``block_bytes``, and their numbers."""
    total = anchors.agg(F.sum(F.size("v") * 8 + 16)).first()[0] or 0
    n = max(1, -(-2 * total // block_bytes))
    while True:
        dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(F.size("v") * 8 + 16).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        if all(s["bytes"] <= block_bytes or s["n"] == 1 for s in sizes):
            return dealt, sorted(s["block"] for s in sizes)
        n *= 2


def hard_negatives(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (4, 5), scale: int = 256,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    A negative's score lies between ``low`` (a ratio) of the positive's and the
    positive's own.  ``is_anchor`` is a condition on ``vec_id``, ``label`` and ``v``."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    sound = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    anchors, numbers = blocks_of(cut(sound.where(is_anchor).distinct(), "anchors"), block_bytes)
    path, schema = scratch_path(spark, "hard-negatives"), "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long"
    for number in numbers:
        # one block at a time: the driver and each task hold one, of bounded size
        block = Anchors(anchors.where(F.col("block") == number).orderBy("vec_id", "label", "v").collect(), scale)
        shared = spark.sparkContext.broadcast(block)
        near = _merge(sound.mapInArrow(_positives(shared, positives, scale), "anchor_no long, vec_id long, score long"), ["anchor_no"], positives, "place")
        places = [[] for _ in block.ids]
        for row in near.orderBy("anchor_no", "place").collect():
            places[row["anchor_no"]].append((row["vec_id"], row["score"]))
        windows = spark.sparkContext.broadcast((block, places))
        met = sound.mapInArrow(_windows(windows, negatives, scale, low), "anchor_no long, place long, vec_id long, score long")
        ranked = _merge(met, ["anchor_no", "place"], negatives, "rank")
        named = spark.createDataFrame([(i, j, block.ids[i], p, s) for i, own in enumerate(places) for j, (p, s) in enumerate(own)],
                                      "anchor_no long, place long, anchor_id long, positive_id long, positive_score long")
        (ranked.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, ["anchor_no", "place"])
         .select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("positive_rank"), "rank", "negative_id", "positive_score", "negative_score")
         .write.parquet(f"{path}/block={number}"))
        shared.destroy()
        windows.destroy()
    return spark.read.schema(schema).parquet(path).drop("block") if numbers else spark.createDataFrame([], schema)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(rows.select("vec_id", "embedding", shifted.alias("label")), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP11_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.q, c.q)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM sound WHERE vec_id % 100 = 0) a JOIN sound c ON len(a.q) = len(c.q) AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same),
windows AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
  WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""
