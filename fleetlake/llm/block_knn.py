"""Exact nearest neighbours by a block matrix join.

Queries are dealt to blocks of bounded size and candidates to groups; each
(block, group) pair is one key, so a task holds one block of queries and streams
candidates past it.  A tile of queries and candidates is multiplied as int8
(products are summed exactly); the quantisation steps and 1-norms bound the
error of each product, so a pair is dropped only if it cannot reach the query's
k-th best so far.  Surviving pairs are recomputed in double precision on the
original components, in component order, and kept in one heap per query.  The
groups' heaps are merged by a window per query.

Cases: rows whose vector is null, empty, all zero or holds a null or non-finite
component, and rows without an id, take no part; vectors meet only vectors of
the same number of components; a query's own id is no candidate, so neither are
rows that repeat it; other repeated rows are separate candidates; equal scores
rank by the smaller id; a query row that occurs twice is asked once; a bound that
overflows rules nothing out, a product that overflows ranks as infinite and one that
is not a number as minus infinity; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import table

QUERY_BLOCK = 4096
GROUP_ROWS = 16384
TILE = 1024


def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their steps, and the 1-norms of the original rows."""
    top = np.abs(x).max(axis=1)
    step = np.where(top > 0, top / 127.0, 1.0)
    return np.clip(np.rint(x / step[:, None]), -127, 127).astype(np.int8), step, np.abs(x).sum(axis=1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in component order."""
    acc = np.zeros(len(a))
    for d in range(a.shape[1]):
        acc += a[:, d] * b[:, d]
    return acc


class Block:
    """One block of queries with a heap of the k best for each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, vectors, k
        q, self.step, norm = _quantise(vectors)
        self.wide = np.float32 if vectors.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.q = q.astype(self.wide)
        self.norm = norm
        self.heaps: list[list] = [[] for _ in ids]
        self.worst = np.full(len(ids), -np.inf)

    def _bounds(self, a: int, b: int, q: np.ndarray, step: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Approximate products of queries a to b with a tile, and how far off they can be."""
        near = (self.q[a:b] @ q.T).astype(np.float64) * self.step[a:b, None] * step
        # |<x,y> - near| <= step_x/2 |y~|_1 + step_y/2 |x|_1
        slack = 0.5 * self.step[a:b, None] * size + 0.5 * step * self.norm[a:b, None]
        return near, slack * (1 + 1e-9) + 1e-12 * np.abs(near)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        q, step, _ = _quantise(vectors)
        q = q.astype(self.wide)
        size = np.abs(q).sum(axis=1, dtype=np.float64) * step
        for a in range(0, len(self.ids), TILE):
            b = min(a + TILE, len(self.ids))
            with np.errstate(over="ignore", invalid="ignore"):
                near, slack = self._bounds(a, b, q, step, size)
            other = self.ids[a:b, None] != ids
            floor = self.worst[a:b]
            if len(ids) > self.k:
                with np.errstate(invalid="ignore"):
                    low = near - slack
                low = np.where(other & np.isfinite(low), low, -np.inf)
                floor = np.maximum(floor, np.partition(low, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            # a bound beyond the doubles rules nothing out
            with np.errstate(invalid="ignore", over="ignore"):
                qi, ci = np.nonzero(~(near + slack < floor[:, None]) & other)
                if not len(qi):
                    continue
                score = inner(self.x[a + qi], vectors[ci])
            score[np.isnan(score)] = -np.inf
            for i, s, v in zip((a + qi).tolist(), score.tolist(), ids[ci].tolist(), strict=True):
                heap = self.heaps[i]
                if len(heap) < self.k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))
            for i in np.unique(a + qi).tolist():
                if len(self.heaps[i]) == self.k:
                    self.worst[i] = self.heaps[i][0][0]

    def result(self) -> pa.RecordBatch:
        rows = [(int(q), -v, s) for q, heap in zip(self.ids, self.heaps, strict=True) for s, v in heap]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.float64())], ["query_id", "vec_id", "score"])


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64) if len(column) else np.zeros((0, 0))


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, ids, parts = None, None, [], []
        for batch in batches:
            tags = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "block", "part")), strict=True))
            asks = batch.column("candidate").to_numpy(zero_copy_only=False)
            edges = [0, *(i for i in range(1, len(tags)) if tags[i] != tags[i - 1] or asks[i] != asks[i - 1]), len(tags)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if tags[a] != key:
                    if block is not None:
                        yield block.result()
                    key, block, ids, parts = tags[a], None, [], []
                own, vectors = batch.column("vec_id").slice(a, b - a).to_numpy(), _matrix(batch.column("v").slice(a, b - a))
                if not asks[a]:
                    ids.append(own)
                    parts.append(vectors)
                    continue
                if block is None:
                    if not ids:
                        continue
                    block = Block(np.concatenate(ids), np.concatenate(parts), k)
                for at in range(0, len(own), TILE):
                    block.meet(own[at:at + TILE], vectors[at:at + TILE])
        if block is not None:
            yield block.result()
    return run


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query row."""
    v = F.col(vector_col).cast("array<double>")
    sound = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sound = sound.withColumn("dim", F.size("v"))
    asked = sound.where(is_query).distinct()
    # how many blocks and groups each vector length needs: one row per length
    per = sound.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(is_query, 1).otherwise(0)).alias("q")).where("q > 0")
    per = per.select("dim", F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("blocks"), F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("parts"))
    per = F.broadcast(per) if per.count() <= 10_000 else per
    queries = (asked.join(per, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("dim", "block", "part", F.lit(False).alias("candidate"), "vec_id", "v"))
    candidates = (sound.join(per, "dim").withColumn("part", F.pmod(F.xxhash64("v", "vec_id"), F.col("parts")).cast("int"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("dim", "block", "part", F.lit(True).alias("candidate"), "vec_id", "v"))
    met = (queries.unionByName(candidates).repartition("dim", "block", "part").sortWithinPartitions("dim", "block", "part", "candidate")
           .mapInArrow(_search(k), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP10_SQL = """
WITH sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v) AS score
  FROM (SELECT DISTINCT * FROM sound WHERE vec_id % 20 = 0) q JOIN sound c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
