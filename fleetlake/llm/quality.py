"""Quality classifier: random-indexing word vectors, pooled per document, under a
two-layer network with calibrated probabilities.

Word vectors.  Tokens are runs of letters, digits and non-ASCII bytes, or runs of
punctuation, hashed to ``BUCKETS`` rows.  Every bucket owns a sparse random index
vector (a few +-1 entries given by its number); a bucket's word vector is the sum
of the index vectors of its neighbours, within two tokens, over the whole corpus.
Tasks add up tables of fixed size, and the tables are added by salted groups, so
what reaches the driver is one table whatever the corpus.

Document vectors pool the word vectors over all tokens (frequent words weigh
less) and over distinct tokens, beside the log length and the share of distinct
tokens.

Network.  Trained with numpy on at most ``TRAIN_DOCS`` labelled documents (a
documented bound; those with the least hash of their id, never of the held-out
fifth), one part of which fits the temperature.  The score is the calibrated
probability of label 1.

Cases: null and empty texts have the zero vector and get its score; a null id is
never labelled and not held out; documents labelled twice count as 1 if half
their labels are 1; of rows that share a labelled id the network is fitted on the one
whose text has the least hash, and all are scored; null labels are ignored; with labels of fewer than two kinds
the score is that label's share (0.5 without labels).  No column but the text
enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import U64, flat, mix, slices, table, word_hashes

BUCKETS = 4096
DIM = 48
ENTRIES = 4
REACH = 2
BLOCK = 128          # buckets of a row while tables are added up
SALTS = 32
TRAIN_DOCS = 20_000
HIDDEN = 32
EPOCHS = 40
FEATURES = 2 * DIM + 2
_KIND = np.ones(256, np.int8)            # 0 space, 1 word, 2 punctuation
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[[i for i in range(128) if not chr(i).isalnum() and i not in (32, 9, 10, 11, 12, 13)]] = 2


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, first token of each row)."""
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offs] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    ink = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[ink], ends[ink]
    return (word_hashes(data, starts, ends) % U64(BUCKETS)).astype(np.int64), np.searchsorted(starts, offs)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of every bucket's random index vector."""
    h = mix(np.arange(1, BUCKETS * ENTRIES + 1, dtype=np.uint64) * U64(0xC2B2AE3D27D4EB4F)).reshape(BUCKETS, ENTRIES)
    return (h % U64(DIM)).astype(np.int64), np.where((h >> U64(40)) & U64(1), 1, -1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    where, sign = index_vectors()
    total, seen = np.zeros(BUCKETS * DIM, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, offs = flat(batch.column("text"))
        for a, b in slices(offs, 1 << 20):
            bucket, first = tokens(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
            seen += np.bincount(bucket, minlength=BUCKETS)
            row = np.repeat(np.arange(b - a), np.diff(first))
            for gap in range(1, REACH + 1):
                same = np.flatnonzero(row[gap:] == row[:-gap]) if len(row) > gap else np.zeros(0, np.int64)
                left, right = bucket[same], bucket[same + gap]
                for e in range(ENTRIES):
                    for x, y in ((left, right), (right, left)):
                        total += np.bincount(x * DIM + where[y, e], weights=sign[y, e], minlength=BUCKETS * DIM).astype(np.int64)
    if not seen.any():
        return
    both = np.concatenate((total.reshape(BUCKETS, DIM), seen[:, None]), axis=1).reshape(-1, BLOCK * (DIM + 1))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both), dtype=np.int32)), pa.array(np.full(len(both), TaskContext.get().partitionId() % SALTS, np.int32)),
                                      pa.array([x.astype("<i8").tobytes() for x in both], pa.binary())], ["block", "salt", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for block, salt, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            x = np.frombuffer(raw, "<i8")
            key = (block, salt)
            sums[key] = sums[key] + x if key in sums else x
    if sums:
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array([sums[k].tobytes() for k in keys], pa.binary())], ["block", "salt", "sums"])


SUMS = "block int, salt int, sums binary"


def word_vectors(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(unit word vectors, token counts) by bucket, from every text."""
    parts = texts.mapInArrow(_counts, SUMS)
    salted = parts.repartition("block", "salt").mapInArrow(_add, SUMS)
    whole = salted.withColumn("salt", F.lit(0)).repartition("block").mapInArrow(_add, SUMS)
    sums = np.zeros((BUCKETS // BLOCK, BLOCK * (DIM + 1)))
    for r in whole.collect():  # BUCKETS / BLOCK rows
        sums[r["block"]] += np.frombuffer(bytes(r["sums"]), "<i8")
    sums = sums.reshape(BUCKETS, DIM + 1)
    vec, seen = sums[:, :DIM], sums[:, DIM]
    vec = vec - (vec.sum(axis=0) / max(1.0, seen.sum())) * seen[:, None]
    norm = np.linalg.norm(vec, axis=1, keepdims=True)
    return (vec / np.where(norm > 0, norm, 1)).astype(np.float32), seen


@dataclass
class Pooling:
    vectors: np.ndarray
    weight: np.ndarray

    @classmethod
    def fit(cls, texts: DataFrame) -> Pooling:
        vec, seen = word_vectors(texts)
        share = seen / max(1.0, seen.sum())
        return cls(vec, (1e-3 / (1e-3 + share)).astype(np.float32))

    def features(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        bucket, first = tokens(data, offs)
        n = np.diff(first)
        row = np.repeat(np.arange(len(n)), n)
        key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
        doc, bucket = key // BUCKETS, key % BUCKETS
        out = np.zeros((len(n), FEATURES), np.float32)
        some = np.flatnonzero(n)
        if not len(some):
            return out
        at = np.searchsorted(doc, some)
        w = self.weight[bucket]
        v = self.vectors[bucket]
        for k, weight in enumerate((w * count, w)):
            total = np.add.reduceat(weight, at)
            out[some, k * DIM:(k + 1) * DIM] = np.add.reduceat(v * weight[:, None], at, axis=0) / total[:, None]
        out[some, -2] = np.log1p(n[some])
        out[some, -1] = np.diff(np.append(at, len(doc))) / n[some]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)

    @classmethod
    def train(cls, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network:
        """Adam on the rows outside ``calibrate``; the temperature on those inside."""
        rng = np.random.default_rng(7)
        x, y = x.astype(np.float64), y.astype(np.float64)
        fit = ~calibrate if 0 < calibrate.sum() < len(y) else np.ones(len(y), bool)
        mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
        z = (x[fit] - mean) / scale
        t = y[fit]
        p = [rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for a in range(0, len(z), 256):
                i = order[a:a + 256]
                h = z[i] @ p[0] + p[1]
                r = np.maximum(h, 0)
                d = (_sigmoid(r @ p[2] + p[3][0]) - t[i]) / len(i)
                back = np.outer(d, p[2]) * (h > 0)
                grads = [z[i].T @ back + 1e-4 * p[0], back.sum(axis=0), r.T @ d + 1e-4 * p[2], np.array([d.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    p[k] -= 0.003 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        net = cls(mean, scale, p[0], p[1], p[2], float(p[3][0]))
        if not fit.all():
            z, t = net.logits(x[~fit]), y[~fit]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
            net.temperature = float(min(grid, key=lambda k: np.mean(np.logaddexp(0, z / k) - t * z / k)))
        return net


@dataclass
class Constant:
    """In place of a network when the labels are of one kind or missing."""
    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def _feature_rows(pooling: Pooling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            for a, b in slices(offs, 1 << 19):
                x = pooling.features(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in ("doc_id", "h", "y", "part")),
                                                  pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "h", "y", "part", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bound: int = TRAIN_DOCS):
    """(pooling, network) from all texts and at most ``bound`` labelled documents."""
    pooling = Pooling.fit(docs.select(F.col("text").cast("string").alias("text")))
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL")
             .where(part != 0).groupBy("doc_id").agg(F.when(F.avg("y") >= 0.5, 1).otherwise(0).alias("y")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)  # at most ``bound`` rows of two numbers
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("doc_id", F.xxhash64("text").alias("h"), "text", "y", part.cast("int").alias("part"))
            .mapInArrow(_feature_rows(pooling), "doc_id long, h long, y int, part int, x binary"))
    # an id held by many rows is one of them, chosen by its text; combined in the tasks
    got = rows.groupBy("doc_id").agg(F.min_by(F.struct("y", "part", "x"), "h").alias("row")).select("row.*").collect()
    if not got:
        return pooling, Constant(0.5)
    y = np.array([r["y"] for r in got])
    if y.min() == y.max():
        return pooling, Constant(float(y[0]))
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float32) for r in got])
    order = np.lexsort((*x[:, :4].T, y))  # the same order whatever the partitions
    return pooling, Network.train(x[order], y[order], np.array([r["part"] for r in got])[order] == 1)


def score(docs: DataFrame, pooling: Pooling, network, name: str = "_score") -> DataFrame:
    """The table with one more column, the score; no shuffle."""
    from pyspark.sql.types import DoubleType, StructField, StructType
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column(at))
            parts = [network.score(pooling.features(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a])) for a, b in slices(offs, 1 << 19)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *parts]), pa.float64())], [*names, name])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents whose score reaches ``least``, with all their columns."""
    pooling, network = fit(docs, labels)
    name = "__llm_score"
    return score(docs, pooling, network, name).where(F.col(name) >= least).drop(name)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pooling, network = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return (score(docs.select("doc_id", "text"), pooling, network)
            .select("doc_id", held.alias("held_out"), F.col("_score").alias("score"), F.when(F.col("_score") >= 0.3, 1).otherwise(0).alias("predicted")))
