"""Benchmark decontamination with a BM25 inverted index of the test items.

Index: items are documents, their distinct words are terms, and a posting holds
the term's BM25 impact divided by the item's own total, so that 1 is the score
of an item's own words.  Items lie in blocks of ``BLOCK_ITEMS``, ordered by
length; the index keeps each term's largest impact over all items and over each
block that holds it.  Shards have at most ``SHARD_ITEMS`` items and close at
``SHARD_WORDS`` words; the shards that fit ``BROADCAST_BYTES`` together (one at least)
travel to the tasks in one pass over the corpus.  A larger benchmark takes more passes,
one after the other: a pass's result is written before the next one's shards are read.

Query: every document is cut into overlapping passages, three times as long as
the shard's longest item, one item length apart, so that a copy spread over up to
twice its item's words lies whole in some passage.  Block-max WAND, for many
passages at once: the sum of a passage's term maxima must reach the threshold,
then the sum of its block maxima, and only the blocks that remain are scored item
by item.  All items at or above the threshold are retrieved, no top-k.  Each item
has its own threshold, the least score that a hit leaves it (``_floor``), so that
retrieval loses none; postings are divided by it.

Verification: the five-word shingles of the retrieved item, its question and its
answer are looked up in the passage.  A hit holds 0.8 of the question's and 0.8 of
the answer's, wherever in the passage the two stand, or 0.8 of the whole item's,
which run across the seam (a question that is small beside its answer may then be
missing, or the other way round).  The answer is the last sentence, or the last third
of an item of one sentence, and one of fewer than ten words is compared by single
words (a mark stuck to its last word must not hide it).  Words are runs of non-space
bytes, A-Z lower-cased.

Cases: null or wordless items are not indexed; null texts have no passages; an
item or part of fewer than five words is one shingle, its whole sequence;
repeated items are separate items; repeated documents give repeated hits; a
null document id is kept; empty tables give no hits.  Other columns are ignored.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import LOWER, cut, flat, gram_hashes, slices, table, word_bounds, word_hashes

K1, B = 1.2, 0.75
BLOCK_ITEMS = 16
SHARD_ITEMS = 512
SHARD_WORDS = 1 << 18
BROADCAST_BYTES = 64 << 20
PASSAGE = 3
SHINGLE = 5
ENOUGH = 0.8
INDEX = "shard int, at long, blob binary"
HITS = "doc_id long, item_id long, bm25 double, overlap double, question_overlap double, answer_overlap double"


def split_item(text: str) -> tuple[str, str]:
    """(question, answer)."""
    parts = [x for x in re.split(r"(?<=[.!?])[\x20\x09-\x0D]+", text.strip(" \t\n\v\f\r")) if x]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    cut = max(1, len(words) - max(1, len(words) // 3))
    return " ".join(words[:cut]), " ".join(words[cut:])


def _words(text: str) -> np.ndarray:
    raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]))
    return word_hashes(raw, starts, ends)


def _lost(words: np.ndarray, k: int, vocab: np.ndarray, weight: np.ndarray) -> float:
    """The most that the words of a part can weigh of which a text lacks every shingle of
    ``k`` words, if it holds ``ENOUGH`` of the part's shingles.  ``weight``: of ``vocab``.

    A word can be missing only if all shingles that hold it are, and each missing
    shingle counts for at most ``k`` words; so what the missing words weigh is at
    most what a fractional knapsack of ``k`` times the spare shingles takes."""
    if not len(words):
        return 0.0
    own, term = np.unique(words, return_inverse=True)
    sets, gram = np.unique(gram_hashes(words, k), return_inverse=True)
    at = np.arange(len(gram))[:, None] + np.arange(k)
    held = np.unique(term[at] * len(sets) + gram[:, None])
    cost = np.bincount(held // len(sets), minlength=len(own))
    worth = weight[np.searchsorted(vocab, own)]
    order = np.argsort(-worth / cost, kind="stable")
    return float(np.interp(k * (len(sets) // 5), np.append(0, np.cumsum(cost[order])), np.append(0, np.cumsum(worth[order]))))


def _floor(words: np.ndarray, question: np.ndarray, answer: np.ndarray, vocab: np.ndarray, weight: np.ndarray) -> float:
    """The least part of an item's score that a hit has.  ``weight``: of the item's
    distinct words ``vocab``, 1 in all."""
    whole = _lost(words, _shingle("whole", len(words)), vocab, weight)
    parts = sum(_lost(x, _shingle(name, len(x)), vocab, weight) for name, x in (("question", question), ("answer", answer)))
    return max(1 - max(whole, parts), float(weight.min())) * (1 - 1e-4)  # postings are of single precision


class Shard:
    """Inverted index of at most ``SHARD_ITEMS`` items."""

    def __init__(self, d):
        self.__dict__.update({k: d[k] for k in d.keys()})  # noqa: SIM118
        self.length = int(self.length)
        self.vocab_blocks = [(self.block_at[i], self.block_at[i + 1]) for i in range(len(self.block_at) - 1)]

    @staticmethod
    def build(items: list[tuple[int | None, np.ndarray, np.ndarray, np.ndarray]], idf_of, average: float) -> bytes:
        """``items``: (id, words, question words, answer words), ordered by length."""
        vocab = np.unique(np.concatenate([w for _, w, _, _ in items]))
        floor, terms, weights = np.zeros(len(items)), [], []
        for i, (_, w, question, answer) in enumerate(items):
            own, tf = np.unique(w, return_counts=True)
            weight = idf_of(own) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / average))
            weight = weight / weight.sum()
            floor[i] = _floor(w, question, answer, own, weight)
            terms.append(np.searchsorted(vocab, own))
            weights.append((weight / floor[i]).astype(np.float32))
        at = np.arange(0, len(items) + BLOCK_ITEMS, BLOCK_ITEMS).clip(max=len(items))
        at = at[: np.searchsorted(at, len(items)) + 1]
        doc, term = np.repeat(np.arange(len(items)), [len(x) for x in terms]), np.concatenate(terms)
        order = np.lexsort((doc, term))
        doc, term, impact = doc[order], term[order], np.concatenate(weights)[order]
        post_at = np.searchsorted(term, np.arange(len(vocab) + 1))
        # a term's blocks lie side by side, as its items do
        cell = np.flatnonzero(np.diff(term * len(items) + doc // BLOCK_ITEMS, prepend=-1))
        shingles = {}
        for name, k in (("whole", 1), ("question", 2), ("answer", 3)):
            size = [_shingle(name, len(x[k])) for x in items]
            sets = [_grams(x[k], n) for x, n in zip(items, size, strict=True)]
            shingles[name] = np.concatenate(sets)
            shingles[name + "_at"] = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            shingles[name + "_n"] = np.array(size)
        out = io.BytesIO()
        np.savez(out, ids=np.array([-1 if x[0] is None else x[0] for x in items], np.int64), no_id=np.array([x[0] is None for x in items]),
                 vocab=vocab, floor=floor, length=max(len(x[1]) for x in items), block_at=at,
                 post_at=post_at, post_item=doc, post_weight=impact, term_max=np.maximum.reduceat(impact, post_at[:-1]),
                 cell_at=np.searchsorted(term[cell], np.arange(len(vocab) + 1)), cell_block=doc[cell] // BLOCK_ITEMS,
                 cell_max=np.maximum.reduceat(impact, cell), **shingles)
        return out.getvalue()

    def retrieve(self, words: np.ndarray, doc_first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first word, end word, row, item, score) of all passages and items at or
        above the threshold."""
        near = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        held = np.flatnonzero(self.vocab[near] == words)
        term = near[held]
        n = np.diff(doc_first)
        count = np.maximum(1, -(-n // self.length) - PASSAGE + 1) * (n > 0)
        row = np.repeat(np.arange(len(n)), count)
        start = doc_first[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * self.length
        end = np.minimum(start + PASSAGE * self.length, doc_first[1:][row])
        lo, hi = np.searchsorted(held, start), np.searchsorted(held, end)
        size = hi - lo
        # pivot test: repeated words only raise this sum, so it stays an upper bound
        heavy = np.concatenate(([0], np.cumsum(self.term_max[term].astype(np.float64))))
        keep = np.flatnonzero(heavy[hi] - heavy[lo] >= 1)
        row, start, end, lo, size = row[keep], start[keep], end[keep], lo[keep], size[keep]
        none = np.zeros(0, np.int64)
        if not len(keep):
            return none, none, none, none, np.zeros(0)
        passage = np.repeat(np.arange(len(keep)), size)
        took = term[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)]
        pair = np.unique(passage * len(self.vocab) + took)  # each distinct word once
        passage, took = pair // len(self.vocab), pair % len(self.vocab)
        blocks = len(self.vocab_blocks)
        which, entry = _entries(passage, self.cell_at, took)
        bound = np.bincount(which * blocks + self.cell_block[entry], weights=self.cell_max[entry], minlength=len(keep) * blocks)
        which, block = np.nonzero(bound.reshape(-1, blocks) >= 1)
        if not len(which):
            return none, none, none, none, np.zeros(0)
        # exact scores of the surviving blocks from the postings
        alive = np.unique(which)
        slot = np.full(len(keep), -1)
        slot[alive] = np.arange(len(alive))
        some = slot[passage] >= 0
        passage, post = _entries(slot[passage[some]], self.post_at, took[some])
        cell = passage * len(self.ids) + self.post_item[post]
        total = np.bincount(cell, weights=self.post_weight[post], minlength=len(alive) * len(self.ids)).reshape(len(alive), -1)
        live = np.zeros((len(alive), blocks), bool)
        live[slot[which], block] = True
        total[~np.repeat(live, np.diff(self.block_at), axis=1)] = 0
        p, item = np.nonzero(total >= 1)
        return start[alive[p]], end[alive[p]], row[alive[p]], item, total[p, item] * self.floor[item]


def _entries(passage: np.ndarray, at: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, entry) of every entry of each passage's term in lists that start at ``at``."""
    n = at[term + 1] - at[term]
    return np.repeat(passage, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[term], n)


def _shingle(name: str, n: int) -> int:
    """Words of a shingle in a part of ``n`` words."""
    return 1 if name == "answer" and n < 2 * SHINGLE else min(n, SHINGLE)


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    return np.unique(gram_hashes(words, k)) if len(words) else np.zeros(0, np.uint64)


def _overlap(shard: Shard, name: str, item: int, words: np.ndarray, grams: dict[int, np.ndarray]) -> float:
    own = getattr(shard, name)[getattr(shard, name + "_at")[item]:getattr(shard, name + "_at")[item + 1]]
    if not len(own):
        return 1.0
    k = int(getattr(shard, name + "_n")[item])
    if k not in grams:
        grams[k] = np.unique(gram_hashes(words, k))
    return float(np.isin(own, grams[k]).mean())


class Matcher:
    """The index shards of one pass, opened once per task."""

    def __init__(self, blobs: list[bytes]):
        self.blobs, self.shards = blobs, []

    def hits(self, text) -> Iterator[tuple]:
        """(row, item id, bm25, overlaps of the whole, question and answer) of a column."""
        if not self.shards:
            self.shards = [Shard(np.load(io.BytesIO(b))) for b in self.blobs]
        data, offs = flat(text)
        for a, b in slices(offs, 1 << 20):
            low = LOWER[data[offs[a]:offs[b]]]
            starts, ends, first = word_bounds(low, offs[a:b + 1] - offs[a])
            words, best = word_hashes(low, starts, ends), {}
            for number, shard in enumerate(self.shards if len(words) else ()):
                last, grams = None, {}
                for s, e, r, item, total in zip(*(x.tolist() for x in shard.retrieve(words, first)), strict=True):
                    if (s, e) != last:
                        last, grams = (s, e), {}
                    got = tuple(_overlap(shard, x, item, words[s:e], grams) for x in ("whole", "question", "answer"))
                    if got[0] >= ENOUGH or min(got[1:]) >= ENOUGH:
                        best[r, number, item] = max(best.get((r, number, item), (got, total)), (got, total))
            for (r, number, item), (got, total) in sorted(best.items()):
                shard = self.shards[number]
                yield r + a, None if shard.no_id[item] else int(shard.ids[item]), total, *got

    def __getstate__(self):
        return {"blobs": self.blobs, "shards": []}


def _hit_rows(match: Matcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(match.hits(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array([x[0] for x in rows], pa.int64())), pa.array([x[1] for x in rows], pa.int64()),
                                              *(pa.array([x[k] for x in rows], pa.float64()) for k in range(2, 6))],
                                             ["doc_id", "item_id", "bm25", "overlap", "question_overlap", "answer_overlap"])
    return run


def _clean_rows(match: Matcher, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[x[0] for x in match.hits(batch.column(at))]] = False
            yield batch.filter(pa.array(keep))
    return run


def build_index(benchmark: DataFrame) -> DataFrame:
    """The index shards as rows (partition, number of the item behind the last,
    bytes): items grouped by length, statistics over all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.length(F.trim("text")) > 0)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_words(x) for x in batch.column("text").to_pylist()]
            term = [np.unique(w).view(np.int64) for w in words]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), pa.array([len(w) for w in words], pa.int64()),
                                              pa.array([t.tolist() for t in term], pa.list_(pa.int64()))], ["item_id", "text", "n", "terms"])
    worded = items.mapInArrow(terms, "item_id long, text string, n long, terms array<long>").where("n > 0")
    total = worded.agg(F.count(F.lit(1)).alias("n"), F.avg("n").alias("mean")).first()
    if not total["n"]:
        return benchmark.sparkSession.createDataFrame([], INDEX)
    n_items, average = total["n"], total["mean"]
    count = -(-n_items // SHARD_ITEMS)
    frequent = worded.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    with_df = (worded.withColumn("k", F.monotonically_increasing_id()).select("k", "item_id", "text", "n", F.explode("terms").alias("t")).join(frequent, "t")
               .groupBy("k").agg(F.first("item_id").alias("item_id"), F.first("text").alias("text"), F.first("n").alias("n"),
                                 F.collect_list("t").alias("t"), F.collect_list("df").alias("df")))
    dealt = with_df.repartitionByRange(count, "n", "k").withColumn("shard", F.spark_partition_id())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (r["n"], r["text"], r["item_id"] is None, r["item_id"] or 0))
        at = 0
        while at < len(rows):
            words = np.cumsum([r["n"] for r in rows[at:at + SHARD_ITEMS]])
            some = rows[at:at + max(1, int(np.searchsorted(words, SHARD_WORDS, side="right")))]
            at += len(some)
            df = {t: d for r in some for t, d in zip(r["t"], r["df"], strict=True)}
            idf = lambda term: np.array([np.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) for t in term.view(np.int64).tolist()])  # noqa: E731, B023
            made = Shard.build([(r["item_id"], _words(r["text"]), *map(_words, split_item(r["text"]))) for r in some], idf, average)
            yield pa.RecordBatch.from_arrays([pa.array([some[0]["shard"]], pa.int32()), pa.array([at], pa.int64()), pa.array([made], pa.binary())],
                                             ["shard", "at", "blob"])
    return dealt.select("item_id", "text", "n", "t", "df", "shard").mapInArrow(build, INDEX)


def passes(benchmark: DataFrame) -> list[DataFrame]:
    """The shards of each pass that the index needs: at most ``BROADCAST_BYTES`` or one shard."""
    index = cut(build_index(benchmark), "bm25")
    found: list[list[tuple[int, int]]] = []
    size = 0
    for r in index.select("shard", "at", F.length("blob").alias("size")).orderBy("shard", "at").collect():
        if not found or size + r["size"] > BROADCAST_BYTES:
            found.append([])
            size = 0
        found[-1].append((r["shard"], r["at"]))
        size += r["size"]
    place = F.struct("shard", "at")
    at = lambda x: F.struct(F.lit(x[0]).alias("shard"), F.lit(x[1]).cast("long").alias("at"))
    return [index.where(place.between(at(x[0]), at(x[-1]))) for x in found]


def matcher(shards: DataFrame) -> Matcher:
    """One pass's index, through the driver to the tasks."""
    return Matcher([bytes(r["blob"]) for r in shards.orderBy("shard", "at").collect()])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hits = docs.sparkSession.createDataFrame([], HITS)
    for shards in passes(benchmark):
        hits = hits.unionByName(cut(rows.mapInArrow(_hit_rows(matcher(shards)), HITS), "hits"))
    return hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; no shuffle.
    What a pass leaves is written for the next one; what the last leaves is not."""
    at, left = docs.columns.index(text_col), passes(benchmark)
    for number, shards in enumerate(left, 1):
        docs = docs.mapInArrow(_clean_rows(matcher(shards), at), docs.schema)
        if number < len(left):
            docs = cut(docs, "clean")
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
