"""Phrase collocations by level-wise mining with double-array tries.

Words are numbered only if they are frequent, and a phrase is a candidate only if
the phrases inside it are (the Apriori rule), so each level's candidates are safe.

1. *Words.*  Tasks count the words of their slices; the counts are summed for each
   language and word, and each language's total is summed with them.
2. *Stream.*  A broadcast trie of the frequent words turns every text into a stream
   of 32-bit word numbers, 0 between pieces and for other words.  All words of a
   slice walk the trie together, byte by byte.  Later passes read this stream.
3. *Candidates.*  Tasks propose the phrases of the level whose inner phrases are
   candidates, with their counts up to the threshold, which is all that is needed to
   keep those that reach it.
4. *Counts.*  The candidates go into broadcast tries over the word numbers' bytes;
   all positions of a slice start at the root and advance together, level by level;
   the accepting states are counted with ``bincount`` in each task, and the tasks'
   count vectors travel in chunks, without their zeros, and are added.  The two-word
   pass also marks the stream with the phrases found, from which the three-word
   candidates are proposed.
5. *Scores* are joins of these tables with exact 38-digit decimals.

A trie holds at most ``TRIE_KEYS`` keys (the driver collects and builds one at a
time) and a pass broadcasts at most ``PASS_TRIES`` or ``PASS_BYTES``; more candidates take more passes
over the stream (over the texts, for words).  A pass's counts are added up before the
next one, and the stream that it marked goes once the next one has marked it.  Counts are combined in each task
before they travel, so a word or phrase that fills a third of the corpus is one row
for each task.

Cases: a null text is empty; a null language is ``und`` and counts with rows that say
so; only A-Z are lower-cased; texts without words add nothing; repeated rows count
each time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import LOWER, cut, flat, frugal, slices, table, word_bounds
from fleetlake.llm.double_array import DoubleArray
from fleetlake.sinks.log import delete

TRIE_KEYS = 1 << 19
PASS_TRIES = 4
#: bytes of a pass's tries, of which each Python worker holds a copy; one trie at least
PASS_BYTES = 96 << 20
#: keys of a trie whose counts travel in one row
CHUNK = 1 << 13
#: rows that a task gathers before it combines them
GATHER = 1 << 18
#: rows of the stream, each of a slice of texts, that a task gets at once
STREAM_ROWS = 2
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: fixed by the definition: what ends a piece, and what ends a word
_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_GAP = _PIECE.copy()
_GAP[[32, 9]] = True


# words --------------------------------------------------------------------------

def _slices(batches: Iterator[pa.RecordBatch]):
    """(lower-cased bytes, word starts, word ends, row of each word, languages, first row, past the last) of bounded slices."""
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        langs = batch.column("lang")
        for a, b in slices(offsets):
            own = LOWER[data[offsets[a]:offsets[b]]]
            edges = offsets[a:b + 1] - offsets[a]
            starts, ends, first = word_bounds(own, edges, _GAP)
            yield own, starts, ends, np.repeat(np.arange(b - a), np.diff(first)), langs.slice(a, b - a), batch, a, b


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n), and each language's total under a null word."""
    held, rows = [], 0

    def combined():
        return pa.concat_tables(held).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "word", "n"])

    for own, starts, ends, row, langs, *_ in _slices(batches):
        if not len(starts):
            continue
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(own[~_GAP[own]])))
        kinds = langs.dictionary_encode()
        code = kinds.indices.to_numpy(zero_copy_only=False)[row]
        counts = pa.table({"code": pa.array(code, pa.int32()), "word": words}).group_by(["code", "word"], use_threads=False).aggregate([([], "count_all")])
        totals = np.bincount(code, minlength=len(kinds.dictionary))
        held.append(pa.table({"lang": kinds.dictionary.take(counts["code"].combine_chunks()), "word": counts["word"].combine_chunks(), "n": counts["count_all"].combine_chunks()}))
        held.append(pa.table({"lang": kinds.dictionary, "word": pa.nulls(len(totals), pa.string()), "n": pa.array(totals, pa.int64())}))
        rows += len(counts)
        if rows > GATHER:
            held = [combined()]
            rows = len(held[0])
            if rows > GATHER // 2:
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from combined().to_batches()


def _number(rows: DataFrame, shard_of, order: list[str], n: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` written with ``shard`` and a number from 1 on, in shards of at most ``TRIE_KEYS``; the number of shards."""
    shards = max(1, -(-n // TRIE_KEYS) | 1)
    while shards > 1:
        top = rows.groupBy(shard_of(shards).alias("shard")).count().agg(F.max("count")).first()[0]
        if top <= TRIE_KEYS:
            break
        shards += 2
    place = F.row_number().over(Window.partitionBy("shard").orderBy(*order)).cast("long")
    numbered = rows.withColumn("shard", shard_of(shards)).withColumn("no", (place - 1) * shards + F.col("shard") + 1)
    return cut(numbered, name), shards


def _passes(tries: Iterator[tuple]) -> Iterator[tuple[list[tuple], bool]]:
    """(tries of a pass, it is the last): at most ``PASS_TRIES`` of ``PASS_BYTES`` together; the trie is a tuple's second last."""
    held, size = [], 0
    for trie in tries:
        if held and (len(held) == PASS_TRIES or size + trie[-2].nbytes > PASS_BYTES):
            yield held, False
            held, size = [], 0
        held.append(trie)
        size += trie[-2].nbytes
    yield held, True


def _word_trie(vocabulary: DataFrame, shard: int) -> tuple[DoubleArray, np.ndarray]:
    """Trie over language, 0xFF (never a byte of UTF-8) and word, and the words' numbers."""
    found = vocabulary.where(F.col("shard") == shard).select("lang", "word", "no").toArrow()
    keyed = sorted((lang.encode() + b"\xff" + word.encode(), no) for lang, word, no in zip(*(found.column(c).to_pylist() for c in ("lang", "word", "no")), strict=True))
    offsets = np.cumsum([0, *(len(k) for k, _ in keyed)])
    return DoubleArray(np.frombuffer(b"".join(k for k, _ in keyed), np.uint8), offsets), np.array([no for _, no in keyed], np.int32)


def _encode(shared, last: bool):
    """Fills in the numbers of the words that the broadcast tries know; the last pass turns rows into the stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = shared.value
        for own, starts, ends, row, langs, batch, a, b in _slices(batches):
            kinds = langs.dictionary_encode()
            code = kinds.indices.to_numpy(zero_copy_only=False)
            known = [x or b"" for x in batch.column("known").slice(a, b - a).to_pylist()]
            ids = np.frombuffer(b"".join(known), "<i4").copy() if any(known) else np.zeros(len(starts), np.int32)
            for trie, numbers in tries:
                states = np.array([trie.start(x.encode() + b"\xff") for x in kinds.dictionary.to_pylist()], np.int64)[code][row]
                found = trie.find(own, starts, ends, np.where(ids > 0, -1, states))
                ids[found >= 0] = numbers[found[found >= 0]]
            if not last:
                edges = np.searchsorted(row, np.arange(b - a + 1))
                parts = [ids[x:y].tobytes() for x, y in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("text").slice(a, b - a), langs, pa.array(parts, pa.binary())], ["text", "lang", "known"])
            elif len(ids):
                piece = np.cumsum(_PIECE[own])[starts]
                apart = np.zeros(len(ids), np.int64)
                apart[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
                at = np.arange(len(ids)) + np.cumsum(apart)
                stream = np.zeros(at[-1] + 1, "<i4")
                stream[at] = ids
                yield pa.RecordBatch.from_arrays([_cell(stream)], ["ids"])
    return run


# phrases ------------------------------------------------------------------------

def _cells(column: pa.Array, kind: str) -> Iterator[np.ndarray | None]:
    """The rows of a binary column as arrays, without copies; None for a null."""
    return (np.frombuffer(x.as_buffer(), kind) if x.is_valid else None for x in column)


def _cell(values: np.ndarray) -> pa.Array:
    """One binary row over the bytes of ``values``, without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int64)), pa.py_buffer(values)]).cast(pa.binary())


class Tally:
    """Counts of (a, b) pairs, combined whenever many have gathered; ``most`` bounds a count that is sent."""

    def __init__(self, most: int):
        self.most, self.parts, self.size = most, [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((a, b))
        self.size += len(a)
        if self.size > GATHER:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            a, b = (np.concatenate(x).astype(np.int64) for x in zip(*self.parts, strict=True))
            self.parts = []
            if a.max() < 1 << 31 and b.max() < 1 << 31:
                key, n = np.unique(a << 32 | b, return_counts=True)
                a, b = key >> 32, key & 0xFFFFFFFF
            else:
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
                edge = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
                n, a, b = np.diff(np.concatenate((edge, [len(a)]))), a[edge], b[edge]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.minimum(n, self.most).astype(np.int64))], ["a", "b", "n"])
        self.parts, self.size = [], 0


def _propose_pairs(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(least)
        for batch in batches:
            for ids in _cells(batch.column("ids"), "<i4"):
                at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
                yield from tally.add(ids[at], ids[at + 1])
        yield from tally.flush()
    return run


def _propose_triples(least: int, kind: str):
    """(two-word phrase, third word) where the last two words are a candidate as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(least)
        for batch in batches:
            for ids, pairs in zip(_cells(batch.column("ids"), "<i4"), _cells(batch.column("marks"), kind), strict=True):
                at = np.flatnonzero((pairs[:-1] > 0) & (pairs[1:] > 0))
                yield from tally.add(pairs[at], ids[at + 2])
        yield from tally.flush()
    return run


#: fixed multipliers that deal a phrase of word numbers to a shard, the same in Spark and numpy (no overflow of 64 bits)
DEAL = (40503, 30011, 20011)


def _deal(words: list[str], shards: int):
    return F.pmod(sum((F.col(w).cast("long") * m for w, m in zip(words, DEAL, strict=False)), F.lit(0)), F.lit(shards)).cast("int")


def _phrase_trie(candidates: DataFrame, words: list[str], shard: int, width: int) -> tuple[DoubleArray, int]:
    """Trie over the ``width`` bytes of each word's number, the highest first.  Its keys'
    order is the one that ``_number`` counts in, so a key's place gives its number."""
    found = candidates.where(F.col("shard") == shard).select(*words).toArrow()
    columns = [found.column(c).to_numpy().astype(np.int64) for c in words]
    order = np.lexsort(columns[::-1])
    digits = np.stack([(c[order] >> (8 * d) & 255).astype(np.uint8) for c in columns for d in range(width - 1, -1, -1)], axis=1)
    return DoubleArray(digits.ravel(), np.arange(len(order) + 1) * digits.shape[1]), shard


def _counts(total: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first key, places of the counts that are not zero, these counts in the least width) of each chunk that has any."""
    some = np.flatnonzero(total)
    edges = np.searchsorted(some, np.arange(0, len(total) + CHUNK, CHUNK))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        at = some[edges[i]:edges[i + 1]]
        n = total[at]
        yield i * CHUNK, (at - i * CHUNK).astype("<u2"), n.astype(next(x for x in ("<u1", "<u2", "<u4", "<u8") if n.max() <= np.iinfo(x).max))


def _walk(shared, length: int, shards: int, width: int, mark: str | None):
    """Counts of the broadcast candidates, and with a type ``mark`` the stream with the phrase that starts at each position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = shared.value
        sums = [np.zeros(trie.n_keys, np.int64) for trie, _ in tries]
        for batch in batches:
            for row, (ids, old) in enumerate(zip(_cells(batch.column("ids"), "<i4"), _cells(batch.column("marks"), mark or "<i4"), strict=True)):
                ids = ids.astype(np.int64)
                n = len(ids) - length + 1
                marks = None if not mark else np.zeros(max(0, len(ids) - 1), mark) if old is None else old.copy()
                if n > 0:
                    whole = np.logical_and.reduce([ids[i:i + n] > 0 for i in range(length)])
                    at = np.flatnonzero(whole)
                    dealt = sum(ids[at + i] * m for i, m in zip(range(length), DEAL, strict=False)) % shards
                    for k, (trie, shard) in enumerate(tries):
                        live = at[dealt == shard]
                        state = np.zeros(len(live), np.int64)
                        for i in range(length):
                            for d in range(width - 1, -1, -1):
                                state, on = trie.step(state, (ids[live + i] >> (8 * d) & 255) + 1)
                                live, state = live[on], state[on]
                        state, on = trie.step(state, np.zeros(len(live), np.int64))
                        accepted = trie.base[state[on]]
                        sums[k] += np.bincount(accepted, minlength=trie.n_keys)
                        if mark:
                            marks[live[on]] = accepted.astype(np.int64) * shards + (shard + 1)
                if mark:
                    blank = pa.nulls(1, pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column("ids").slice(row, 1), _cell(marks), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), blank, blank], WALKED_NAMES)
        for total, (_, shard) in zip(sums, tries, strict=True):
            for first, places, counts in _counts(total):
                blank = pa.nulls(1, pa.binary())
                yield pa.RecordBatch.from_arrays([blank, blank, pa.array([shard], pa.int32()), pa.array([first], pa.int64()), _cell(places), _cell(counts)], WALKED_NAMES)
    return run


WALKED = "ids binary, marks binary, shard int, first long, places binary, counts binary"
WALKED_NAMES = ["ids", "marks", "shard", "first", "places", "counts"]


def _added(shards: int):
    """(no, f) of the chunks' sums; the rows of a chunk lie together.  A key's number follows from its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None

        def done():
            some = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array((held[1] + some) * shards + held[0] + 1), pa.array(total[some])], ["no", "f"])

        for batch in batches:
            for *key, places, counts in zip(batch.column("shard").to_pylist(), batch.column("first").to_pylist(), _cells(batch.column("places"), "<u2"), batch.column("counts"), strict=True):
                if key != held:
                    if held is not None:
                        yield done()
                    held, total = key, np.zeros(CHUNK, np.int64)
                raw = counts.as_buffer()
                total[places] += np.frombuffer(raw, f"<u{raw.size // len(places)}").astype(np.int64)
        if held is not None:
            yield done()
    return run


def _cut_stream(df: DataFrame, name: str) -> DataFrame:
    """``cut`` of what tasks make of the stream, a few rows of it at a time: as many as usual are a task's whole share."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH_ROWS)
    conf.set(BATCH_ROWS, str(STREAM_ROWS))
    try:
        return cut(df, name)
    finally:
        conf.set(BATCH_ROWS, before)


def _count(stream: DataFrame, candidates: DataFrame, words: list[str], shards: int, width: int, mark: str | None) -> tuple[DataFrame, DataFrame]:
    """(candidates with ``f``, marked stream): one pass over the stream for the tries of each of ``_passes``."""
    spark, sums, before = stream.sparkSession, None, None
    for tries, _ in _passes(_phrase_trie(candidates, words, shard, width) for shard in range(shards)):
        shared = spark.sparkContext.broadcast(tries)
        walked = _cut_stream(stream.mapInArrow(frugal(_walk(shared, len(words), shards, width, mark)), WALKED), "walked")
        shared.destroy()
        found = walked.where(F.col("shard").isNotNull()).select("shard", "first", "places", "counts").repartition("shard", "first").sortWithinPartitions("shard", "first")
        found = cut(found.mapInArrow(frugal(_added(shards)), "no long, f long"), "sums")
        sums = found if sums is None else sums.unionByName(found)
        if before is not None:
            _drop(before)
        before = walked
        if mark:
            stream = walked.where(F.col("ids").isNotNull()).select("ids", "marks")
    if not mark:
        _drop(before)
    return cut(candidates.join(sums, "no").select("no", *words, "f"), "phrases"), stream


def _drop(written: DataFrame) -> None:
    """Delete the folder of a table that ``cut`` wrote."""
    for path in {x.rsplit("/", 1)[0] for x in written.inputFiles()}:
        delete(written.sparkSession, path)


# operator -----------------------------------------------------------------------

def phrases(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(totals, words, pairs, triples): every candidate of 1 to 3 words with its exact count ``f``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    counted = texts.mapInArrow(frugal(_word_counts), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counted = cut(counted.where(F.col("word").isNull() | (F.col("f") >= least)), "word-counts")
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    frequent = counted.where(F.col("word").isNotNull())
    n_words = frequent.count()
    words, shards = _number(frequent, lambda k: F.pmod(F.xxhash64("lang", "word"), F.lit(k)).cast("int"), ["lang", "word"], n_words, "words")
    rows = texts.withColumn("known", F.lit(None).cast("binary"))
    for tries, last in _passes(_word_trie(words, shard) for shard in range(shards)):
        shared = spark.sparkContext.broadcast(tries)
        rows = cut(rows.mapInArrow(frugal(_encode(shared, last)), "ids binary" if last else "text string, lang string, known binary"), "word-stream")
        shared.destroy()
    stream = rows.withColumn("marks", F.lit(None).cast("binary"))
    width = max(1, -(-(words.agg(F.max("no")).first()[0] or 1).bit_length() // 8))

    proposed = stream.select("ids").mapInArrow(frugal(_propose_pairs(least)), "a long, b long, n long")
    pairs = _cut_stream(proposed.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
                        .select(F.col("a").alias("w1"), F.col("b").alias("w2")), "pair-candidates")
    pairs, shards = _number(pairs, lambda k: _deal(["w1", "w2"], k), ["w1", "w2"], pairs.count(), "pairs")
    kind = "<i4" if (pairs.agg(F.max("no")).first()[0] or 0) < 1 << 31 else "<i8"
    pairs, marked = _count(stream, pairs, ["w1", "w2"], shards, width, mark=kind)

    proposed = marked.mapInArrow(frugal(_propose_triples(least, kind)), "a long, b long, n long")
    triples = proposed.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    triples = _cut_stream(triples.join(pairs.select(F.col("no").alias("a"), "w1", "w2"), "a").select("w1", "w2", F.col("b").alias("w3")), "triple-candidates")
    triples, shards = _number(triples, lambda k: _deal(["w1", "w2", "w3"], k), ["w1", "w2", "w3"], triples.count(), "triples")
    triples, _ = _count(stream, triples, ["w1", "w2", "w3"], shards, width, mark=None)
    return totals, words.select("no", "lang", "word", "f"), pairs, triples


def _score(a: str, left: str, right: str):
    """floor(1000000 * a * a / (left * right)), exactly: at most 1000000, as both parts contain the phrase."""
    d = "decimal(38,0)"
    return F.expr(f"cast({a} as {d}) * cast({a} as {d}) * 1000000 div (cast({left} as {d}) * cast({right} as {d}))").cast("long")


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, share: int = 50, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 or 3 words.

    A phrase goes if a longer candidate that contains it has ``share`` percent of its count."""
    totals, words, pairs, triples = phrases(docs, least, text_col, lang_col)

    def word(i):
        return words.select(F.col("no").alias(f"w{i}"), F.col("word").alias(f"word{i}"), F.col("f").alias(f"f{i}"), *([F.col("lang")] if i == 1 else []))

    longer = (triples.select("w1", "w2", "f").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
              .groupBy("w1", "w2").agg(F.max("f").alias("inside")))
    two = (pairs.join(longer, ["w1", "w2"], "left").where(F.col("inside").isNull() | (100 * F.col("inside") < share * F.col("f")))
           .join(word(1), "w1").join(word(2), "w2")
           .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), _score("f", "f1", "f2").alias("score")))
    head = pairs.select("w1", "w2", F.col("f").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    three = three.withColumns({"s1": _score("f", "f1", "f23"), "s2": _score("f", "f12", "f3")})
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), F.col("f").alias("a"),
                         F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
                         F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
spots AS (
  SELECT lang, ws[i] AS w1, CASE WHEN i + 1 <= len(ws) THEN ws[i + 1] END AS w2, CASE WHEN i + 2 <= len(ws) THEN ws[i + 2] END AS w3
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces)),
totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY lang),
c1 AS (SELECT lang, w1, count(*) AS f FROM spots GROUP BY ALL HAVING count(*) >= 10),
c2 AS (SELECT lang, w1, w2, count(*) AS f FROM spots WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
c3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM spots WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
inside AS (
  SELECT lang, w1, w2, max(f) AS f
  FROM (SELECT lang, w1, w2, f FROM c3 UNION ALL SELECT lang, w2, w3, f FROM c3) GROUP BY ALL),
cuts AS (
  SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, c2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM c2 JOIN c1 x ON x.lang = c2.lang AND x.w1 = c2.w1 JOIN c1 y ON y.lang = c2.lang AND y.w1 = c2.w2
  LEFT JOIN inside i ON i.lang = c2.lang AND i.w1 = c2.w1 AND i.w2 = c2.w2
  WHERE i.f IS NULL OR 100 * i.f < 50 * c2.f
  UNION ALL
  SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, 1, x.f, y.f
  FROM c3 JOIN c1 x ON x.lang = c3.lang AND x.w1 = c3.w1 JOIN c2 y ON y.lang = c3.lang AND y.w1 = c3.w2 AND y.w2 = c3.w3
  UNION ALL
  SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, 2, x.f, y.f
  FROM c3 JOIN c2 x ON x.lang = c3.lang AND x.w1 = c3.w1 AND x.w2 = c3.w2 JOIN c1 y ON y.lang = c3.lang AND y.w1 = c3.w3),
scored AS (
  SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
