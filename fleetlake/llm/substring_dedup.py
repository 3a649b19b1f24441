"""Substring dedup with FM-indexes: words covered by a window of 50 words that
also starts in a document with a smaller id are removed.

Candidate segments come from ``dup_windows``.  Each task builds compressed
FM-indexes over the distinct segments of its keys and streams the segments
through backward search; the matching statistics, capped at the threshold, name
for every window the class of its occurrences, whose least document id is the
answer.  A key with more words than one index may hold gets several indexes,
and its segments are streamed through each.

Cases: null or wordless texts have no words; documents of fewer than 50 words
lose nothing; rows that share an id never remove each other's words; rows with
a null id neither cause nor suffer removals; an empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.common import flat, row_key, table, word_bounds, word_hashes
from fleetlake.llm.dup_windows import Scheme, covered, decide, occurrences, per_row, span_lists
from fleetlake.llm.fm_index import FMIndex

INDEX_WORDS = 1_000_000
CHUNK_BYTES = 2_000_000
NEVER = np.iinfo(np.int64).max


def fm_answers(length: int, index_words: int):
    """For each segment the runs of windows and their least id: int64 triples
    (first window, windows, least id)."""

    def index(segs: list[bytes], lo: np.ndarray, c: np.ndarray, keys: list[int]) -> list[bytes]:
        raw = np.frombuffer(b" ".join(segs), np.uint8)
        starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]))
        _, ids = np.unique(word_hashes(raw, starts, ends), return_inverse=True)
        cuts = np.concatenate(([0], np.cumsum([s.count(b" ") + 1 for s in segs])))
        symbols = [ids[a:b] + 1 for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        sigma = int(ids.max()) + 2
        best = [np.full(len(s) - length + 1, NEVER) for s in symbols]
        at = 0
        while at < len(symbols):
            end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + index_words, side="right")) - 1)
            fm = FMIndex(symbols[at:end], sigma, length)
            least = fm.least(lo[at:end])
            # one index: it holds all that could match; several: all segments go through each
            asked = range(at, end) if end - at == len(symbols) else range(len(symbols))
            where = np.concatenate(([0], np.cumsum([len(best[i]) for i in asked])))
            got = np.full(where[-1], NEVER)
            for q, start, _, cls in fm.matching([symbols[i] for i in asked]):
                hit = cls >= 0
                got[where[q[hit]] + start[hit]] = least[cls[hit]]
            for i, a, b in zip(asked, where[:-1], where[1:], strict=True):
                np.minimum(best[i], got[a:b], out=best[i])
            at = end
        out = []
        for b in best:
            edge = np.concatenate(([0], np.flatnonzero(np.diff(b)) + 1, [len(b)]))
            out.append(np.stack((edge[:-1], np.diff(edge), b[edge[:-1]]), axis=1).astype("<i8").tobytes())
        return out
    return index


def _finish(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            raw, at = data.tobytes(), offs.tolist()
            n_words, n_removed, digest, kept_text = [], [], [], []
            for i, (key, null, spans) in enumerate(zip(batch.column("k1").to_pylist(), batch.column("id").is_null().to_pylist(),
                                                       span_lists(batch.column("spans")), strict=True)):
                words = raw[at[i]:at[i + 1]].split()
                n_words.append(len(words))
                if spans and not null:
                    runs = np.concatenate([np.frombuffer(a, "<i8").reshape(-1, 3) + [p, 0, 0] for p, a in spans])
                    runs = runs[runs[:, 2] < key]
                    gone = covered(len(words), runs[:, 0], runs[:, 0] + runs[:, 1] - 1 + length)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept = b" ".join(words)
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
                                              pa.array(kept_text, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", index_words: int = INDEX_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) per row."""
    keyed = row_key(docs, id_col, text_col)
    gram = max(1, length // 6)
    scheme = Scheme("word", length, max(gram, length * 4 // 5), gram, 64, 1 << 20)
    found = occurrences(keyed.where("id IS NOT NULL"), scheme, True)
    spans = per_row(found, decide(found, fm_answers(length, index_words), CHUNK_BYTES, scheme))
    return keyed.join(spans, ["k1", "k2"], "left").select("id", "k1", "text", "spans").mapInArrow(
        _finish(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")
