"""Packing by concatenate-and-cut.

Documents in id order form one long id stream.  Pass one encodes each document
once and stores its ids, and the partitions' token totals become global offsets
by prefix sums (one number per partition passes the driver).  Pass two cuts the
stream at every multiple of the sequence length: a document yields one boundary
record per window it touches.  Every sequence but the last is full, so the
padding of the whole table is less than one sequence; the last is padded to the
sequence length unless it holds a power of two of ids already.

Cases: a null text is an empty text (one end id, one piece); null ids come
first; rows that share an id are separate documents next to each other, in an
order fixed by their text; an empty table has no pieces.  Columns other than id
and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import flat, row_key, slices, table
from fleetlake.llm.tokenizing import encoder, vocabulary
from fleetlake.session import scratch_path

ENCODED = "part int, pos long, id long, n long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
BATCH_BYTES = 1 << 22


def _encode(vocab: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab)
        end = np.array([end_id], enc.dtype).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            key, text = batch.column("id"), batch.column("text")
            for a, b in slices(flat(text)[1]):
                ids = [x + end for x in enc.encode(text.slice(a, b - a).to_pylist())]
                n = np.array([len(x) // enc.dtype.itemsize for x in ids], np.int64)
                pos = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part, np.int32)), pa.array(pos), key.slice(a, b - a), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "pos", "id", "n", "ids"])
    return run


def _cut(bases: dict[int, int], width: int, itemsize: int):
    dtype = np.dtype(f"<u{itemsize}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("ids"))
            for a, b in slices(offs, BATCH_BYTES):
                part = batch.column("part").slice(a, b - a).to_numpy()
                start = batch.column("pos").slice(a, b - a).to_numpy() + np.array([bases[int(p)] for p in part], np.int64)
                n = batch.column("n").slice(a, b - a).to_numpy()
                first = start // width
                pieces = (start + n - 1) // width - first + 1
                doc = np.repeat(np.arange(b - a), pieces)
                seq = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                lo = np.maximum(start[doc], seq * width)
                hi = np.minimum((start + n)[doc], (seq + 1) * width)
                ids = data[offs[a]:offs[b]].view(dtype).astype("<u4")
                local = (offs[a:b] - offs[a])[doc] // itemsize + lo - start[doc]
                crc = [zlib.crc32(ids[x:x + k]) for x, k in zip(local.tolist(), (hi - lo).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a).take(pa.array(doc)), pa.array(lo - start[doc]), pa.array(hi - lo), pa.array(crc, pa.int64()),
                     pa.array(n[doc]), pa.array(seq), pa.array(lo - seq * width)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def padded_length(ids: int, width: int = 1024) -> int:
    """Length of a sequence that holds ``ids`` ids, with its padding."""
    return ids if ids & (ids - 1) == 0 else width


def pack(docs: DataFrame, width: int = 1024, vocab: str | None = None, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; see the module text."""
    spark, vocab = docs.sparkSession, vocab or vocabulary()
    keyed = row_key(docs, id_col, text_col)
    ranged = (keyed.repartitionByRange(F.col("id").asc_nulls_first(), "k2")
              .sortWithinPartitions(F.col("id").asc_nulls_first(), "k2").select("id", "text"))
    path = scratch_path(spark, "packing")
    ranged.mapInArrow(_encode(vocab, end_id), ENCODED).write.option("compression", "zstd").parquet(path)
    encoded = spark.read.schema(ENCODED).parquet(path)
    bases, at = {}, 0
    for r in encoded.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        bases[r["part"]] = at
        at += r["n"]
    return encoded.mapInArrow(_cut(bases, width, encoder(vocab).dtype.itemsize), PIECES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
