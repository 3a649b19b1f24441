"""Token-ID shards: raw id payloads behind a minimal perfect hash index.

``write_shards`` range-partitions a table by document id, encodes every whole
text, appends the end id and writes one shard per partition:

* ``shard-*.ids``: the ids of the shard's documents back to back, little-endian,
  16 bits wide when the vocabulary allows it, else 32;
* ``shard-*.mph``: the index.  Keys are hashed through levels of bit arrays; a
  key lands on the first level where it collides with no other, and the rank of
  its bit is its slot, so a lookup costs a constant number of probes whatever
  the shard's size, and slots have no gaps.  A slot stores a fingerprint of the
  key (foreign keys are refused), its first record and its number of records;
  records are offsets into the payload.

A manifest row per shard (file names, totals, id range) is a Parquet table
beside them; it lists the files of the successful attempts only, so files that
a lost executor left half-written are never read.

Cases: a null text is an empty text (only the end id); a null id sorts first,
is not reachable by key and is returned by the scan; rows that share an id are
consecutive records of one slot (split over two shards when the range is cut
between them: both indexes hold the key); an empty table has no shards.
Columns other than id and text are ignored.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import U64, flat, frugal, mix, row_key, slices
from fleetlake.llm.storage import open_input, open_output
from fleetlake.llm.tokenizing import encoder, vocabulary
from fleetlake.session import scratch_path

MANIFEST = "shard int, path string, docs long, tokens long, first_id long, last_id long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"
READ_TOKENS = 1 << 21
TASK_TOKENS = 1 << 25
ENCODE_BYTES = 1 << 22
GAMMA = 2
_KEY = U64(0xD6E8FEB86659FD93)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys, with fingerprints."""

    def __init__(self, levels: list[np.ndarray], sizes: list[int], prints: np.ndarray):
        self.levels, self.sizes, self.prints = levels, sizes, prints
        ranks = np.concatenate([np.zeros(0, np.uint8), *[np.bitwise_count(x) for x in levels]]).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ranks)))
        self.base = np.cumsum([0, *map(len, levels)])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys * _KEY + U64(2 * level + 1)) % U64(size)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        keys, left = keys.astype(np.uint64), keys.astype(np.uint64)
        levels, sizes = [], []
        while len(left):
            size = max(64, GAMMA * len(left))
            at = cls.place(left, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words = np.packbits(alone, bitorder="little")
            levels.append(np.pad(words, (0, -len(words) % 8)).view(np.uint64))
            sizes.append(size)
            left = left[~alone[at.astype(np.int64)]]
        made = cls(levels, sizes, np.zeros(len(keys), np.uint32))
        made.prints[made._slots(keys)] = made.print_of(keys)
        return made

    @staticmethod
    def print_of(keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ _KEY) >> U64(32)).astype(np.uint32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        for level, (words, size) in enumerate(zip(self.levels, self.sizes, strict=True)):
            ask = np.flatnonzero(slot < 0)
            if not len(ask):
                break
            at = self.place(keys[ask], level, size)
            word, bit = (at >> U64(6)).astype(np.int64), at & U64(63)
            hit = (words[word] >> bit) & U64(1) == 1
            below = np.bitwise_count(words[word] & ((U64(1) << bit) - U64(1))).astype(np.int64)
            slot[ask[hit]] = (self.before[self.base[level] + word] + below)[hit]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no slot or another fingerprint is found."""
        keys = keys.astype(np.uint64)
        slot = self._slots(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == self.print_of(keys[known])
        return np.where(known, slot, -1)

    def dump(self) -> dict[str, np.ndarray]:
        return {"sizes": np.array(self.sizes, np.int64), "prints": self.prints,
                "words": np.concatenate([np.zeros(0, np.uint64), *self.levels])}

    @classmethod
    def load(cls, d) -> PerfectHash:
        sizes = d["sizes"].tolist()
        cuts = np.cumsum([(-(-s // 8) + 7) // 8 for s in sizes])
        return cls(np.split(d["words"], cuts[:-1]) if sizes else [], sizes, d["prints"])


class ShardIndex:
    """Key -> records of one shard."""

    def __init__(self, arrays):
        self.hash = PerfectHash.load(arrays)
        self.keys, self.nulls = arrays["keys"], int(arrays["nulls"])
        self.first, self.count, self.offsets = arrays["first"], arrays["count"], arrays["offsets"]

    @staticmethod
    def blob(ids: np.ndarray, nulls: int, lengths: np.ndarray) -> bytes:
        """``ids``: of the records after the ``nulls`` null ones, ascending."""
        keys, first, count = np.unique(ids, return_index=True, return_counts=True)
        made = PerfectHash.build(keys)
        slot = made._slots(keys.astype(np.uint64))
        at, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[slot], n[slot] = first + nulls, count
        out = io.BytesIO()
        np.savez(out, keys=keys, nulls=nulls, first=at, count=n,
                 offsets=np.concatenate(([0], np.cumsum(lengths))), **made.dump())
        return out.getvalue()

    @classmethod
    def read(cls, path: str) -> ShardIndex:
        with open_input(path) as f:
            return cls(np.load(io.BytesIO(f.read())))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key (0: not here)."""
        slot = self.hash.slots(np.asarray(keys, np.int64))
        there = slot >= 0
        return np.where(there, self.first[slot], 0) if len(self.first) else slot * 0, np.where(there, self.count[slot], 0) if len(self.count) else slot * 0


def _writer(folder: str, vocab: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab)
        end = np.array([end_id], enc.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        path, out = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}", None
        ids, lengths, nulls = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = open_output(path + ".ids")
            key, text = batch.column("id"), batch.column("text")
            nulls += key.null_count
            ids.append(key.drop_null().to_numpy(zero_copy_only=False))
            for a, b in slices(flat(text)[1], ENCODE_BYTES):
                for part in enc.encode(text.slice(a, b - a).to_pylist()):
                    out.write(part)
                    out.write(end)
                    lengths.append(len(part) // enc.dtype.itemsize + 1)
        if out is None:
            return
        out.close()
        known = np.concatenate(ids)
        with open_output(path + ".mph") as f:
            f.write(ShardIndex.blob(known, nulls, np.array(lengths, np.int64)))
        row = (shard, path, len(lengths), sum(lengths), *((int(known[0]), int(known[-1])) if len(known) else (None, None)))
        yield pa.RecordBatch.from_pylist([dict(zip(("shard", "path", "docs", "tokens", "first_id", "last_id"), row, strict=True))],
                                         pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()),
                                                    ("first_id", pa.int64()), ("last_id", pa.int64())]))
    return write


def write_shards(docs: DataFrame, folder: str, vocab: str | None = None, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards of ``docs`` below ``folder`` in ascending id order; returns the manifest.

    Its rows, one per shard, meet in one file: a file of one row per task costs the
    executors a start of two processes each."""
    keyed = row_key(docs, id_col, text_col)
    ranged = (keyed.repartitionByRange(F.col("id").asc_nulls_first(), "k2")
              .sortWithinPartitions(F.col("id").asc_nulls_first(), "k2").select("id", "text"))
    written = ranged.mapInArrow(frugal(_writer(folder, vocab or vocabulary(), end_id)), MANIFEST)
    written.repartition(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _reader(itemsize: int):
    dtype = np.dtype(f"<u{itemsize}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = ShardIndex.read(row["path"] + ".mph")
                first, count = index.find(index.keys)
                if not (count > 0).all():
                    raise ValueError(f"{row['path']}: the index misses a key")
                record = np.concatenate((np.arange(index.nulls), np.repeat(first, count) + _within(count)))
                key = np.repeat(index.keys, count)
                at = index.offsets[record]
                n = index.offsets[record + 1] - at
                crc = np.zeros(len(record), np.int64)
                with open_input(row["path"] + ".ids") as f:
                    for a, b in slices(np.concatenate((at, [row["tokens"]])), READ_TOKENS):
                        f.seek(int(at[a]) * itemsize)
                        ids = np.frombuffer(f.read(int(at[b - 1] + n[b - 1] - at[a]) * itemsize), dtype).astype("<u4")
                        for i in range(a, b):
                            crc[i] = zlib.crc32(ids[at[i] - at[a]: at[i] - at[a] + n[i]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None] * index.nulls + key.tolist(), pa.int64()), pa.array(at + row["base"]), pa.array(n), pa.array(crc),
                     pa.array(np.full(len(at), row["shard"], np.int32))],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])
    return read


def _within(count: np.ndarray) -> np.ndarray:
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def shard_list(manifest: DataFrame) -> DataFrame:
    """The manifest with each shard's first global token; a task takes neighbouring
    shards of at most ``TASK_TOKENS`` tokens together, or one larger shard.

    Only one row per shard passes the driver; documents do not."""
    spark, base, held, tasks = manifest.sparkSession, 0, 0, []
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        if not tasks or held + r["tokens"] > TASK_TOKENS:
            tasks.append((len(tasks), []))
            held = 0
        tasks[-1][1].append((r["shard"], r["path"], r["tokens"], base, r["first_id"], r["last_id"]))
        base += r["tokens"]
        held += r["tokens"]
    shard = "shard int, path string, tokens long, base long, first_id long, last_id long"
    made = spark.createDataFrame(tasks, f"task int, shards array<struct<{shard}>>")
    return made.repartitionByRange(max(1, len(tasks)), "task").select(F.inline("shards"))


def read_shards(manifest: DataFrame, itemsize: int) -> DataFrame:
    """Every record of the shards through their indexes, with the crc32 of its
    ids as unsigned 32-bit numbers and its global start."""
    return shard_list(manifest).mapInArrow(frugal(_reader(itemsize)), READ)


def lookup(manifest: DataFrame, keys: DataFrame, itemsize: int, key_col: str = "doc_id") -> DataFrame:
    """Keyed access: (key, ids) for every record of every asked key.

    Keys go to the shards whose id range holds them; a shard's task opens one
    index and reads only the asked slices of the payload."""
    shards = shard_list(manifest)
    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    pairs = asked.join(shards, (F.col("key") >= F.col("first_id")) & (F.col("key") <= F.col("last_id"))).select("path", "key")
    dtype = np.dtype(f"<u{itemsize}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, ShardIndex] | None = None
        for batch in batches:
            for path, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held is None or held[0] != path:
                    held = path, ShardIndex.read(path + ".mph")
                first, count = held[1].find(np.array([key]))
                with open_input(path + ".ids") as f:
                    for r in range(int(first[0]), int(first[0] + count[0])):
                        a, b = held[1].offsets[r: r + 2]
                        f.seek(int(a) * itemsize)
                        ids = np.frombuffer(f.read(int(b - a) * itemsize), dtype).astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], ["key", "ids"])
    return pairs.repartition("path").sortWithinPartitions("path", "key").mapInArrow(read, "key long, ids array<long>")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token shards, written and read back through the index."""
    from fleetlake.llm.common import table
    vocab = vocabulary()
    manifest = write_shards(table(spark, sf_dir, "documents"), scratch_path(spark, "token-shards"), vocab)
    return read_shards(manifest, encoder(vocab).dtype.itemsize).select("doc_id", "start", "n_tokens", "ids_crc32")
