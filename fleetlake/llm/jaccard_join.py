"""N-gram Jaccard join: exact links of documents whose shingle sets are alike.

1. Per document: the set of distinct k-word shingles (64-bit hashes of the
   words), its size, a 128-bit digest of the set, and its signatures.  Sets of
   sizes a and b with Jaccard >= p/q differ in at most (a+b)(q-p)/(q+p)
   shingles, so when all shingles are dealt by hash into more parts than that,
   some part is the same in both.  Sizes fall into bands; a set signs for
   its own band and, near the lower edge of it, for the band below, with the
   part count of the band.  No link can be missed, and a signature covers
   several shingles at once, so frequent words and passages do not make large
   groups as single shingles would.
2. Equal sets are one class (pre-aggregated before the shuffle; a task signs a set
   once); only class representatives are compared.
3. Equal signatures tie a document to the least document of the signature (one
   row of two numbers each, streamed in order, never all pairs); the components
   of these ties are clusters, and every link lies inside one cluster.
4. Inside the clusters, size-banded tiles of bitmap signatures rule pairs out: what
   shares a signature by chance or by a common passage falls apart here, and only
   the components of the pairs that remain possible fetch their texts.
5. Such a cluster is compared in tiles.  A cluster within the bounds is one tile; a
   larger one is split by narrow size bands and, within a band, by hash, and
   only blocks of the same or neighbouring bands meet.  In a tile, hashed
   parity bitmaps bound each pair's overlap from above by bit counts, pairs that could
   reach the threshold are intersected exactly as sorted arrays, and linked
   sets are merged; a pair already in one component is not compared again.
   A tile returns a spanning forest, at most one row per set.
6. Components of the forests' edges are the result.

Cases: null or wordless texts have an empty set, link with nothing and are
their own component; a text with fewer than k words has one shingle, the whole
sequence; equal sets link; rows with a null id take no part in linking and have
a null component; rows that share an id are one node.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import LOWER, P1, U64, cut, flat, frugal, gram_hashes, mix, row_key, slices, table, word_bounds, word_hashes
from fleetlake.llm.components import components

#: a tile holds at most about so many shingles and sets on each side
TILE_SHINGLES = 1_200_000
TILE_SETS = 3_000
MAP_BITS = 4096
#: bits of the maps that stand for whole sets before their texts are fetched
SKETCH_BITS = 2048
BAND = 1.5
WEAK = 2            # most shingles of a part that may be left out
_SHORT = U64(0xA24BAED4963EE407)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of every row back to back, row offsets)."""
    starts, ends, first = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    n = np.diff(first)
    g = gram_hashes(h, k)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.flatnonzero(np.arange(len(g)) + k <= first[1:][row[:len(g)]]) if len(g) else np.zeros(0, np.int64)
    rows, vals = row[inside], g[inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        acc = mix(n[short].astype(np.uint64) + _SHORT)
        for j in range(k - 1):
            more = n[short] > j
            acc[more] = mix(acc[more] * P1 + h[first[:-1][short[more]] + j])
        rows, vals = np.concatenate((rows, short)), np.concatenate((vals, acc))
    order = np.lexsort((vals, rows))
    rows, vals = rows[order], vals[order]
    keep = np.ones(len(vals), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (vals[1:] != vals[:-1])
    rows, vals = rows[keep], vals[keep]
    return vals, np.searchsorted(rows, np.arange(len(n) + 1))


def band_of(n: int) -> int:
    return int(math.log(n) / math.log(BAND) + 1e-9)


def parts_of(band: int, num: int, den: int) -> tuple[int, int]:
    """(parts, most parts that can differ) for pairs whose smaller set lies in ``band``."""
    top = math.ceil(BAND ** (band + 1)) + 1
    differ = (top + top * den // num + 1) * (den - num) // (den + num)
    return differ + 1 + differ // 8, differ


def signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of one set: of its band, and of each lower band that a smaller
    partner could lie in.

    Empty and nearly empty parts are alike in many unrelated sets.  A set may leave
    them out as long as more parts remain than can differ: then some remaining part
    is equal in both sets of a link, and equal parts are left out by both or none."""
    n = len(s)
    out = []
    least = -(-n * num // den)
    for band in range(band_of(least), band_of(n) + 1):
        parts, differ = parts_of(band, num, den)
        part = (mix(s ^ P1) % U64(parts)).astype(np.int64)
        # order-free sums of finalised hashes: equal parts have equal sums
        lo = np.zeros(parts, np.uint64)
        np.add.at(lo, part, mix(s + U64(band)))
        sig = mix(lo ^ mix(np.arange(parts, dtype=np.uint64) + U64(band + 1 << 32)))
        held = np.bincount(part, minlength=parts)
        for weak in range(WEAK, -2, -1):  # -1 leaves nothing out
            if (held > weak).sum() > differ or weak < 0:
                out.append(sig[held > weak])
                break
    return np.unique(np.concatenate(out))


def parity_map(s: np.ndarray, bits: int) -> np.ndarray:
    """One bit per hash slot: whether an odd number of the set's shingles falls in it.
    Each slot where two maps differ stands for a shingle of one set alone."""
    return np.packbits(np.bincount((s % U64(bits)).astype(np.int64), minlength=bits) & 1)


def _measure(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = flat(batch.column("text"))
            for a, b in slices(offs, 1 << 20):
                low = LOWER[data[offs[a]:offs[b]]]
                vals, cuts = shingle_sets(low, offs[a:b + 1] - offs[a], k)
                digests = [hashlib.blake2b(vals[x:y].tobytes(), digest_size=16).digest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), batch.column("k2").slice(a, b - a), pa.array(np.diff(cuts).astype(np.int64)), pa.array(digests, pa.binary()),
                     pa.array([parity_map(vals[x:y], SKETCH_BITS).tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                    ["id", "k2", "n", "digest", "map"])
    return run


def _signature_rows(k: int, num: int, den: int):
    """(sig, rep) rows; a text that a task has signed before brings no new rows but
    ties its id to the first one's by a row of its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offs = flat(batch.column("text"))
            for a, b in slices(offs, 1 << 20):
                vals, cuts = shingle_sets(LOWER[data[offs[a]:offs[b]]], offs[a:b + 1] - offs[a], k)
                ids, sigs, reps = batch.column("id").slice(a, b - a).to_numpy(), [], []
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    s = vals[cuts[i]:cuts[i + 1]]
                    digest = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                    if len(seen) > 1_000_000:
                        seen.clear()
                    own = np.frombuffer(digest, np.uint64)
                    if digest not in seen:
                        seen.add(digest)
                        own = np.append(signatures(s, num, den), own)
                    sigs.append(own)
                    reps.append(np.full(len(own), ids[i]))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(reps))], ["sig", "rep"])
    return run


def _tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by signature and id: each id of a signature is tied to the
    first.  Constant memory, whatever the size of a signature's group."""
    last, first = None, None
    for batch in batches:
        sig, rep = batch.column("sig").to_numpy(), batch.column("rep").to_numpy()
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        new[0] = sig[0] != last
        head = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        least = np.where(head >= 0, rep[head], first if first is not None else 0)
        last, first = sig[-1], least[-1]
        tied = least != rep
        yield pa.RecordBatch.from_arrays([pa.array(rep[tied]), pa.array(least[tied])], ["u", "v"])


def _could_link(i: int, maps: np.ndarray, size: np.ndarray, side: np.ndarray, comp: np.ndarray, num: int, den: int) -> np.ndarray:
    """The sets after ``i``, in other components, whose overlap bound reaches the threshold."""
    j = np.arange(i + 1, len(size))
    j = j[comp[j] != comp[i]]
    if side[i]:
        j = j[side[j] != side[i]]
    j = j[(size[j] * den >= size[i] * num) & (size[i] * den >= size[j] * num)]
    apart = np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1, dtype=np.int64)
    bound = (size[i] + size[j] - apart) // 2
    return j[bound * den >= (size[i] + size[j] - bound) * num]


def possible_links(maps: np.ndarray, size: np.ndarray, side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of a tile that the maps cannot rule out."""
    comp, forest = np.arange(len(size)), []
    for i in range(len(size) - 1):
        for x in _could_link(i, maps, size, side, comp, num, den).tolist():
            if comp[x] != comp[i]:
                forest.append((i, x))
                comp[comp == comp[x]] = comp[i]
    return forest


def _map_tiles(num: int, den: int):
    names = ("cluster", "ta", "tb", "ha", "hb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            maps = np.stack([np.frombuffer(x[2], np.uint64) for x in held])
            links = possible_links(maps, np.array([x[1] for x in held], np.int64), np.array([x[3] for x in held]), num, den)
            return pa.RecordBatch.from_arrays([pa.array([held[a][0] for a, _ in links], pa.int64()), pa.array([held[b][0] for _, b in links], pa.int64())], ["u", "v"])
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            rows = zip(*(batch.column(c).to_pylist() for c in ("rep", "n", "map", "side")), strict=True)
            for now, row in zip(keys, rows, strict=True):
                if now != key:
                    if len(held) > 1:
                        yield done()
                    key, held = now, []
                held.append(row)
        if len(held) > 1:
            yield done()
    return run


def tile_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the links of a tile.  ``side``: 0 both sides, else pairs
    need one set of side 1 and one of side 2."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    bits = min(MAP_BITS, 1 << max(8, int(2 * size.max()).bit_length()))
    maps = np.stack([parity_map(s, bits) for s in sets]).view(np.uint64)
    every, cuts = np.concatenate(sets), np.concatenate(([0], np.cumsum(size)))
    comp, forest = np.arange(n), []
    for i in range(n - 1):
        j = _could_link(i, maps, size, side, comp, num, den)
        for at in range(0, len(j), 256):
            some = j[at:at + 256]
            some = some[comp[some] != comp[i]]
            if not len(some):
                continue
            take = np.concatenate([every[cuts[x]:cuts[x + 1]] for x in some])
            where = np.minimum(np.searchsorted(sets[i], take), size[i] - 1)
            both = np.add.reduceat((sets[i][where] == take).astype(np.int64), np.concatenate(([0], np.cumsum(size[some])[:-1])))
            for x in some[both * den >= (size[i] + size[some] - both) * num].tolist():
                if comp[x] != comp[i]:
                    forest.append((i, x))
                    comp[comp == comp[x]] = comp[i]
    return forest


def _tiles(k: int, num: int, den: int):
    def done(key: tuple, ids: list[int], sets: list[np.ndarray], side: list[int]) -> pa.RecordBatch:
        links = tile_links(sets, np.array(side), num, den) if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in links], pa.int64()), pa.array([ids[b] for _, b in links], pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, ids, sets, side = None, None, [], [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "ta", "tb", "ha", "hb")), strict=True))
            members = list(zip(batch.column("rep").to_pylist(), batch.column("k2").to_pylist(), strict=True))
            sides = batch.column("side").to_pylist()
            data, offs = flat(batch.column("text"))
            for a, b in slices(offs, 1 << 20):
                vals, cuts = shingle_sets(LOWER[data[offs[a]:offs[b]]], offs[a:b + 1] - offs[a], k)
                for i in range(a, b):
                    if keys[i] != key:
                        if len(ids) > 1:
                            yield done(key, ids, sets, side)
                        key, last, ids, sets, side = keys[i], None, [], [], []
                    if members[i] != last:  # not a repeated row
                        last = members[i]
                        ids.append(last[0])
                        sets.append(vals[cuts[i - a]:cuts[i - a + 1]].copy())
                        side.append(sides[i])
        if len(ids) > 1:
            yield done(key, ids, sets, side)
    return run


def _placed(members: DataFrame, num: int, den: int, shingles: int, *carry: str) -> DataFrame:
    """(rep, cluster, tile key, side) rows: one per block that a set meets."""
    width = math.log(den / num)
    spread = members.withColumn("band", F.floor(F.log(F.col("n")) / F.lit(width) + F.lit(1e-9)).cast("int"))
    per = spread.groupBy("cluster", "band").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("c"))
    whole = per.groupBy("cluster").agg(F.sum("w").alias("tw"), F.sum("c").alias("tc"))
    small = (F.col("tw") <= shingles) & (F.col("tc") <= TILE_SETS)
    blocks = F.ceil(F.greatest(F.col("w") / shingles, F.col("c") / TILE_SETS)).cast("int")
    # block counts of the bands below, at and above: a handful of rows for each large cluster
    near = (per.join(whole.where(~small).select("cluster"), "cluster").select("cluster", "band", blocks.alias("s")))
    near = (near.select("cluster", F.col("band").alias("band"), F.lit("own").alias("k"), "s")
            .unionByName(near.select("cluster", (F.col("band") - 1).alias("band"), F.lit("up").alias("k"), "s"))
            .unionByName(near.select("cluster", (F.col("band") + 1).alias("band"), F.lit("down").alias("k"), "s"))
            .groupBy("cluster", "band").agg(*(F.coalesce(F.max(F.when(F.col("k") == k, F.col("s"))), F.lit(0)).alias(k) for k in ("own", "up", "down"))))
    one = spread.join(whole.where(small).select("cluster"), "cluster").select(
        "rep", "k2", *carry, "cluster", F.lit(-1).alias("ta"), F.lit(-1).alias("tb"), F.lit(0).alias("ha"), F.lit(0).alias("hb"), F.lit(0).alias("side"))
    big = spread.join(near.where("own > 0"), ["cluster", "band"]).withColumn("h", F.pmod(F.xxhash64("rep", "k2"), F.col("own")).cast("int"))

    def tile(ta, tb, ha, hb, side):
        return F.struct(ta.cast("int").alias("ta"), tb.cast("int").alias("tb"), ha.cast("int").alias("ha"), hb.cast("int").alias("hb"), side.alias("side"))

    b, h = F.col("band"), F.col("h")
    same = F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda o: tile(b, b, F.least(o, h), F.greatest(o, h), F.when(o == h, 0).when(h < o, 1).otherwise(2)))
    up = F.when(F.col("up") > 0, F.transform(F.sequence(F.lit(0), F.col("up") - 1), lambda o: tile(b, b + 1, h, o, F.lit(1))))
    down = F.when(F.col("down") > 0, F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda o: tile(b - 1, b, o, h, F.lit(2))))
    none = F.array().cast("array<struct<ta:int,tb:int,ha:int,hb:int,side:int>>")
    dealt = big.select("rep", "k2", *carry, "cluster", F.explode(F.concat(same, F.coalesce(up, none), F.coalesce(down, none))).alias("t")).select("rep", "k2", *carry, "cluster", "t.*")
    return one.unionByName(dealt)


def jaccard_groups(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) per row; links at Jaccard >= num/den."""
    keyed = row_key(docs, id_col, text_col)
    signed = cut(keyed.select("id", "k2", "text").mapInArrow(frugal(_measure(k)), "id long, k2 long, n long, digest binary, map binary"), "signed")
    sets = signed.where("n > 0 AND id IS NOT NULL")
    classes = cut(sets.groupBy("digest", "n").agg(F.min(F.struct("id", "k2", "map")).alias("m"))
                  .select("digest", "n", F.col("m.id").alias("rep"), F.col("m.k2").alias("k2"), F.col("m.map").alias("map")), "classes")
    tied = keyed.where("id IS NOT NULL").select("id", "text").mapInArrow(frugal(_signature_rows(k, num, den)), "sig long, rep long")
    ties = cut(tied.repartition("sig").sortWithinPartitions("sig", "rep").mapInArrow(frugal(_tie), "u long, v long").distinct(), "ties")
    order = ["cluster", "ta", "tb", "ha", "hb"]

    def members(edges: DataFrame, *carry: str) -> DataFrame:
        # a class of equal sets goes on as its least id alone
        found = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
        return cut(found.join(classes.select("rep", "k2", "n", *carry), "rep"), "members")

    rough = _placed(members(ties, "map"), num, den, 1 << 62, "n", "map").repartition(*order).sortWithinPartitions(*order, "rep", "k2")
    possible = cut(rough.select(*order, "rep", "n", "map", "side").mapInArrow(frugal(_map_tiles(num, den)), "u long, v long").where("u <> v"), "possible")
    texts = keyed.where("id IS NOT NULL").select(F.col("id").alias("rep"), "k2", "text")
    # the placed sets grow with the corpus: never a broadcast side, at any size
    tiles = (_placed(members(possible), num, den, TILE_SHINGLES).hint("merge").join(texts, ["rep", "k2"]).repartition(*order)
             .sortWithinPartitions(*order, "rep", "k2").select(*order, "rep", "k2", "side", "text"))
    links = tiles.mapInArrow(frugal(_tiles(k, num, den)), "u long, v long")
    # copies of one set, and rows that share an id, hang on the class's least id
    same = sets.select(F.col("id").alias("u"), "digest", "n").join(classes.select("digest", "n", "rep"), ["digest", "n"]).select("u", F.col("rep").alias("v")).where("u <> v")
    groups = components(links.unionByName(same))
    return (signed.select("id", "n").join(groups, F.col("id") == F.col("node"), "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id")))


def _named_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``__llm_node``: the id, or a number of its own for each
    further text of an id that several different texts share.

    Which texts those are is worked out on ids and hashes alone; there are none as a
    rule, and the join to them is whatever Spark makes of their size."""
    keys = cut(row_key(docs).where("id IS NOT NULL").select("id", "k2"), "ids")
    first = keys.groupBy("id").agg(F.min("k2").alias("first"), F.max("k2").alias("last")).where("first <> last")
    more = keys.join(cut(first, "shared-ids"), "id").where(F.col("k2") != F.col("first")).select("id", "k2").distinct()
    lo, hi = keys.agg(F.min("id"), F.max("id")).first()
    count = F.monotonically_increasing_id()
    if (hi or 0) < 1 << 61:
        number = F.lit((hi or 0) + 1) + count
    elif lo > -(1 << 61):
        number = F.lit(lo - 1) - count
    else:
        raise ValueError("ids leave no numbers free for texts that share one")
    # written, so that a number is given once
    extra = cut(more.orderBy("id", "k2").withColumn("__llm_extra", number).withColumnsRenamed({"id": "__llm_id", "k2": "__llm_k2"}), "further-texts")
    i, t = F.col("doc_id").cast("long"), F.col("text").cast("string")
    k2 = F.xxhash64(i.isNull(), t.isNull(), t)     # as row_key has it
    return docs.join(extra, (i == F.col("__llm_id")) & (k2 == F.col("__llm_k2")), "left").withColumn(
        "__llm_node", F.coalesce("__llm_extra", i)).drop("__llm_id", "__llm_k2", "__llm_extra")


def one_per_group(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One document of each group of linked texts, with all its columns: the least id,
    or, in a group of further texts of shared ids alone, the least of those.

    Texts that share an id are judged apart, so an unlike one stays; rows equal in id
    and text are one document; rows with a null id stay; an empty table gives none."""
    named = _named_apart(docs)
    groups = jaccard_groups(named, k, num, den, id_col="__llm_node")
    kept = groups.where("component_id = doc_id").select(F.col("doc_id").alias("__llm_kept")).distinct()
    met = named.join(kept, F.col("__llm_node") == F.col("__llm_kept"))
    order = Window.partitionBy("__llm_node").orderBy(F.xxhash64("text"))
    return (met.withColumn("__llm_row", F.row_number().over(order)).where("__llm_row = 1").select(*docs.columns)
            .unionByName(docs.where("doc_id IS NULL")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, Jaccard of at least 0.9."""
    return jaccard_groups(table(spark, sf_dir, "documents"), 3, 90, 100)
