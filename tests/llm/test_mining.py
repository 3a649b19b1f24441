"""Hard negatives, exact dedup and collocations against brute force on small tables
with nulls, empty and long texts, ties, repeated rows, clashing columns and no rows."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import collocations, exact_dedup, hard_negatives
from fleetlake.llm.double_array import DoubleArray

# hard negatives -----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, anchor_no int, score string"


def test_strassen_equals_the_plain_product():
    r = np.random.default_rng(5)
    for m, k, n in ((1, 1, 1), (17, 33, 65), (64, 64, 64), (40, 7, 90), (100, 129, 51), (3, 0, 4)):
        a, b = r.integers(-1 << 20, 1 << 20, (m, k)), r.integers(-1 << 20, 1 << 20, (k, n))
        assert (hard_negatives.strassen(a, b) == a @ b).all()
    # sums inside the recursion may pass 64 bits: the result is right as long as it fits itself
    a = np.full((32, 32), 1 << 28)
    assert (hard_negatives.strassen(a, a) == 32 << 56).all()


def test_products_beyond_64_bits_are_exact():
    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 40, -5], [7, 1 << 41]])
    assert hard_negatives.products(a, b).tolist() == [[(1 << 80) - 15, 7 * (1 << 40) + 3 * (1 << 41)]]
    assert hard_negatives.integers(np.array([[1e300, -0.001, 0.5]]), 256).tolist() == [[int(1e300) * 256, -1, 128]]


def mined(rows, every=5, k=3, low=Fraction(4, 5)):
    sound = [(i, [math.floor(Fraction(x) * 256) for x in v], lab) for i, v, lab, *_ in rows
             if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, lab in {(i, tuple(v), lab) for i, v, lab in sound if i % every == 0}:
        met = sorted(((sum(a * b for a, b in zip(v, w, strict=True)), -j, other == lab) for j, w, other in sound if j != i and len(w) == len(v)), reverse=True)
        for place, (score, j, _) in enumerate([x for x in met if x[2]][:k], 1):
            window = [x for x in met if not x[2] and low * score <= x[0] <= score][:k]
            out += [(i, -j, place, rank, -n, score, s) for rank, (s, n, _) in enumerate(window, 1)]
    return sorted(out)


def vectors_of(seed=1, n=160):
    r = random.Random(seed)
    hot = [r.choice((-0.5, 0.25, 0.75)) for _ in range(4)]
    rows = [(i, list(hot) if i % 3 == 0 else [r.choice((-0.5, 0.0, 0.25, 0.7501, 1.0)) for _ in range(4)], r.randint(0, 2), 1, "s") for i in range(n)]
    rows += [(200, None, 1, 1, "s"), (205, [1.0, None, 0.0, 0.0], 1, 1, "s"), (210, [1.0, float("nan"), 0.0, 0.0], 0, 1, "s"), (215, [float("inf"), 1.0, 0.0, 0.0], 0, 1, "s"),
             (220, [1.0] * 4, None, 1, "s"), (None, [1.0] * 4, 1, 1, "s"), (225, [], 1, 1, "s"), (226, [], 2, 1, "s"), (227, [], 1, 1, "s"), (230, [0.5] * 3, 1, 1, "s"),
             (231, [0.5] * 3, 1, 1, "s"), (232, [0.45] * 3, 0, 1, "s"), (235, [0.0] * 4, 1, 1, "s")]
    return rows + [rows[10], rows[10], rows[33], rows[34]]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_hard_negatives_match_brute_force(spark, block_bytes):
    rows = vectors_of()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, positives=3, negatives=3, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives_with_huge_components(spark):
    big = 2.0**40
    rows = [(0, [big, 1.0], 0, 1, "s"), (1, [2.0**-30, 3.0], 0, 1, "s"), (2, [2.0**-31, 2.75], 1, 1, "s"), (3, [big, big], 2, 1, "s"), (4, [0.01, 3.0], 1, 1, "s")]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 5 == 0, positives=3, negatives=3)
    assert sorted(map(tuple, got.collect())) == mined(rows) != []


def test_hard_negatives_of_no_rows(spark):
    got = hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 5 == 0)
    assert got.columns[0] == "anchor_id" and got.collect() == []


# exact dedup --------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, row string, sha long, h int, keep_id int"


def copies():
    r = random.Random(2)
    base = ["a b c", "ab  c", "\tabc\n", "abc", "x", None, "", " \n\r\x0b\x0c", "Ä b", "Äb", "a b", "ab" * 3000, "a b" * 3000, "word " * 9]
    rows = [(i, r.choice(base), "en", "r", 1, 2, 3) for i in range(120)]
    rows += [(1000 + i, f"only {i}", "de", "r", 1, 2, 3) for i in range(40)]
    return rows + [(7, "twice", "en", "r", 1, 2, 3), (7, "twice", "en", "r", 1, 2, 3), (None, "abc", "en", "r", 1, 2, 3), (None, "alone", None, "r", 1, 2, 3), (5, "abc  ", "en", "r", 1, 2, 3), (4, "abc  ", "en", "r", 1, 2, 3)]


def strip(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def keepers(rows):
    best = {}
    for i, t, *_ in rows:
        order = (-len(t or ""), i is None, i or 0)
        best.setdefault(strip(t), []).append((order, i))
    return {s: (min(v, key=lambda x: x[0])[1], len(v)) for s, v in best.items()}


@pytest.mark.parametrize("words", [exact_dedup.FILTER_WORDS, 1])
def test_exact_dedup_matches_brute_force(spark, words):
    rows, best = copies(), keepers(copies())
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = exact_dedup.groups(df, words=words).collect()
    want = Counter((i, *best[strip(t)], hashlib.sha256(strip(t).encode()).hexdigest()) for i, t, *_ in rows)
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert all(r["id"] == r["keep_id"] for r in kept) and len({r["text_sha256"] for r in kept}) == len(kept) == len(best)
    stay = exact_dedup.deduplicate(df, words=words)
    assert stay.columns == df.columns
    assert Counter((r["doc_id"], strip(r["text"])) for r in stay.collect()) == Counter((i, s) for s, (i, _) in best.items())


def test_unique_rows_pass_without_a_shuffle(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(2000)] + [(5000, "text 1")], "doc_id long, text string").repartition(4)
    keys = exact_dedup.keys_of(df, "doc_id", "text")
    maybe = exact_dedup.flagged(keys, exact_dedup.repeated_filter(keys)).where("maybe")
    assert {1, 5000} <= {r["id"] for r in maybe.collect()}
    assert maybe.count() < 200  # the filter sends few others on
    plan = exact_dedup.groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowPython" not in plan and "MapInArrow" not in plan and "MapInPandas" not in plan


def test_exact_dedup_of_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.groups(none).collect() == [] and exact_dedup.deduplicate(none).collect() == []


# double arrays ------------------------------------------------------------------

def test_double_array_finds_its_keys_and_no_others():
    r = random.Random(4)
    keys = sorted({bytes(r.choice(b"abcdefgh\x00\xff") for _ in range(r.randint(0, 9))) for _ in range(3000)} | {bytes([a, b]) for a in range(256) for b in range(0, 256, 3)} | {b"x" * 4000})
    trie = DoubleArray(np.frombuffer(b"".join(keys), np.uint8), np.cumsum([0, *map(len, keys)]))
    asked = keys + [k + b"q" for k in keys[:500]] + [k[:-1] for k in keys[:500]] + [b"zz", b""]
    offsets = np.cumsum([0, *map(len, asked)])
    got = trie.find(np.frombuffer(b"".join(asked), np.uint8), offsets[:-1], offsets[1:], np.zeros(len(asked), np.int64))
    place = {k: i for i, k in enumerate(keys)}
    assert got.tolist() == [place.get(k, -1) for k in asked]
    slots = np.flatnonzero(trie.check >= 0)
    assert len(slots) == len({k[:i] for k in keys for i in range(1, len(k) + 1)}) + len(keys)


def test_double_array_of_no_keys():
    trie = DoubleArray(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    assert trie.n_keys == 0 and trie.start(b"a") == -1
    assert trie.find(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2]), np.array([0])).tolist() == [-1]


# collocations -------------------------------------------------------------------

TEXTS = "doc_id long, text string, lang string, ids string, word long, n string"


def texts():
    r = random.Random(6)
    common, rare = ["new", "york", "City", "the", "of", "état", "x y", "a-b"], [f"r{i}" for i in range(300)]
    rows = []
    for i in range(90):
        words = []
        for _ in range(r.randint(0, 60)):
            words += r.choice((["New", "York"], ["New", "York", "city"], ["of", "the"], [r.choice(common)], [r.choice(rare)], ["a", "a", "a"]))
        rows.append((i, "".join(w + r.choice((" ", "  ", "\t", ". ", ",", "\n", " ")) for w in words), r.choice(("en", "de", None, "und")), "i", 1, "n"))
    return rows + [(200, None, "en", "i", 1, "n"), (201, "", "fr", "i", 1, "n"), (202, " ,. \n", None, "i", 1, "n"), (203, "w" * 5000 + " tail", "en", "i", 1, "n"), rows[3], rows[3], (None, "of the " * 700, "en", "i", 1, "n")]


def ranked(rows, least, top):
    f, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang in totals:
        found = []
        for p, a in f.items():
            if p[0] != lang or len(p) < 3 or a < least:
                continue
            if len(p) == 3 and any(q[0] == lang and len(q) == 4 and b >= least and 100 * b >= 50 * a and p[1:] in (q[1:3], q[2:4]) for q, b in f.items()):
                continue
            cuts = [(1000000 * a * a // (f[p[:k + 1]] * f[(lang, *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p[1:]).encode(), f[p[:k + 1]], f[(lang, *p[k + 1:])]))
        out += [(lang, i, b.decode(), -a, left, right, totals[lang], -s) for i, (s, a, b, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("keys,tries,slice_bytes", [(1 << 19, 4, 1 << 21), (3, 2, 300)])
def test_collocations_match_brute_force(spark, monkeypatch, keys, tries, slice_bytes):
    """The second case forces several tries, several passes and many slices."""
    monkeypatch.setattr(collocations, "TRIE_KEYS", keys)
    monkeypatch.setattr(collocations, "PASS_TRIES", tries)
    rows = texts()
    df = spark.createDataFrame(rows, TEXTS).repartition(3)
    got = collocations.collocations(df, least=10, top=12)
    assert sorted(map(tuple, got.collect())) == ranked(rows, 10, 12) != []
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_collocations_of_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], TEXTS)).collect() == []


def test_tally_combines_wide_numbers():
    tally = collocations.Tally(3)
    a, b = np.array([1 << 40, 5, 1 << 40, 1 << 40, 1 << 40]), np.array([2, 1 << 33, 2, 2, 2])
    assert list(tally.add(a, b)) == []
    (batch,) = tally.flush()
    assert sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True)) == [(5, 1 << 33, 1), (1 << 40, 2, 3)]


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_exact_dedup", "op13_collocations"])
def test_queries_match_sql(spark, name):
    import duckdb

    from fleetlake.llm import registry
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = registry.queries()[name](spark, sf)
    want = con.sql(registry.oracle_sql()[name])
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


# earlier operators ----------------------------------------------------------------

def test_neighbours_of_vectors_whose_bounds_overflow(spark):
    from fleetlake.llm import block_knn
    rows = [(0, [1e200, 1.0]), (1, [1e120, 2.0]), (2, [-1e120, 3.0]), (3, [1e150, -1.0]), (20, [1.0, 1.0])]
    got = block_knn.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20).collect()
    for q in (0, 20):
        x = dict(rows)[q]
        with np.errstate(over="ignore"):
            want = sorted(((-(x[0] * v[0] + x[1] * v[1]), i) for i, v in rows if i != q))
        assert [(r["vec_id"], -r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, s) for s, i in want]


def test_joins_to_a_hot_key_can_be_split(spark):
    """Under low thresholds the joins of rows to their group's aggregate are skew joins."""
    from fleetlake.llm import components, warc
    from fleetlake.session import scratch_path
    low = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(1, 60000).select(F.lit(60000).cast("long").alias("u"), F.col("id").alias("v")).unionByName(spark.range(1, 400).select((F.col("id") + 100000).alias("u"), F.col("id").alias("v")))
        step = components._star(edges.repartition(6), False)
        step.write.format("noop").mode("overwrite").save()
        step.collect()
        assert "skew=true" in step._jdf.queryExecution().executedPlan().toString()
        found = {r["node"]: r["component"] for r in components.components(edges).collect()}
        assert len(found) == 60399 and set(found.values()) == {1}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    pages = spark.createDataFrame([(i, "u", "same" if i % 3 else f"own {i}") for i in range(60)], "page_id long, url string, html string")
    assert warc.write_archives(pages, scratch_path(spark, "w")).agg(F.sum("records")).first()[0] == 60
