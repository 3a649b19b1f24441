"""The operators against brute force on small tables with nulls, empty and long
texts, ties, repeated rows, clashing column names and no rows at all."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import block_knn, decontaminate, dup_windows, jaccard_join, quality, substring_dedup, suffix_dedup, token_shards, warc
from fleetlake.llm.chat import preference_pairs
from fleetlake.llm.components import components
from fleetlake.llm.fm_index import FMIndex
from fleetlake.llm.packing import pack, padded_length
from fleetlake.llm.tokenizing import Encoder, vocabulary
from fleetlake.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, k1 long, row string, component_id int, n_chars long"


def rows_of(seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Éa", "the,", "x%%%", "中文。", "it's", "a\tb"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    long_, base, shared = text(3000), text(120), text(70)
    out = [(i, text(r.randint(1, 90))) for i in range(12)]
    out += [(20, base), (21, base), (22, base + " tail"), (23, "head " + base), (24, base.upper()), (25, shared + " " + text(30)), (26, text(20) + "\n" + shared)]
    out += [(30, long_), (31, long_[:-40] + " end"), (40, None), (41, ""), (42, " \n\t "), (43, "one"), (44, "one two"), (45, "ONE two"), (46, "ab " * 150), (46, "ab " * 150),
            (47, "<|endoftext|> a  b"), (None, base), (None, "lonely words here")]
    return [(i, t, "en", 7, "r", 1, 0) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return x[0] is not None, x[0] or 0, *map(str, x[1:])


def ordered(texts):
    return sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))


# tokens -----------------------------------------------------------------------

def ids_of(text, enc=Encoder(vocabulary())):
    return np.array([*enc.tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_memoised_encoding_equals_whole_texts():
    enc = Encoder(vocabulary())
    texts = [t for _, t, *_ in rows_of()] + ["  a b", "a\tb c", "a \t b", " x ", "a\n\nb", "hi<|endoftext|>. a", "x,, y.. z!!. Don't, 5. ²! a<|endoftext|>!!", "é** _d_ it'. b'\" can't!!"]
    for _ in range(2):
        assert enc.encode(texts) == enc.encode_whole([t or "" for t in texts])


def test_token_shards_round_trip(spark, docs, none):
    manifest = token_shards.write_shards(docs, scratch_path(spark, "t-shards"))
    got = sorted(map(tuple, token_shards.read_shards(manifest, 2).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    ids = sorted(((i, len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for i, t, *_ in rows_of()), key=key)
    assert sorted(((g[1], g[2], g[3]) for g in got), key=key) == ids
    assert [g[0] for g in got] == list(np.cumsum([0, *(g[2] for g in got)])[:-1])
    assert [g[1] is not None and g[1] for g in got] == [i is not None and i for i, *_ in ids]  # ascending, nulls first
    found = token_shards.lookup(manifest, spark.createDataFrame([(46,), (30,), (999,), (None,)], "doc_id long"), 2).collect()
    assert sorted((r["key"], r["ids"]) for r in found) == sorted((i, ids_of(t).tolist()) for i, t, *_ in rows_of() if i in (46, 30))
    empty = token_shards.write_shards(none, scratch_path(spark, "t-shards"))
    assert token_shards.read_shards(empty, 2).count() == 0


def test_perfect_hash_is_minimal_and_refuses_strangers():
    keys = np.unique(np.random.default_rng(1).integers(-2**62, 2**62, 5000))
    made = token_shards.PerfectHash.load(token_shards.PerfectHash.build(keys).dump())
    assert sorted(made.slots(keys)) == list(range(len(keys)))
    assert (made.slots(keys[:1000] + 1) < 0).mean() > 0.99
    assert (token_shards.PerfectHash.build(keys[:0]).slots(keys[:3]) == -1).all()


def test_packing_cuts_one_stream(docs, none):
    got = sorted(pack(docs, 64).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    stream = np.concatenate([ids_of(t) for _, t in sorted([(i, t) for i, t, *_ in rows_of()], key=lambda x: (x[0] is not None, x[0] or 0))])
    assert sum(r["length"] for r in got) == len(stream)
    at = 0
    for r in got:
        assert r["sequence_id"] * 64 + r["offset"] == at and r["offset"] + r["length"] <= 64
        at += r["length"]
    whole = {}
    for r in got:
        whole.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for i, t, *_ in rows_of():
        if i is not None and i != 46:
            ids, p = ids_of(t), 0
            for start, n, crc, total in sorted(whole[i]):
                assert (start, crc, total) == (p, zlib.crc32(ids[p:p + n].tobytes()), len(ids))
                p += n
            assert p == len(ids)
    assert pack(none).count() == 0
    assert (padded_length(1000), padded_length(512)) == (1024, 512)


# windows ----------------------------------------------------------------------

def words_kept(texts, length):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in texts]
    for i, w in sorted((x for x in split if x[0] is not None), key=lambda x: x[0]):
        for j in range(len(w) - length + 1):
            first.setdefault(tuple(w[j:j + length]), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - length + 1) if i is not None else ():
            if first[tuple(w[j:j + length])] < i:
                gone[j:j + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize(("length", "index_words"), [(50, 1_000_000), (8, 200)])
def test_substring_dedup(docs, none, length, index_words):
    texts = [(i, t) for i, t, *_ in rows_of()]
    got = substring_dedup.substring_dedup(docs, length, index_words=index_words).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=key) == words_kept(texts, length)
    assert substring_dedup.substring_dedup(none, length).count() == 0


def bytes_kept(texts, length, first):
    raw = [(i, (t or "").encode()) for i, t in texts]
    count, least = {}, {}
    for i, b in raw:
        for j in range(len(b) - length + 1):
            count[b[j:j + length]] = count.get(b[j:j + length], 0) + 1
            if i is not None:
                least[b[j:j + length]] = min(i, least.get(b[j:j + length], i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            w = b[j:j + length]
            if (i is not None and least[w] < i) if first else count[w] > 1:
                gone[j:j + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize(("length", "keep", "batch"), [(200, "none", 1 << 17), (40, "none", 900), (200, "first", 1 << 17), (24, "first", 700)])
def test_suffix_dedup(docs, none, length, keep, batch):
    texts = [(i, t) for i, t, *_ in rows_of()]
    got = suffix_dedup.suffix_dedup(docs, length, keep, batch_bytes=batch).drop("kept").collect()
    assert sorted(map(tuple, got), key=key) == bytes_kept(texts, length, keep == "first")
    assert suffix_dedup.suffix_dedup(none, length, keep).count() == 0


def near_copies():
    r = random.Random(4)
    base = [f"v{r.randint(0, 500)}" for _ in range(90)]
    texts = [(100 + i, " ".join(base[r.randint(0, 9):i + 12] + ["edit"] * (i % 3) + [f"e{i % 7}"] + base[i + 12:90 - r.randint(0, 9)])) for i in range(60)]
    return [(i, t) for i, t, *_ in rows_of()] + texts + [texts[5], (None, texts[6][1])]


@pytest.mark.parametrize(("module", "make"), [(substring_dedup, "fm_answers"), (suffix_dedup, "level_answers")])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_no_task_gathers_a_large_key(spark, monkeypatch, module, make, keep):
    made = getattr(module, make)

    def bounded(*args):
        index = made(*args)

        def run(segs, lo, c, keys):
            assert max(map(keys.count, keys)) <= 6, "one task gathers a large key"
            return index(segs, lo, c, keys)
        return run
    monkeypatch.setattr(module, make, bounded)
    monkeypatch.setattr(dup_windows, "KEY_SEGMENTS", 6)
    texts = near_copies()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    if module is substring_dedup:
        got = substring_dedup.substring_dedup(docs, 8).drop("kept_text")
        assert sorted(map(tuple, got.collect()), key=key) == words_kept(texts, 8)
    else:
        got = suffix_dedup.suffix_dedup(docs, 40, keep).drop("kept")
        assert sorted(map(tuple, got.collect()), key=key) == bytes_kept(texts, 40, keep == "first")


@pytest.mark.parametrize("unit", ["word", "byte"])
def test_finer_segments_hold_every_window_once(unit):
    """Parts of a segment partition its windows, and equal windows have equal keys."""
    length = 8 if unit == "word" else 40
    scheme = dup_windows.Scheme(unit, length, length - 2, 3, 5, 1 << 20)
    segs = [t.encode() for _, t in near_copies()[-9:] if t] + [b"ab " * 50 + b"ab"]
    split = (lambda x: x.split(b" ")) if unit == "word" else (lambda x: list(x))
    batch = pa.RecordBatch.from_arrays([pa.array([str(i).encode() for i in range(len(segs))], pa.binary()), pa.array(segs, pa.binary()),
                                        pa.array(range(len(segs)), pa.int64()), pa.array([1] * len(segs), pa.int64())], ["digest", "seg", "lo", "c"])
    for gram in (length * 7 // 8, length):
        seen, keys = [], {}
        for r in (r for b in dup_windows._finer_rows(scheme, gram)(iter([batch])) for r in b.to_pylist()):
            units = split(r["seg"])
            own = int(r["parent"])
            assert units == split(segs[own])[r["pos"]:r["pos"] + len(units)] and r["lo"] == own and len(units) - length < 5
            for j in range(len(units) - length + 1):
                seen.append((own, r["pos"] + j))
                keys.setdefault(tuple(units[j:j + length]), set()).add(r["key"])
        assert sorted(seen) == [(i, j) for i, x in enumerate(segs) for j in range(len(split(x)) - length + 1)]
        assert all(len(k) == 1 for k in keys.values())


def test_without_repeats_keeps_columns(docs):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.where("doc_id IS NOT NULL").collect()}
    assert texts[20] == dict((i, t) for i, t, *_ in rows_of())[20] and 21 not in texts and 40 in texts


def test_fm_index_matching_statistics():
    r = np.random.default_rng(2)
    segs = [r.integers(1, 4, 30) for _ in range(5)]
    fm = FMIndex(segs, 5, 6)
    query = np.append(r.integers(1, 5, 80), segs[2][3:20])
    got = np.zeros(len(query), int)
    for _, start, n, _ in fm.matching([query]):
        got[start] = n[0]
    texts = [tuple(s) for s in segs]
    for i in range(len(query)):
        best = 0
        while best < 6 and i + best < len(query) and any(tuple(query[i:i + best + 1]) == t[k:k + best + 1] for t in texts for k in range(30 - best)):
            best += 1
        assert got[i] == best


# sets -------------------------------------------------------------------------

def groups_of(texts, k, num, den):
    lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    sets = []
    for i, t in texts:
        w = (t or "").encode().translate(lower).split()
        sets.append((i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}))
    up = {i: i for i, _ in texts if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                p, q = sorted((root(i), root(j)))
                up[q] = p
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=key)


@pytest.mark.parametrize(("k", "num", "den", "tile"), [(3, 90, 100, 1000), (5, 8, 10, 2)])
def test_jaccard_groups(docs, none, monkeypatch, k, num, den, tile):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    texts = [(i, t) for i, t, *_ in rows_of()]
    assert sorted(map(tuple, jaccard_join.jaccard_groups(docs, k, num, den).collect()), key=key) == groups_of(texts, k, num, den)
    assert jaccard_join.jaccard_groups(none, k, num, den).count() == 0


def test_one_per_group(docs):
    out = jaccard_join.one_per_group(docs)
    assert out.columns == docs.columns
    left = [r["doc_id"] for r in out.collect()]
    want = {c for i, _, c in groups_of([(i, t) for i, t, *_ in rows_of()], 5, 8, 10) if i is not None}
    assert sorted(x for x in left if x is not None) == sorted(want) and left.count(None) == 2


def test_signatures_lose_no_link():
    r = np.random.default_rng(5)
    for num, den in ((9, 10), (8, 10)):
        for n in (1, 2, 5, 9, 10, 19, 20, 40, 133, 500, 1700):
            for _ in range(12):
                a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
                b = a[r.random(len(a)) > r.random() * 0.12]
                b = np.unique(np.concatenate((b, r.integers(0, 2**63, int(n * r.random() * 0.08)).astype(np.uint64))))
                both = len(np.intersect1d(a, b))
                if len(b) and den * both >= num * (len(a) + len(b) - both):
                    assert len(np.intersect1d(jaccard_join.signatures(a, num, den), jaccard_join.signatures(b, num, den)))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(5, 5), (200, 150)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(20)} | {200: 150, 150: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# the rest -----------------------------------------------------------------------

def test_decontamination(spark, docs, none):
    items = [(1, "What is the name of the river in the far north of that land? It is the great grey river."), (2, None), (3, " "), (4, "tiny item"), (None, "One two three four five six seven eight nine ten eleven twelve"),
             (5, "w1 unrelated words of an item that no document holds at all, it seems.")]
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, doc_id string")
    pad = "some other words come first and then more " * 30
    texts = [(1, pad + items[0][1].upper() + " " + pad), (2, pad), (3, "a tiny item indeed"), (4, items[4][1].replace("six", "6")), (5, items[4][1]), (6, None), (7, ""),
             (None, items[0][1]), (8, "What is the name of the river in the far north of that land? Nobody knows.")]
    table = spark.createDataFrame([(*x, "c") for x in texts], "doc_id long, text string, item_id string")
    got = decontaminate.contaminated(table, bench).collect()
    assert sorted(((r[0], r[1]) for r in got), key=str) == sorted([(1, 1), (3, 4), (5, None), (None, 1)], key=str)
    clean = decontaminate.decontaminate(table, bench)
    assert clean.columns == table.columns and sorted(r[0] for r in clean.collect()) == [2, 4, 6, 7, 8]
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0


def lowered(text):
    return text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()


def share_held(a, b, k=5):
    """Part of the distinct shingles of words ``a`` that words ``b`` hold."""
    k = min(k, len(a))
    own = {tuple(a[i:i + k]) for i in range(len(a) - k + 1)}
    return len(own & {tuple(b[i:i + k]) for i in range(len(b) - k + 1)}) / len(own)


def is_hit(item, text, longest):
    """Some passage of ``text`` holds 0.8 of the item, or of its question and of its answer."""
    a, b = lowered(item), lowered(text)
    question, answer = map(lowered, decontaminate.split_item(item))
    assert question + answer == a
    for start in range(0, max(1, -(-len(b) // longest) - 2) * longest, longest):
        some = b[start:start + 3 * longest]
        if share_held(a, some) >= 0.8 or share_held(question, some) >= 0.8 and (not answer or share_held(answer, some, 5 if len(answer) > 9 else 1) >= 0.8):
            return True
    return False


def test_decontamination_of_one_word_edits(spark):
    bench = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    pad, edits = "some other words come first " * 20, []
    for item, text in items.items():
        w = text.split()
        for i in range(len(w)):
            edits += [(item, w[:i] + ["changed"] + w[i + 1:]), (item, w[:i] + w[i + 1:]), (item, w[:i] + ["put", "in"] + w[i:])]
    edits = [(n, item, pad[:n % 500] + " " + " ".join(w) + " " + pad) for n, (item, w) in enumerate(edits)]
    longest = max(len(x.split()) for x in items.values())
    want = {(n, item) for n, item, text in edits if is_hit(items[item], text, longest)}
    table = spark.createDataFrame([(n, text) for n, _, text in edits], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()}
    assert len(want) > 15000 and got == want


def test_decontamination_of_every_item_and_document(spark):
    bench, docs = (spark.read.parquet(f"/root/testdata/sf0.001/{x}.parquet") for x in ("benchmark", "documents"))
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in docs.orderBy("doc_id").limit(120).collect()]
    for n, (i, t) in enumerate(texts[:40]):  # one item with one word changed in each
        item, w = items[n], items[n].split()
        w[n * 7 % len(w)] = "changed"
        texts[n] = (i, t[:3000] + " " + " ".join(w) + " " + t[3000:])
    longest = max(len(x.split()) for x in items.values())
    want = {(i, item) for i, t in texts for item, x in items.items() if is_hit(x, t, longest)}
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()}
    left = {r["doc_id"] for r in decontaminate.decontaminate(table, bench).collect()}
    assert len(want) > 15 and got == want and left == {i for i, _ in texts} - {i for i, _ in want}


def test_decontamination_without_the_rare_words(spark):
    common = " ".join(f"c{i}" for i in range(40))
    items = [f"{common} " + " ".join(f"r{j}x{i}" for i in range(10)) for j in range(30)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    table = spark.createDataFrame([(j, "x " * j + " ".join(t.split()[:-9]) + " y" * 99) for j, t in enumerate(items)], "doc_id long, text string")
    assert {share_held(t.split(), t.split()[:-9]) for t in items} == {37 / 46}
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect())
    assert got == [(j, j) for j in range(30)]


def test_question_and_answer_apart_are_a_hit(spark):
    """Both parts stand in the passage with other words between them; neither alone is a hit."""
    r = random.Random(8)
    word = lambda: f"q{r.randint(0, 400)}"
    items = [" ".join(word() for _ in range(r.randint(6, 20))) + "? " + " ".join(f"a{r.randint(0, 90)}" for _ in range(r.randint(1, 14))) + "." for _ in range(60)]
    items += ["What\u00a0is? It\u00a0is.\u00a0So it is, and so it stays.", "one"]
    longest = max(len(x.split()) for x in items)
    texts = []
    for i, item in enumerate(items):
        question, answer = decontaminate.split_item(item)
        texts += [f"{question} so they say {answer}", answer + " pad " * (i % 9) + question, question, answer, question + " pad" * (4 * longest) + " " + answer]
        w = question.split()
        w[i % len(w)] = "edit"
        texts.append(" ".join(w) + " or rather " + answer)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {(i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if is_hit(x, t, longest)}
    whole = {(i, j) for i, j in want if share_held(lowered(items[j]), lowered(texts[i])) >= 0.8}
    assert {(r[0], r[1]) for r in decontaminate.contaminated(table, bench).collect()} == want and len(want - whole) > 60
    assert {r[0] for r in decontaminate.decontaminate(table, bench).collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_decontamination_in_passes(spark, monkeypatch):
    """A small budget takes many passes: one is held at a time, and hits do not change."""
    bench, docs = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("benchmark", "documents"))
    docs = docs.withColumn("shard", F.lit(1)).withColumn("at", F.lit("x"))
    once = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    log, gather, write = [], decontaminate.matcher, decontaminate.cut
    monkeypatch.setattr(decontaminate, "matcher", lambda shards: log.append("read") or gather(shards))
    monkeypatch.setattr(decontaminate, "cut", lambda df, name: log.append(name) or write(df, name))
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 300)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 100)
    got = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    # items of other lengths stand together, so passages and scores' windows differ; the pairs do not
    assert once and [x[:2] for x in got] == [x[:2] for x in once]
    assert log[0] == "bm25" and len(log) > 6 and log[1:] == ["read", "hits"] * (len(log) // 2)
    log.clear()
    left = decontaminate.decontaminate(docs, bench)
    assert log[0] == "bm25" and log[1:] == (["read", "clean"] * len(log))[:len(log) - 1] and log[-1] == "read"
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] not in {x[0] for x in once})


def test_preference_pairs(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", None), (2, 0, None, "alone"),
             (4, 0, "user", "a"), (5, 0, "user", "a"), (None, 0, "user", "x")]
    got = {r["pair_id"]: r for r in preference_pairs(spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, p int")).collect()}
    assert sorted(got) == [0, 1, 2]
    r = got[0]
    assert r["prefix_turns"] == 1 and r["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and r["chosen"] == "<|im_start|>assistant\nyes<|im_end|>\n"
    assert [r["rejected"][a:b] for a, b in r["rejected_mask"]] == ["no"] and [r["chosen"][a:b] for a, b in r["chosen_mask"]] == ["yes"]
    assert got[1]["rejected_id"] is None and got[1]["prefix_turns"] == 0 and got[1]["chosen"].endswith("alone<|im_end|>\n") and got[1]["chosen_mask"] == []
    assert got[2]["prefix_turns"] == 1 and got[2]["chosen"] == got[2]["rejected"] == ""


def test_warc_round_trip_and_history(spark):
    pages = [(3, "http://b.example.com/x?y#z", "same é"), (1, "https://www.a.example.com:443/", "same é"), (2, None, None), (5, "http://a.example.com/", ""), (5, "http://a.example.com/", ""),
             (9, "bad\r\nurl", "q" * 3_000_000), (None, "http://b.example.com/x", "same é"), (None, "http://n/", "only here")]
    table = spark.createDataFrame([(*p, "f") for p in pages], "page_id long, url string, html string, file string").repartition(3)
    got = warc.capture_history(warc.write_archives(table, scratch_path(spark, "t-warc"))).collect()
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        least = min((p for p, _, x in pages if (x or "") == (h or "") and p is not None), default=None)
        revisit = least is not None and least != i
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", least if revisit else None))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=key) == sorted(want, key=key)
    assert [(r["url_key"], r["captured"]) for r in got] == sorted((r["url_key"], r["captured"]) for r in got)
    assert warc.capture_history(warc.write_archives(table.limit(0), scratch_path(spark, "t-warc"))).count() == 0


def test_loser_tree_merges():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(r.randint(0, 50) for _ in range(r.randint(0, 9))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs], lambda x: x)) == sorted(x for run in runs for x in run)


def test_nearest_neighbours(spark):
    r = np.random.default_rng(4)
    x = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(r.normal(size=(90, 8)) * r.choice([0.01, 1, 50], (90, 1)))]
    x += [(100, x[3][1]), (101, x[3][1]), (101, x[3][1]), (120, None), (140, []), (160, [0.0] * 8), (180, [float("nan")] * 8), (200, [None] + [1.0] * 7), (220, [float("inf")] + [1.0] * 7),
          (None, x[5][1]), (240, [1.0, 2.0]), (241, [2.0, 1.0])]
    table = spark.createDataFrame([(*v, 1) for v in x], "vec_id long, embedding array<float>, rank int").repartition(3)
    got = sorted((q, k, v, s) for q, k, v, s in block_knn.nearest(table, F.col("vec_id") % 20 == 0, 5).collect())
    sound = [(i, np.array(v, np.float64)) for i, v in x if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    want = []
    for q, a in sound:
        if q % 20 == 0:
            near = sorted(((block_knn.inner(a[None], b[None])[0], -i) for i, b in sound if i != q and len(a) == len(b)), reverse=True)[:5]
            want += [(q, k + 1, -i, s) for k, (s, i) in enumerate(near)]
    assert got == sorted(want)
    assert block_knn.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quality_learns_and_handles_cases(spark, docs, none):
    r = random.Random(2)
    good, bad = ["the", "of", "and", "river", "house", "walks", "slowly"], ["!!!", "BUY", "NOW", "%%%", "free$$$", "click"]
    texts = [(i, " ".join(r.choice(good if i % 3 else bad) for _ in range(40)), int(i % 3 > 0)) for i in range(600)]
    table = spark.createDataFrame(texts, "doc_id long, text string, y int")
    labels = table.select("doc_id", F.col("y").alias("quality"), F.lit("x").alias("text"))
    pooling, network = quality.fit(table, labels)
    held = quality.score(table, pooling, network).where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    assert np.mean([(x["_score"] >= 0.3) == (x["y"] == 1) for x in held]) > 0.97
    odd = quality.score(docs, pooling, network).collect()
    assert len(odd) == docs.count() and all(0 <= x["_score"] <= 1 for x in odd)
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.accepted(docs, labels.limit(0)).count() == docs.count()  # no labels: 0.5
    assert quality.accepted(none, labels).count() == 0


def test_quality_against_brute_force(spark, docs):
    """Co-occurrence sums, pooling and score, token by token; the fit whatever the partitions."""
    where, sign = quality.index_vectors()

    def buckets(text):
        found = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+", (text or "").encode())
        return [int(quality.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] % np.uint64(quality.BUCKETS)) for w in found]

    texts = [x["text"] for x in docs.collect()]
    sums, seen = np.zeros((quality.BUCKETS, quality.DIM)), np.zeros(quality.BUCKETS)
    for own in map(buckets, texts):
        for i, b in enumerate(own):
            seen[b] += 1
            for j in {i - 2, i - 1, i + 1, i + 2} & set(range(len(own))):
                for e in range(quality.ENTRIES):
                    sums[b, where[own[j], e]] += sign[own[j], e]
    sums -= np.outer(seen, sums.sum(axis=0) / seen.sum())
    length = np.linalg.norm(sums, axis=1)
    words = sums / np.where(length > 0, length, 1)[:, None]
    vectors, counts = quality.word_vectors(docs.select("text"))
    assert np.array_equal(counts, seen) and np.allclose(vectors, words, atol=1e-5)

    labels = docs.where("doc_id IS NOT NULL").select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    pooling, network = quality.fit(docs, labels)
    weight = 1e-3 / (1e-3 + seen / seen.sum())
    wanted = {}
    for text in texts:
        own, x = buckets(text), np.zeros(quality.FEATURES)
        if own:
            for k, some in enumerate((own, sorted(set(own)))):
                x[k * quality.DIM:(k + 1) * quality.DIM] = sum(weight[b] * words[b] for b in some) / sum(weight[b] for b in some)
            x[-2:] = np.log1p(len(own)), len(set(own)) / len(own)
        hidden = [max(0.0, float(((x - network.mean) / network.scale) @ network.w1[:, k] + network.b1[k])) for k in range(quality.HIDDEN)]
        z = (sum(h * w for h, w in zip(hidden, network.w2, strict=True)) + network.b2) / network.temperature
        wanted[text] = 1 / (1 + np.exp(-z))
    for x in quality.score(docs, pooling, network).collect():
        assert abs(x["_score"] - wanted[x["text"]]) < 1e-3

    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("other words "), "doc_id"))).unionByName(docs)
    one, two = (quality.fit(twice.repartition(n, "text"), labels, bound=20)[1] for n in (2, 7))
    assert np.array_equal(one.w1, two.w1) and np.array_equal(one.w2, two.w2) and one.temperature == two.temperature
