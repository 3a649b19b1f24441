"""Work and memory that must not grow faster than the table."""

import os
import random
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from fleetlake.llm import collocations, suffix_dedup


# suffix-array dedup -------------------------------------------------------------

def test_chance_repeats_are_no_candidates(spark, monkeypatch):
    """Phrases that recur between words of their own hold no repeated window; none of that text travels."""
    r = random.Random(8)
    phrases = ["".join(r.choice("abcdefgh ") for _ in range(40)) for _ in range(5)]
    rows = [(i, "".join(r.choice(phrases) + f"{r.getrandbits(60):015x}" for _ in range(40))) for i in range(30)]
    rows += [(50, rows[0][1][:300] + "x" * 30), (51, rows[1][1])]
    found, real = [], suffix_dedup.occurrences
    monkeypatch.setattr(suffix_dedup, "occurrences", lambda *a: found.append(real(*a)) or found[-1])
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep="first")
    assert {x["doc_id"]: x["n_removed"] for x in got.collect() if x["n_removed"]} == {50: 300, 51: len(rows[1][1])}
    assert {x["k1"] for x in found[0].collect()} == {0, 1, 50, 51}


def test_a_key_is_sorted_about_twice(monkeypatch):
    """A scan's suffix array is not built again to merge, and a key fills larger batches."""
    made = []

    class Counted(suffix_dedup.Level):
        def __init__(self, segs, *args):
            super().__init__(segs, *args)
            made.append(self.bytes)
    monkeypatch.setattr(suffix_dedup, "Level", Counted)
    r = random.Random(9)
    parts = [bytes(r.choices(b"ab", k=30)) for _ in range(20)]
    segs = [b"".join(r.choices(parts, k=4)) for _ in range(100)]
    lo, c = np.arange(100), np.ones(100, np.int64)
    whole = suffix_dedup.level_answers(50, 1 << 20, True)(segs, lo, c, [1] * 100)
    assert made == [12000]
    assert suffix_dedup.level_answers(50, 2000, True)(segs, lo, c, [1] * 100) == whole
    assert sum(made[1:]) < 2.5 * 12000
    for batch in (400, 100):
        assert suffix_dedup.level_answers(50, batch, True)(segs, lo, c, [1] * 100) == whole


# collocations -------------------------------------------------------------------

def test_counts_travel_without_zeros_in_bounded_passes(spark, monkeypatch):
    """Forty tasks that each hold a few of all phrases send those; tries of 1 byte at most go one by one."""
    r = random.Random(10)
    rows = [(i, " ".join(f"w{i}x{r.randrange(60)}" for _ in range(100)), "en") for i in range(40)]
    pairs = Counter(tuple(t.split()[j:j + 2]) for _, t, _ in rows for j in range(99))
    sent, real_cut, real_walk = [], collocations.cut, collocations._walk

    def cut(df, name):
        out = real_cut(df, name)
        if name == "walked":
            files = out.inputFiles()
            sent.append((out.agg(F.sum(F.length("counts"))).first()[0], files[0].rsplit("/", 1)[0].removeprefix("file://")))
        return out
    tries = []
    monkeypatch.setattr(collocations, "cut", cut)
    monkeypatch.setattr(collocations, "_walk", lambda shared, *a: tries.append(len(shared.value)) or real_walk(shared, *a))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartitionByRange(40, "doc_id")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        _, words, found, _ = collocations.phrases(docs, least=1)
        names = {x["no"]: x["word"] for x in words.collect()}
        assert {(names[x["w1"]], names[x["w2"]]): x["f"] for x in found.collect()} == pairs
        assert sent[0][0] < 4 * len(pairs) < 40 * 8 * len(pairs)
        sent.clear(), tries.clear()
        monkeypatch.setattr(collocations, "TRIE_KEYS", 1500)
        monkeypatch.setattr(collocations, "PASS_BYTES", 1, raising=False)
        _, words, found, _ = collocations.phrases(docs, least=1)
        names = {x["no"]: x["word"] for x in words.collect()}
        assert {(names[x["w1"]], names[x["w2"]]): x["f"] for x in found.collect()} == pairs
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert len(tries) > 4 and set(tries) == {1}
    assert sum(os.path.exists(path) for _, path in sent) == 1, "of the passes' streams the last marked one stays"
