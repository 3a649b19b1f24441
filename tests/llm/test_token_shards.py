"""Token shards on many small partitions, and the encoder on random white space."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import token_shards, tokenizing
from fleetlake.session import scratch_path


@pytest.fixture
def manifest(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.format_string("text of %d, and more", "id").alias("text"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        return token_shards.write_shards(docs, scratch_path(spark, "t-small-shards"))
    finally:
        spark.conf.set(coalesce, "true")


def by_task(manifest):
    rows = token_shards.shard_list(manifest).select(F.spark_partition_id().alias("task"), "shard", "tokens", "base").collect()
    return {t: sorted((r["shard"], r["tokens"], r["base"]) for r in rows if r["task"] == t) for t in {r["task"] for r in rows}}


def test_small_shards_share_a_manifest_file_and_a_reading_task(manifest):
    assert manifest.count() == 8
    assert len(manifest.inputFiles()) == 1
    assert len(by_task(manifest)) == 1
    got = sorted(r["doc_id"] for r in token_shards.read_shards(manifest, 2).collect())
    assert got == list(range(400))


def test_reading_tasks_hold_neighbouring_shards_up_to_a_limit(manifest, monkeypatch):
    total = manifest.agg(F.sum("tokens")).first()[0]
    monkeypatch.setattr(token_shards, "TASK_TOKENS", total // 3)
    tasks = list(by_task(manifest).values())
    assert 3 <= len(tasks) <= 8 and all(sum(n for _, n, _ in t) <= total // 3 or len(t) == 1 for t in tasks)
    flat = sorted(x for t in tasks for x in t)
    assert [s for s, *_ in flat] == list(range(8)) and all([s for s, *_ in t] == list(range(t[0][0], t[-1][0] + 1)) for t in tasks)
    assert [b for *_, b in flat] == [sum(n for _, n, _ in flat[:i]) for i in range(8)]
    assert token_shards.read_shards(manifest, 2).agg(F.sum("n_tokens")).first()[0] == total
    monkeypatch.setattr(token_shards, "TASK_TOKENS", 0)
    assert len(by_task(manifest)) == 8


def test_encoding_of_random_white_space_equals_whole_texts(monkeypatch):
    monkeypatch.setattr(tokenizing, "MEMO_PIECES", 40)
    enc, r = tokenizing.Encoder(tokenizing.vocabulary()), random.Random(5)
    parts = ["a", "B", "é", "日", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", ".", "!?", "%%%", "the", "Zürich", "\0", "　", "😀", "'s", "23", "\x0b", "\x85", "<|endoftext|>"]
    for _ in range(200):
        texts = ["".join(r.choice(parts) for _ in range(r.choice([0, 1, 2, 5, 40]))) for _ in range(r.choice([0, 1, 2, 9]))]
        assert enc.encode(texts) == enc.encode_whole(texts)
