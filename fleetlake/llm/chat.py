"""Preference formatting of conversation pairs.

Conversations 2i (chosen) and 2i+1 (rejected) form pair i, unless the caller
gives pairs.  Turns of both sides are aligned by position; the longest common
prefix ends before the first position whose role or text differs or where one
side has no turn.  The prefix is rendered once as the prompt; the rest of each
side is its completion, with a mask of [start, end) character spans over the
contents of assistant turns: only these are trained on.

All of it is declarative: turns are positions by id, the prefix length is one
grouped minimum, and rendering is an ordered aggregation per pair.

Cases: a null text is an empty text and a null role the empty role; turns that
repeat a position are ordered by role and text; rows with a null conversation id
take no part; a null turn comes first; a pair with one side only has a null id
for the other side, an empty prompt and the whole side as completion; a
completion without assistant turns has an empty mask; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def preference_pairs(turns: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, prefix_turns, prompt, chosen, chosen_mask,
    rejected, rejected_mask).  ``pairs``: (pair_id, chosen_id, rejected_id)."""
    rows = turns.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("t"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("r"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("x")).where("c IS NOT NULL")
    if pairs is None:
        sided = rows.withColumn("p", F.floor(F.col("c") / 2)).withColumn("side", F.pmod("c", F.lit(2)).cast("int"))
    else:
        both = pairs.select(F.col("pair_id").cast("long").alias("p"), F.posexplode(F.array("chosen_id", "rejected_id")).alias("side", "c"))
        sided = rows.join(both, "c")
    placed = sided.withColumn("i", F.row_number().over(Window.partitionBy("p", "side").orderBy(F.col("t").asc_nulls_first(), "r", "x")) - 1)
    # the same turn on both sides gives one group of two; the first position without one ends the prefix
    shared = placed.groupBy("p", "i").agg((F.count_distinct("side") == 2).alias("two"), (F.count_distinct("r", "x") == 1).alias("one"))
    ends = shared.groupBy("p").agg(F.min(F.when(~(F.col("two") & F.col("one")), F.col("i"))).alias("stop"), (F.max("i") + 1).alias("all"))
    ends = ends.select("p", F.coalesce("stop", "all").cast("int").alias("prefix_turns"))
    piece = F.concat(F.lit(OPEN), "r", F.lit("\n"), "x", F.lit(CLOSE))
    marked = placed.join(ends, "p").select(
        "p", "side", "c", "i", "prefix_turns", piece.alias("piece"), (F.col("r") == "assistant").alias("train"),
        (F.length("r") + len(OPEN) + 1).alias("skip"), F.length("x").alias("size"))
    whole = marked.groupBy("p", "prefix_turns").agg(
        *(F.max(F.when(F.col("side") == s, F.col("c"))).alias(n) for s, n in ((0, "chosen_id"), (1, "rejected_id"))),
        F.array_sort(F.collect_list(F.struct("side", "i", "piece", "train", "skip", "size"))).alias("turns"))

    def part(cond) -> F.Column:
        return F.filter("turns", cond)

    def text(items) -> F.Column:
        return F.array_join(F.transform(items, lambda t: t["piece"]), "")

    def mask(items) -> F.Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("spans"))
        step = lambda acc, t: F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            F.when(t["train"], F.concat(acc["spans"], F.array(F.array(acc["at"] + t["skip"], acc["at"] + t["skip"] + t["size"])))).otherwise(acc["spans"]).alias("spans"))
        return F.aggregate(items, start, step, lambda acc: acc["spans"])

    n = F.col("prefix_turns")
    first = F.when(F.col("chosen_id").isNull(), 1).otherwise(0)

    def rest(side: int) -> F.Column:
        return part(lambda t: (t["side"] == side) & (t["i"] >= n))

    sides = rest(0), rest(1)
    return whole.select(
        F.col("p").alias("pair_id"), "chosen_id", "rejected_id", "prefix_turns",
        text(part(lambda t: (t["side"] == first) & (t["i"] < n))).alias("prompt"),
        text(sides[0]).alias("chosen"), mask(sides[0]).alias("chosen_mask"), text(sides[1]).alias("rejected"), mask(sides[1]).alias("rejected_mask"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs; masks as text, ``start-end`` joined by commas."""
    out = preference_pairs(table(spark, sf_dir, "conversations"))
    for c in ("chosen_mask", "rejected_mask"):
        out = out.withColumn(c, F.array_join(F.transform(c, lambda s: F.concat_ws("-", s[0].cast("string"), s[1].cast("string"))), ","))
    return out


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id AS c, conv_id // 2 AS p, conv_id % 2 AS side, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL),
aligned AS (
  SELECT p, i, count(DISTINCT side) = 2 AND count(DISTINCT {'r': r, 'x': x}) = 1 AS same FROM rows GROUP BY p, i),
ends AS (
  SELECT p, coalesce(min(i) FILTER (WHERE NOT same), max(i) + 1) AS n FROM aligned GROUP BY p),
pieces AS (
  SELECT rows.*, n, '<|im_start|>' || r || chr(10) || x || '<|im_end|>' || chr(10) AS piece FROM rows JOIN ends USING (p)),
placed AS (
  SELECT *, coalesce(sum(length(piece)) FILTER (WHERE i >= n) OVER (PARTITION BY p, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length(r) + 13 AS a FROM pieces)
SELECT p AS pair_id, max(c) FILTER (WHERE side = 0) AS chosen_id, max(c) FILTER (WHERE side = 1) AS rejected_id, n::INTEGER AS prefix_turns,
  coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE side = 0 AND i < n), '') AS prompt,
  coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE side = 0 AND i >= n), '') AS chosen,
  coalesce(string_agg(a::BIGINT || '-' || (a + length(x))::BIGINT, ',' ORDER BY i) FILTER (WHERE side = 0 AND i >= n AND r = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE side = 1 AND i >= n), '') AS rejected,
  coalesce(string_agg(a::BIGINT || '-' || (a + length(x))::BIGINT, ',' ORDER BY i) FILTER (WHERE side = 1 AND i >= n AND r = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY p, n
"""
