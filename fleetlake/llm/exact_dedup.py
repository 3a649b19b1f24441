"""Exact deduplication with two Bloom passes, in DataFrame functions only.

A text's identity is the SHA-256 of the text without white space (space,
0x09-0x0D).  Its 64-bit hash picks one word of a Bloom filter and ``BITS`` bits
in that word.

1. *Keys.*  One scan of the texts writes a narrow table: id, length, digest.
2. *First pass.*  Rows are counted per Bloom cell (word and bits), combined in
   each task before they travel, so a text that a third of all rows share is one
   row per task.  Cells counted twice hold every repeated text.
3. *Second pass.*  Those cells are OR-ed into the words of a second filter, which
   is broadcast: it has at most ``FILTER_WORDS`` rows, whatever the corpus (more
   repeated texts fill it up, which sends more rows through the shuffle and
   changes no result).  Rows whose bits are not all set are unique and pass
   straight through; only the others meet in a shuffle and are grouped by digest.

A group's totals are aggregated with a partial step in each task and written out
before rows are joined to them, so the join's two sides are plain exchanges that
AQE splits where one digest holds many rows.

Cases: a null text is an empty one; texts of white space alone equal the empty
text; a null id ranks behind all others; of rows equal in length and id the one
with the smaller number given to it when the keys were written stays, so exactly
one row of a group stays; an empty table gives an empty result; other columns
are not read by ``groups`` and are returned as they are by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import cut, table

#: bits that a text sets in its word of the filter
BITS = 4
#: most 64-bit words of the broadcast filter: about 40 bytes each once hashed for the join
FILTER_WORDS = 1 << 20
#: repeated texts a word is sized for: 4 texts set at most 16 of 64 bits
WORD_TEXTS = 4


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", "")


def cell_word(h: Column, words: int) -> Column:
    """Word of a filter of ``words`` (a power of two) words that hash ``h`` falls into."""
    return h.bitwiseAND(F.lit(words - 1))


def cell_bits(h: Column) -> Column:
    """``BITS`` bits of one 64-bit word, from the high bits of ``h``."""
    out = F.lit(0).cast("long")
    for i in range(BITS):
        position = F.shiftrightunsigned(h, 64 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), position))
    return out


def power_of_two(n: float) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def keys_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_no, id, points, sha, h): everything the decision needs, without the text."""
    sha = F.sha2(normalised(F.col(text_col).cast("string")), 256)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"),
                         F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("points"),
                         F.unhex(sha).alias("sha"))
    return narrow.select(F.monotonically_increasing_id().alias("row_no"), "*", F.xxhash64("sha").alias("h"))


def repeated_filter(keys: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """(word, bits, words): the second filter, over the cells that at least two rows share."""
    n = keys.count()
    if n == 0:
        return keys.sparkSession.createDataFrame([], "word long, bits long, words long")
    first = power_of_two(n)
    cells = keys.groupBy(cell_word(F.col("h"), first).alias("word"), cell_bits(F.col("h")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    again = cut(cells.where("n > 1").select("word", "bits"), "bloom-cells")
    # the low bits of the first filter's word are the second's word
    second = min(words, first, power_of_two(again.count() / WORD_TEXTS))
    return (again.groupBy(cell_word(F.col("word"), second).alias("word")).agg(F.bit_or("bits").alias("bits"))
            .select("word", "bits", F.lit(second).cast("long").alias("words")))


def flagged(keys: DataFrame, bloom: DataFrame) -> DataFrame:
    """``keys`` with ``maybe``: false for rows that the filter shows to be unique.

    The filter is a table of at most ``FILTER_WORDS`` rows, cut so that it is built once."""
    bloom = cut(bloom, "bloom")
    size = bloom.agg(F.max("words")).first()[0] or 1
    near = keys.withColumn("word", cell_word(F.col("h"), size))
    hit = F.coalesce(F.col("bits").bitwiseAND(cell_bits(F.col("h"))) == cell_bits(F.col("h")), F.lit(False))
    return near.join(F.broadcast(bloom.select("word", "bits")), "word", "left").withColumn("maybe", hit).drop("word", "bits")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = FILTER_WORDS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, row_no.

    Of equal texts the row with the most code points stays, then the smallest id."""
    keys = cut(keys_of(docs, id_col, text_col), "dedup-keys")
    tested = flagged(keys, repeated_filter(keys, words))
    digest = F.lower(F.hex("sha"))
    alone = tested.where(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                 F.lit(True).alias("kept"), digest.alias("text_sha256"), "row_no")
    together = tested.where("maybe").select("row_no", "id", "points", "sha")
    order = F.struct((-F.col("points")).alias("shortness"), F.col("id").isNull().alias("unnamed"), "id", "row_no")
    totals = cut(together.groupBy("sha").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    met = together.join(totals, "sha").select(
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        digest.alias("text_sha256"), "row_no")
    return alone.unionByName(met)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, whole.

    Unique rows keep their partition; of possibly repeated rows each task sends on
    one per text, so copies are combined before the shuffle."""
    keys = cut(keys_of(docs, id_col, text_col), "dedup-keys")
    bloom = repeated_filter(keys, words)
    t = F.col("row")[text_col].cast("string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    named = rows.select("row", F.col("row")[id_col].cast("long").alias("id"), F.length(F.coalesce(t, F.lit(""))).alias("points"),
                        F.unhex(F.sha2(normalised(t), 256)).alias("sha")).withColumn("h", F.xxhash64("sha"))
    tested = flagged(named, bloom)
    alone = tested.where(~F.col("maybe")).select("row")
    order = F.struct((-F.col("points")).alias("shortness"), F.col("id").isNull().alias("unnamed"), "id", F.to_json("row").alias("all"))
    best = tested.where("maybe").groupBy("sha").agg(F.min_by("row", order).alias("row")).select("row")
    return alone.unionByName(best).select("row.*")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP12_SQL = r"""
WITH named AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM named WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""
