"""Keyed upsert as a DataFrame plan (``INSERT .. ON CONFLICT DO UPDATE``).

Semantics kept: new keys are inserted, existing keys get all non-key columns
replaced (NULLs included), nothing is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_frames(target: DataFrame, stage: DataFrame, keys) -> DataFrame:
    """Rows of ``target`` whose key is not staged (anti-join), plus every staged row."""
    keys = list(keys)
    stage = stage.select(*target.columns)
    kept = target.join(stage.select(*keys), keys, "left_anti")
    return kept.unionByName(stage)


def latest_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """Optional dedup ahead of an upsert: keep the last row per key.

    The explicit alternative to failing on duplicate keys; ``order_cols`` must
    make the choice deterministic.  Written as a ``max_by`` aggregate rather
    than a ``row_number`` window: the aggregate combines map-side, so a key
    with very many rows never has to be sorted inside one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    # the whole row last: equal order values still give one defined row
    order = F.struct(*[F.col(c) for c in [*order_cols, *rest]])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
