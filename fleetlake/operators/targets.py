"""Hourly means checked against the target table.

The target table (``meta_onibus_por_linha``) has one row per (hour of day,
line): its size is bounded by 24 x lines, independent of how much position data
exists, so it is the side that may be broadcast (after a size check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


RESULT_COLUMNS = ("data_ref", "hora_id_ref", "id_linha", "sentido_linha", "let_cod_linha",
                  "let_destino", "let_origem", "meta_qtde_onibus", "avg_qtde_onibus")


def _avg_side(avg: DataFrame) -> DataFrame:
    """Rename the mean side's columns so the join is unambiguous."""
    return avg.select(F.col("data_ref").alias("avg_data_ref"), F.col("hora_id_ref").alias("avg_hora_id_ref"),
                      F.col("id_linha").alias("avg_id_linha"), F.col("qtde_onibus").alias("avg_qtde_onibus"))


def target_one_hour(meta: DataFrame, avg: DataFrame, data_ref: str, hora_id_ref: str) -> DataFrame:
    """J1 (original one-hour form): every target line of the hour, left-joined
    with that hour's mean; lines never seen get ``avg 0`` (P8).

    The hour literal is on both sides, so both scans prune to one hour.
    """
    meta_h = meta.where(F.col("hora_id_ref") == hora_id_ref)                     # P10
    avg_h = _avg_side(avg.where((F.col("data_ref") == data_ref) & (F.col("hora_id_ref") == hora_id_ref)))
    cond = ((meta_h["hora_id_ref"] == avg_h["avg_hora_id_ref"]) & (meta_h["id_linha"] == avg_h["avg_id_linha"]))
    joined = (meta_h.join(avg_h, cond, "left")
              .drop("avg_hora_id_ref", "avg_id_linha", "avg_data_ref")           # P7
              .withColumn("data_ref", F.lit(data_ref))
              .fillna({"avg_qtde_onibus": 0}))                                   # P8
    return joined.select(*RESULT_COLUMNS)                                       # P9


def processed_hours(avg: DataFrame) -> DataFrame:
    """Hours present in the mean table: one row per (data_ref, hora_id_ref)."""
    return avg.select("data_ref", "hora_id_ref").distinct()


def target_check(meta: DataFrame, avg: DataFrame, hours: DataFrame | None = None) -> DataFrame:
    """J1 for any number of hours (backfill).

    J1's condition has no date; it is only right for a single hour.  Here the
    grid of (processed hour x target lines of that hour of day) is built first –
    an equi-join on ``hora_id_ref`` – and the means are left-joined on the full
    key (date, hour, line).
    """
    hours = processed_hours(avg) if hours is None else hours
    # Spark picks the join from sizes known at run time; no job runs here
    grid = hours.join(meta, "hora_id_ref", "inner")
    means = _avg_side(avg)
    cond = ((grid["data_ref"] == means["avg_data_ref"]) & (grid["hora_id_ref"] == means["avg_hora_id_ref"])
            & (grid["id_linha"] == means["avg_id_linha"]))
    joined = (grid.join(means, cond, "left")
              .drop("avg_data_ref", "avg_hora_id_ref", "avg_id_linha")
              .fillna({"avg_qtde_onibus": 0}))
    return joined.select(*RESULT_COLUMNS)


def lines_reached(checked: DataFrame) -> DataFrame:
    """Mean >= target; a NULL target drops the line."""
    return checked.where(F.col("avg_qtde_onibus") >= F.col("meta_qtde_onibus"))


def lines_below(checked: DataFrame) -> DataFrame:
    """Mean < target."""
    return checked.where(F.col("avg_qtde_onibus") < F.col("meta_qtde_onibus"))


def count_lines(lines: DataFrame) -> DataFrame:
    """Lines per (date, hour); ``count(sentido_linha)`` skips NULL directions.

    An hour with no qualifying line has no row (G9), as in the original.
    """
    return lines.groupBy("data_ref", "hora_id_ref").agg(F.count("sentido_linha").alias("qtde_linhas"))


def lines_without_bus(checked: DataFrame) -> DataFrame:
    """Per hour, target lines that had no bus at all (mean 0)."""
    return (checked.where(F.col("avg_qtde_onibus") == 0)
            .groupBy("data_ref", "hora_id_ref").agg(F.count(F.lit(1)).alias("qtde_linhas")))


def target_outputs(checked: DataFrame) -> dict[str, DataFrame]:
    reached, below = lines_reached(checked), lines_below(checked)
    return {
        "linhas_atingida_meta": reached,
        "total_linhas_atingida_meta": count_lines(reached),
        "linhas_abaixo_meta": below,
        "total_linhas_abaixo_meta": count_lines(below),
    }
