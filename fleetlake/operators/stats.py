"""A1-A5: fleet-size statistics per snapshot and per hour.

Plan shape: A1 is a hash aggregate whose partial step runs before the shuffle,
so only one row per (task, snapshot, line) crosses the network however many
vehicle rows a line has; A3/A4/A5 aggregate A1's small output again.  A hot
line or hour therefore never concentrates raw rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import hour_id

LINE_COLUMNS = ("id_linha", "sentido_linha", "let_cod_linha", "let_destino", "let_origem")


def snapshot_per_line(silver: DataFrame) -> DataFrame:
    """A1: buses per line per snapshot = ``max(qtde_onibus)``.

    The line count is repeated on each vehicle row; ``max`` recovers it and
    absorbs duplicate polls of the same minute.
    """
    return (silver.groupBy("data_ref", "hora_ref", hour_id("hora_ref").alias("hora_id_ref"), *LINE_COLUMNS)
            .agg(F.max("qtde_onibus").alias("qtde_onibus")))


def total_per_line(a1: DataFrame) -> DataFrame:
    """A2 (+P5): ``total_onibus_por_linha``."""
    return a1.select("data_ref", "hora_ref", *LINE_COLUMNS, "qtde_onibus")


def hourly_mean_per_line(a1: DataFrame) -> DataFrame:
    """A3: ``media_onibus_por_linha`` = ceil(avg) of A1 per hour and line (bigint)."""
    return (a1.groupBy("data_ref", "hora_id_ref", *LINE_COLUMNS)
            .agg(F.ceil(F.avg("qtde_onibus")).alias("qtde_onibus")))


def network_per_snapshot(a1: DataFrame) -> DataFrame:
    """A4 (before P5): network total per snapshot, keeping the hour column."""
    return (a1.groupBy("data_ref", "hora_id_ref", "hora_ref")
            .agg(F.sum("qtde_onibus").alias("qtde_onibus")))


def total_network(a4: DataFrame) -> DataFrame:
    """A4 + P5: ``total_onibus_geral``."""
    return a4.select("data_ref", "hora_ref", "qtde_onibus")


def hourly_mean_network(a4: DataFrame) -> DataFrame:
    """A5: ``media_onibus_geral`` = ceil(avg) of the snapshot totals per hour."""
    return (a4.groupBy("data_ref", "hora_id_ref")
            .agg(F.ceil(F.avg("qtde_onibus")).alias("qtde_onibus")))


def fleet_statistics(silver: DataFrame) -> dict[str, DataFrame]:
    """The four gold tables of the statistics job, sharing A1 and A4."""
    a1 = snapshot_per_line(silver)
    a4 = network_per_snapshot(a1)
    return {
        "total_onibus_por_linha": total_per_line(a1),
        "total_onibus_geral": total_network(a4),
        "media_onibus_por_linha": hourly_mean_per_line(a1),
        "media_onibus_geral": hourly_mean_network(a4),
    }
