"""Q1-Q13: the dashboard queries as parameterised DataFrame functions.

Each function reads one gold table (a DataFrame) and the panel's parameters:
the time range (``time_from``/``time_to``, UTC), the fixed shift between the
stored local time and UTC (``shift_hours``, 3 in the newer dashboard, 0 in the
older one), limits and sort direction.  Output columns use plain names.

Sort decisions (documented deviations):
* top-k panels add the line label (then id) as the last sort key, so ties at
  one timestamp give a determined result (T2-T4);
* the mean-network panels sort by the timestamp, not by its day-first text
  (T6/T7: the text order is wrong across months);
* descending sorts put NULLs last explicitly (G12).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import (_as_dt, date_plus_hours, display_text, ref_timestamp, shifted,
                                          time_range_predicate)
from fleetlake.sinks.versions import newest_hours
from fleetlake.sources.lake import read_gold

NEW_SHIFT = 3   # newer dashboard: stored local time + 3 h = UTC
OLD_SHIFT = 0   # older dashboard compares local time with the range directly


def _in_range(ts, time_from, time_to, shift_hours):
    if time_from is None or time_to is None:          # P15: panel without time filter
        return F.lit(True)
    return time_range_predicate(ts, time_from, time_to, shift_hours)


def below_total_last(total_below: DataFrame) -> DataFrame:
    """Q1 (+A11): latest non-null count of lines below target."""
    ts = ref_timestamp("data_ref", "hora_id_ref")
    series = total_below.select(ts.alias("data_hora"), F.col("qtde_linhas").alias("quantidade"))
    return (series.where(F.col("quantidade").isNotNull())
            .agg(F.max_by("data_hora", "data_hora").alias("data_hora"),
                 F.max_by("quantidade", "data_hora").alias("quantidade")))


def below_top(below: DataFrame, time_from=None, time_to=None, shift_hours: int = NEW_SHIFT,
              limit: int = 20) -> DataFrame:
    """Q2 (+P15, P16, T2): lines below target, newest first, largest shortfall first."""
    ts = ref_timestamp("data_ref", "hora_id_ref")
    rows = below.where(_in_range(ts, time_from, time_to, shift_hours)).select(
        shifted(ts, shift_hours).alias("data_hora"),
        F.col("let_cod_linha").alias("linha"),
        F.col("meta_qtde_onibus").alias("alvo"),
        F.col("avg_qtde_onibus").alias("atingido"),
        (F.col("meta_qtde_onibus") - F.col("avg_qtde_onibus")).alias("diferenca"),
        F.col("id_linha"))
    return (rows.orderBy(F.col("data_hora").desc_nulls_last(), F.col("diferenca").desc_nulls_last(),
                         F.col("linha").asc(), F.col("id_linha").asc())
            .limit(limit).drop("id_linha"))


def network_last(total_network: DataFrame) -> DataFrame:
    """Q3 (+T1, A12, F8): latest network total with its display time."""
    latest = total_network.orderBy(F.col("data_ref").desc_nulls_last(), F.col("hora_ref").desc_nulls_last()).limit(1)
    return latest.select(display_text(ref_timestamp("data_ref", "hora_ref")).alias("data_hora"),
                         F.col("qtde_onibus").alias("quantidade"))


def network_series(total_network: DataFrame, time_from, time_to, shift_hours: int = NEW_SHIFT) -> DataFrame:
    """Q4 / Q9 (+P14, T5, F7): network total over time, newest first."""
    ts = ref_timestamp("data_ref", "hora_ref")
    return (total_network.where(_in_range(ts, time_from, time_to, shift_hours))
            .select(shifted(ts, shift_hours).alias("data_hora"), F.col("qtde_onibus"))
            .orderBy(F.col("data_hora").desc_nulls_last()))


def line_totals_top(total_line: DataFrame, time_from, time_to, shift_hours: int = NEW_SHIFT,
                    limit: int = 25) -> DataFrame:
    """Q5 / Q12 (+A8, A15, T3): buses per line label and snapshot (both
    directions summed), latest ``limit`` groups."""
    ts = ref_timestamp("data_ref", "hora_ref")
    grouped = (total_line.where(_in_range(ts, time_from, time_to, shift_hours))
               .groupBy(shifted(ts, shift_hours).alias("time"), F.col("let_cod_linha").alias("linha"))
               .agg(F.sum("qtde_onibus").alias("total_onibus")))
    return grouped.orderBy(F.col("time").desc_nulls_last(), F.col("linha").asc()).limit(limit)


def mean_network_last(mean_network: DataFrame, time_from, time_to, shift_hours: int = NEW_SHIFT) -> DataFrame:
    """Q6 (+T6): latest hourly network mean in the range, display time."""
    ts = ref_timestamp("data_ref", "hora_id_ref")
    latest = (mean_network.where(_in_range(ts, time_from, time_to, shift_hours))
              .orderBy(ts.desc_nulls_last()).limit(1))
    return latest.select(display_text(ts).alias("data_hora"), F.col("qtde_onibus").alias("quantidade"))


def line_table(total_line: DataFrame, time_from, time_to, shift_hours: int = NEW_SHIFT,
               sort_desc: bool = True, sort_by: str = "data") -> DataFrame:
    """Q7 (+A9, T8): buses per (snapshot, line, origin, destination), sorted by
    any output column; the other columns break ties.

    The original pins the date text to one day (G11); the row's own date is used.
    """
    ts = ref_timestamp("data_ref", "hora_ref")
    grouped = (total_line.where(_in_range(ts, time_from, time_to, shift_hours))
               .groupBy(shifted(ts, shift_hours).alias("data"), F.col("let_cod_linha").alias("linha"),
                        F.col("let_origem").alias("origem"), F.col("let_destino").alias("destino"))
               .agg(F.sum("qtde_onibus").alias("total_onibus")))
    if sort_by not in grouped.columns:
        raise ValueError(f"sort_by must be one of {grouped.columns}")
    order = F.col(sort_by).desc_nulls_last() if sort_desc else F.col(sort_by).asc_nulls_last()
    return grouped.orderBy(order, *(c for c in ("linha", "origem", "destino", "data") if c != sort_by))


def line_table_grand_total(table: DataFrame) -> DataFrame:
    """The table footer's sum reducer (switched off in the original)."""
    return table.agg(F.sum("total_onibus").alias("total_onibus"))


def mean_line_top(mean_line: DataFrame, time_from, time_to, shift_hours: int = NEW_SHIFT,
                  limit: int = 25, newest_first: bool = True) -> DataFrame:
    """Q8 / Q11 (+A10, F6b, T3/T4): hourly mean per line label."""
    ts = ref_timestamp("data_ref", "hora_id_ref", suffix=":00")
    grouped = (mean_line.where(_in_range(ts, time_from, time_to, shift_hours))
               .groupBy(shifted(ts, shift_hours).alias("time"), F.col("let_cod_linha").alias("linha"))
               .agg(F.sum("qtde_onibus").alias("total_onibus")))
    order = F.col("time").desc_nulls_last() if newest_first else F.col("time").asc_nulls_last()
    return grouped.orderBy(order, F.col("linha").asc()).limit(limit)


def mean_network_series(mean_network: DataFrame, time_from, time_to, shift_hours: int = OLD_SHIFT) -> DataFrame:
    """Q10 (+F9-F11, T7): hourly network mean series with display text."""
    ts = ref_timestamp("data_ref", "hora_id_ref", suffix=":00")
    at = date_plus_hours("data_ref", "hora_id_ref")
    return (mean_network.where(_in_range(ts, time_from, time_to, shift_hours))
            .select(display_text(at).alias("data_hora"), F.col("qtde_onibus").alias("quantidade"), at.alias("_at"))
            .orderBy(F.col("_at").desc_nulls_last()).drop("_at"))


def line_totals_range(total_line: DataFrame, time_from, time_to, shift_hours: int = OLD_SHIFT) -> DataFrame:
    """Q13: totals per (line, origin, destination) over the whole range.

    The original groups by a constant timestamp, i.e. sums over the range; the
    constant column is left out.
    """
    ts = ref_timestamp("data_ref", "hora_ref")
    return (total_line.where(_in_range(ts, time_from, time_to, shift_hours))
            .groupBy(F.col("let_cod_linha").alias("linha"), F.col("let_origem").alias("origem"),
                     F.col("let_destino").alias("destino"))
            .agg(F.sum("qtde_onibus").alias("total_onibus")))


# ---- panels over stored tables ---------------------------------------------------
# A panel opens the hours it needs and no others: the manifest (or the folder list)
# names the hours that hold rows, and the scan gets their folders.

def hours_of_range(time_from, time_to, shift_hours: int):
    """Predicate on the partition columns for the hours that a time range (P14) can touch."""
    lo, hi = (_as_dt(t) - timedelta(hours=shift_hours) for t in (time_from, time_to))
    key = F.concat(F.col("data_ref"), F.col("hora_id_ref"))
    return key.between(F.lit(lo.strftime("%Y%m%d%H")), F.lit(hi.strftime("%Y%m%d%H")))


def stored_range(spark: SparkSession, root: str, table: str, time_from, time_to, shift_hours: int) -> DataFrame:
    """A table's hours of a time range."""
    return read_gold(spark, root, table, hours_of_range(time_from, time_to, shift_hours))


def stored_newest(spark: SparkSession, root: str, table: str, rows: int, time_from=None, time_to=None,
                  shift_hours: int = NEW_SHIFT) -> DataFrame:
    """The newest hours of a table that hold at least ``rows`` result rows, whatever the panel groups by.

    Every hour with rows gives at least one group of its own (each panel's groups
    contain the time), so the last ``rows`` filled hours are enough.  A range is
    widened to whole hours here; the panel's own filter cuts it to the minute, which
    can empty the last hour, so one more is taken."""
    span = None if time_from is None else hours_of_range(time_from, time_to, shift_hours)
    hours = newest_hours(spark, root, table, rows + (span is not None), span)
    keys = [d + h for d, h in hours]
    return read_gold(spark, root, table, F.concat(F.col("data_ref"), F.col("hora_id_ref")).isin(keys) if keys else F.lit(False))


def stored_below_total_last(spark: SparkSession, root: str) -> DataFrame:
    """Q1 on the stored table: hours are opened newest first, in growing steps, until one holds a count."""
    step = 1
    while True:
        rows = stored_newest(spark, root, "total_linhas_abaixo_meta", step)
        if not rows.where(F.col("qtde_linhas").isNotNull()).isEmpty():
            return below_total_last(rows)
        if len(newest_hours(spark, root, "total_linhas_abaixo_meta", step + 1)) <= step:
            return below_total_last(rows)      # all hours were opened
        step *= 24
