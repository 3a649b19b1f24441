"""Bronze snapshot documents -> silver position rows.

The plan is narrow (two generators and projections, no shuffle), so it runs
map-only at any scale; only the vehicle fields that reach silver are read from
the nested input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import LOCAL_ZONE, capture_time_local, hour_id
from fleetlake.schemas import SILVER_COLUMNS


def explode_lines(bronze: DataFrame, keep: tuple[str, ...] = ("recv_date", "recv_hour")) -> DataFrame:
    """One row per line element of each document (column ``line``)."""
    cols = [c for c in keep if c in bronze.columns]
    return bronze.select(*cols, "hr", F.explode("l").alias("line"))


def explode_vehicles(lines: DataFrame) -> DataFrame:
    """One row per vehicle (column ``vehicle``); lines with empty or null
    ``vs`` produce no row, exactly like the original job."""
    return lines.select("*", F.explode("line.vs").alias("vehicle"))


def reference_date(recv_date: Column | str = "recv_date", recv_hour: Column | str = "recv_hour",
                   hr: Column | str = "hr") -> Column:
    """Local date a snapshot belongs to: the one that brings ``hr`` nearest to
    the reception hour.

    A document received in hour 00 that carries ``hr`` 23:xx was taken the day
    before; one received in hour 23 with ``hr`` 00:xx comes from a clock that is
    ahead and belongs to the next day.  A clock that is a little ahead within
    the day changes nothing.
    """
    d = F.col(recv_date) if isinstance(recv_date, str) else recv_date
    h = F.col(recv_hour) if isinstance(recv_hour, str) else recv_hour
    ahead = hour_id(hr).cast("int") - h.cast("int")
    day = F.to_date(d, "yyyyMMdd")
    return (F.when(ahead > 12, F.date_format(F.date_sub(day, 1), "yyyyMMdd"))
            .when(ahead < -12, F.date_format(F.date_add(day, 1), "yyyyMMdd")).otherwise(d))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def capture_reference(zone: str = LOCAL_ZONE) -> Column:
    """Local time that a document was captured at: the last of its vehicles' capture texts."""
    texts = F.flatten(F.filter(F.transform("l", lambda line: F.transform(line["vs"], lambda v: v["ta"])), lambda x: x.isNotNull()))
    return _bound(F.array_max(texts), lambda text: capture_time_local(text, zone))


def document_date(recv_date: str = "recv_date", recv_hour: str = "recv_hour", hr: str = "hr") -> Column:
    """Local date of a document of any lateness.

    ``reference_date`` relates ``hr`` to the reception hour, which holds for half a
    day.  A document's own capture times name its date however late it arrives, so
    ``hr`` is related to the last of them; without one that parses, or with one more
    than half a day after the reception (a vehicle's clock far ahead), to the
    reception hour.
    """
    received = F.to_timestamp_ntz(F.concat(recv_date, recv_hour), F.lit("yyyyMMddHH"))
    limit = received + F.make_dt_interval(F.lit(0), F.lit(13))
    taken = _bound(capture_reference(), lambda t: F.coalesce(F.when(t <= limit, t), received))
    return _bound(taken, lambda t: reference_date(F.date_format(t, "yyyyMMdd"), F.date_format(t, "HH"), hr))


def flatten_positions(bronze: DataFrame, data_ref: str | Column | None = None,
                      *, with_hour: bool = True) -> DataFrame:
    """The silver job's body as one lazy function.

    ``data_ref`` may be a literal date (the original behaviour) or omitted, in
    which case it is derived per document from its reception partition (G2).
    ``py`` is latitude and ``px`` longitude (G1: mapped by meaning).
    """
    if data_ref is None:
        date_col = reference_date()
    elif isinstance(data_ref, str):
        date_col = F.lit(data_ref)
    else:
        date_col = data_ref
    # a document's date is worked out once, before its vehicles become rows
    dated = bronze.withColumn("doc_date", date_col)
    vehicles = explode_vehicles(explode_lines(dated, ("doc_date",)))
    out = vehicles.select(
        F.col("doc_date").alias("data_ref"),
        F.col("hr").alias("hora_ref"),
        F.col("vehicle.p").alias("cod_onibus"),
        F.col("line.sl").alias("sentido_linha"),
        F.col("line.c").alias("let_cod_linha"),
        F.col("line.lt0").alias("let_destino"),
        F.col("line.lt1").alias("let_origem"),
        capture_time_local("vehicle.ta").alias("timestamp_pos"),
        F.col("vehicle.py").alias("latitude_pos"),
        F.col("vehicle.px").alias("longitude_pos"),
        F.col("line.cl").alias("id_linha"),
        F.col("line.qv").alias("qtde_onibus"),
    )
    cols = list(SILVER_COLUMNS)
    if with_hour:
        out = out.withColumn("hora_id_ref", hour_id("hora_ref"))
        cols.append("hora_id_ref")
    return out.select(*cols)
