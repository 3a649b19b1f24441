"""F5-F11, S6, P14 and panel ordering."""

import datetime as dt


from fleetlake.functions.timeutil import (HourSpec, date_plus_hours, display_text, hour_id, ref_timestamp,
                                          time_range_predicate)
from fleetlake.plans import panels
from fleetlake.schemas import LINHAS_META, TOTAL_POR_LINHA


def test_reference_timestamp_accepts_hour_and_minute(spark):
    df = spark.createDataFrame([("20240115", "10", "10:05")], "d string, h string, m string")
    r = df.select(ref_timestamp("d", "h").alias("a"), ref_timestamp("d", "m").alias("b"),
                  ref_timestamp("d", "h", ":00").alias("c"), hour_id("m").alias("hid"),
                  display_text(ref_timestamp("d", "m")).alias("txt"), date_plus_hours("d", "h").alias("e")).first()
    assert r.a == dt.datetime(2024, 1, 15, 10) == r.c == r.e
    assert r.b == dt.datetime(2024, 1, 15, 10, 5)
    assert r.hid == "10" and r.txt == "15/01/2024 10:05"


def test_hour_spec_with_injected_now():
    h = HourSpec(hours_back=1, now=dt.datetime(2024, 1, 16, 0, 30))
    assert (h.data_ref, h.hora_id_ref, h.path_suffix) == ("20240115", "23", "2024/01/15/23")


def test_range_predicate_shift(spark):
    df = spark.createDataFrame([("20240115", "05:55"), ("20240115", "06:00"), ("20240115", "18:00"),
                                ("20240115", "18:05")], "data_ref string, hora_ref string")
    ts = ref_timestamp("data_ref", "hora_ref")
    got = [r.hora_ref for r in df.where(time_range_predicate(ts, "2024-01-15 09:00:00", "2024-01-15 21:00:00", 3))
           .orderBy("hora_ref").collect()]
    assert got == ["06:00", "18:00"]


def test_top_k_ties_broken_by_label(spark):
    rows = [("20240115", "10", i, 1, f"{i}-10", "D", "O", 5, 1) for i in range(30)]
    below = spark.createDataFrame(rows, LINHAS_META)
    out = panels.below_top(below, limit=20).collect()
    assert [r.linha for r in out] == sorted(f"{i}-10" for i in range(30))[:20]
    assert out[0].diferenca == 4


def test_line_panel_sums_both_directions(spark):
    rows = [("20240115", "10:05", 1, 1, "X-10", "D1", "O1", 3), ("20240115", "10:05", 2, 2, "X-10", "D2", "O2", 4)]
    tl = spark.createDataFrame(rows, TOTAL_POR_LINHA)
    out = panels.line_totals_top(tl, "2024-01-15 09:00:00", "2024-01-15 21:00:00", 3).collect()
    assert [(r.linha, r.total_onibus) for r in out] == [("X-10", 7)]
    assert out[0].time == dt.datetime(2024, 1, 15, 13, 5)
