"""V2/V3 closed-hour detection used by the pipeline stream."""

from fleetlake.schemas import MEDIA_POR_LINHA
from fleetlake.sinks.lake import mark_done, write_hours
from fleetlake.streaming.recompute import closed_hours


def _means(spark, root, hours):
    rows = [(d, h, 1, 1, "1-10", "D", "O", 3) for d, h in hours]
    write_hours(spark.createDataFrame(rows, MEDIA_POR_LINHA), f"{root}/media_onibus_por_linha")


def test_closed_hours_limit_horizon_and_markers(spark, tmp_root):
    hours = [("20240114", f"{h:02d}") for h in range(24)] + [("20240115", "00"), ("20240115", "01")]
    _means(spark, tmp_root, hours)
    # newest reception 2024-01-15 01, lateness 1 -> hours up to 2024-01-14 23 are closed
    got = closed_hours(spark, tmp_root, "2024011501", lateness_hours=1, horizon_hours=3)
    assert got == [("20240114", "20"), ("20240114", "21"), ("20240114", "22"), ("20240114", "23")]
    # an earlier touched hour widens the look-back
    got = closed_hours(spark, tmp_root, "2024011501", 1, horizon_hours=3, earliest="2024011418")
    assert got[0] == ("20240114", "18") and got[-1] == ("20240114", "23")
    # hours with a completion marker are not checked again
    mark_done(spark, tmp_root, "targets", [("20240114", "22"), ("20240114", "23")])
    got = closed_hours(spark, tmp_root, "2024011501", 1, horizon_hours=3)
    assert got == [("20240114", "20"), ("20240114", "21")]


def test_closed_hours_without_means_is_empty(spark, tmp_root):
    assert closed_hours(spark, tmp_root, "2024011501", 1) == []


def test_closed_hours_finds_hours_before_a_gap(spark, tmp_root):
    _means(spark, tmp_root, [("20240110", "09"), ("20240110", "10"), ("20240113", "10")])
    assert closed_hours(spark, tmp_root, "2024011315", 1) == [("20240110", "09"), ("20240110", "10"), ("20240113", "10")]
