"""Plan properties the design relies on, read from ``explain('formatted')``."""

import contextlib
import io

from fleetlake.operators import stats, targets
from fleetlake.plans.jobs import hours_predicate
from fleetlake.plans import panels
from fleetlake.sinks.lake import write_hours
from fleetlake.sources import fixtures
from fleetlake.sources.lake import read_gold, read_silver

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_hour_scan_prunes_partitions_and_columns(spark, tmp_root):
    write_hours(fixtures.load_silver(spark, SF), tmp_root)
    df = stats.hourly_mean_per_line(stats.snapshot_per_line(
        read_silver(spark, tmp_root, hours_predicate([("20240115", "10")]))))
    p = plan(df)
    assert "PartitionFilters: [" in p and "2024011510" in p
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "latitude_pos" not in read_schema and "timestamp_pos" not in read_schema


def test_snapshot_aggregate_combines_map_side(spark):
    p = plan(stats.snapshot_per_line(fixtures.load_silver(spark, SF, exact_count=False)))
    assert "partial_max" in p
    assert p.index("partial_max") > p.index("Exchange")   # partial step sits below the shuffle


def test_target_join_is_left_to_spark(spark):
    a3 = stats.hourly_mean_per_line(stats.snapshot_per_line(fixtures.load_silver(spark, SF)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(targets.target_check(fixtures.load_target(spark, SF), a3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p


def test_panel_range_reaches_gold_scan(spark, tmp_root):
    gold = stats.total_network(stats.network_per_snapshot(stats.snapshot_per_line(
        fixtures.load_silver(spark, SF))))
    write_hours(gold.withColumn("hora_id_ref", gold.hora_ref.substr(1, 2)), f"{tmp_root}/total_onibus_geral")
    df = panels.network_series(read_gold(spark, tmp_root, "total_onibus_geral"),
                               "2024-01-15 09:00:00", "2024-01-15 21:00:00", 3)
    p = plan(df)
    assert "PartitionFilters: [" in p and "20240115" in p


def test_landing_read_of_one_reception_hour_prunes(spark, tmp_root):
    from fleetlake.sources.bronze import read_bronze, reception_hour, write_bronze
    docs = fixtures.load_bronze(spark, SF)
    write_bronze(docs, tmp_root)
    first = docs.select("recv_date", "recv_hour").orderBy("recv_date", "recv_hour").first()
    df = read_bronze(spark, tmp_root, reception_hour(first[0], first[1]))
    p = plan(df)
    assert "PartitionFilters: [" in p and first[0] in p
    expected = docs.where((docs.recv_date == first[0]) & (docs.recv_hour == first[1])).count()
    assert df.count() == expected > 0
