"""A1-A5 on hand-made silver rows, plus the properties of SURVEY §5."""

from pyspark.sql import functions as F

from fleetlake.operators import stats
from fleetlake.schemas import SILVER


def silver(spark, rows):
    full = []
    for data_ref, hora_ref, bus, line, q in rows:
        full.append((data_ref, hora_ref, bus, 1, f"{line}-10", "D", "O", None, 0.0, 0.0, line, q))
    return spark.createDataFrame(full, SILVER)


def test_snapshot_max_absorbs_duplicates(spark):
    df = silver(spark, [("20240115", "10:05", 1, 7, 3), ("20240115", "10:05", 2, 7, 3),
                        ("20240115", "10:05", 1, 7, 3)])
    a1 = stats.snapshot_per_line(df).collect()
    assert len(a1) == 1 and a1[0].qtde_onibus == 3 and a1[0].hora_id_ref == "10"


def test_hourly_mean_rounds_up(spark):
    df = silver(spark, [("20240115", "10:05", 1, 7, 3), ("20240115", "10:10", 1, 7, 4),
                        ("20240115", "11:00", 1, 7, 5)])
    a3 = {r.hora_id_ref: r.qtde_onibus for r in stats.hourly_mean_per_line(stats.snapshot_per_line(df)).collect()}
    assert a3 == {"10": 4, "11": 5}
    assert dict(stats.hourly_mean_per_line(stats.snapshot_per_line(df)).dtypes)["qtde_onibus"] == "bigint"


def test_network_total_and_mean(spark):
    df = silver(spark, [("20240115", "10:05", 1, 7, 3), ("20240115", "10:05", 2, 8, 2),
                        ("20240115", "10:10", 3, 7, 1)])
    a4 = stats.network_per_snapshot(stats.snapshot_per_line(df))
    assert {r.hora_ref: r.qtde_onibus for r in a4.collect()} == {"10:05": 5, "10:10": 1}
    assert stats.hourly_mean_network(a4).collect()[0].qtde_onibus == 3


def test_properties_on_fixture(spark):
    from fleetlake.sources.fixtures import load_silver
    s = load_silver(spark, "/root/testdata/sf0.001", exact_count=False)
    a1 = stats.snapshot_per_line(s)
    a2, a4 = stats.total_per_line(a1), stats.network_per_snapshot(a1)
    # A4 = sum of A2 per snapshot
    summed = a2.groupBy("data_ref", "hora_ref").agg(F.sum("qtde_onibus").alias("s"))
    diff = summed.join(a4, ["data_ref", "hora_ref"]).where(F.col("s") != F.col("qtde_onibus"))
    assert diff.count() == 0
    # min(A1) <= A3 <= max(A1) per hour and line
    keys = ["data_ref", "hora_id_ref", "id_linha"]
    bounds = a1.groupBy(*keys).agg(F.min("qtde_onibus").alias("lo"), F.max("qtde_onibus").alias("hi"))
    a3 = stats.hourly_mean_per_line(a1)
    bad = a3.join(bounds, keys).where((F.col("qtde_onibus") < F.col("lo")) | (F.col("qtde_onibus") > F.col("hi")))
    assert bad.count() == 0
    # FIXTURES.md: 868 rows, sum 43,735 at sf0.001
    agg = a3.agg(F.count(F.lit(1)).alias("n"), F.sum("qtde_onibus").alias("s")).collect()[0]
    assert (agg.n, agg.s) == (868, 43735)
