"""J1/J2, P11-P13, A6/A7, G8, G9 on hand-made frames."""

from pyspark.sql import functions as F

from fleetlake.operators import targets
from fleetlake.schemas import MEDIA_POR_LINHA, META


def meta(spark, rows):
    return spark.createDataFrame([(h, l, 1, f"{l}-10", "D", "O", m) for h, l, m in rows], META)


def means(spark, rows):
    return spark.createDataFrame([(d, h, l, 1, f"{l}-10", "D", "O", q) for d, h, l, q in rows], MEDIA_POR_LINHA)


def test_one_hour_join_fills_missing_lines_with_zero(spark):
    m = meta(spark, [("10", 1, 5), ("10", 2, 3), ("11", 1, 9)])
    a = means(spark, [("20240115", "10", 1, 6), ("20240115", "10", 9, 4)])   # line 9: average only
    out = {r.id_linha: r for r in targets.target_one_hour(m, a, "20240115", "10").collect()}
    assert set(out) == {1, 2}
    assert out[1].avg_qtde_onibus == 6 and out[2].avg_qtde_onibus == 0
    assert all(r.data_ref == "20240115" for r in out.values())


def test_multi_hour_check_keeps_dates_apart(spark):
    m = meta(spark, [("10", 1, 5)])
    a = means(spark, [("20240115", "10", 1, 6), ("20240116", "10", 1, 2)])
    out = {(r.data_ref, r.id_linha): r.avg_qtde_onibus for r in targets.target_check(m, a).collect()}
    assert out == {("20240115", 1): 6, ("20240116", 1): 2}


def test_null_target_drops_line_from_both_lists(spark):
    m = meta(spark, [("10", 1, None), ("10", 2, 3)])
    a = means(spark, [("20240115", "10", 1, 6), ("20240115", "10", 2, 3)])
    checked = targets.target_check(m, a)
    assert [r.id_linha for r in targets.lines_reached(checked).collect()] == [2]
    assert targets.lines_below(checked).count() == 0


def test_lists_partition_checked_rows(spark):
    from fleetlake.sources.fixtures import load_silver, load_target
    from fleetlake.operators import stats
    a3 = stats.hourly_mean_per_line(stats.snapshot_per_line(load_silver(spark, "/root/testdata/sf0.001", False)))
    checked = targets.target_check(load_target(spark, "/root/testdata/sf0.001"), a3)
    r, b = targets.lines_reached(checked), targets.lines_below(checked)
    keys = ["data_ref", "hora_id_ref", "id_linha"]
    assert r.join(b, keys).count() == 0
    assert r.count() + b.count() == checked.where(F.col("meta_qtde_onibus").isNotNull()).count()
    # FIXTURES.md: reached / below = 585 / 3,132 at sf0.001
    assert (r.count(), b.count()) == (585, 3132)


def test_count_skips_null_direction_and_empty_hour_has_no_row(spark):
    m = spark.createDataFrame([("10", 1, None, "1-10", "D", "O", 5), ("10", 2, 1, "2-10", "D", "O", 5)], META)
    a = means(spark, [("20240115", "10", 1, 1), ("20240115", "10", 2, 1), ("20240115", "11", 3, 1)])
    checked = targets.target_check(m, a)
    below = targets.count_lines(targets.lines_below(checked)).collect()
    assert [(r.hora_id_ref, r.qtde_linhas) for r in below] == [("10", 1)]
    assert targets.count_lines(targets.lines_reached(checked)).count() == 0


def test_lines_without_bus(spark):
    m = meta(spark, [("10", 1, 5), ("10", 2, 3)])
    a = means(spark, [("20240115", "10", 1, 6)])
    out = targets.lines_without_bus(targets.target_check(m, a)).collect()
    assert [(r.data_ref, r.qtde_linhas) for r in out] == [("20240115", 1)]


def test_asked_hour_without_means_lists_every_target_line(spark, tmp_root):
    from fleetlake.plans.jobs import target_job
    from fleetlake.schemas import MEDIA_POR_LINHA
    from fleetlake.sinks.lake import write_hours
    from fleetlake.sources.fixtures import load_target
    write_hours(spark.createDataFrame([("20240110", "11", 1, 1, "1-10", "D", "O", 3)], MEDIA_POR_LINHA), f"{tmp_root}/media_onibus_por_linha")
    meta = load_target(spark, "/root/testdata/sf0.001")
    want = meta.where("hora_id_ref = '10' AND meta_qtde_onibus > 0").count()
    target_job(spark, tmp_root, meta, [("20240110", "10"), ("20240110", "11")])
    below = spark.read.parquet(f"{tmp_root}/linhas_abaixo_meta").where("hora_id_ref = '10'")
    assert want > 0 and below.count() == want
