"""K1, K4-K7, C1/C2, G9 and idempotence (V4)."""

import uuid

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.quality import KeyViolation, key_violations, null_key_violations
from fleetlake.plans.jobs import stats_job, target_job
from fleetlake.schemas import MEDIA_GERAL, TABLES, TOTAL_LINHAS
from fleetlake.sinks import jdbc as jdbc_sink
from fleetlake.sinks.lake import clear_hours, upsert_table, write_hours
from fleetlake.sources.fixtures import load_silver, load_target
from fleetlake.sources.jdbc import read_jdbc
from fleetlake.sources.lake import read_gold, read_silver

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_overwrite_replaces_only_present_hours(spark, tmp_root):
    a = spark.createDataFrame([("20240115", "10", 1), ("20240115", "11", 2)], "data_ref string, hora_id_ref string, qtde_onibus long")
    write_hours(a, tmp_root)
    b = spark.createDataFrame([("20240115", "11", 9)], "data_ref string, hora_id_ref string, qtde_onibus long")
    write_hours(b, tmp_root)
    back = spark.read.schema("qtde_onibus long, data_ref string, hora_id_ref string").parquet(tmp_root)
    assert rows(back, "hora_id_ref", "qtde_onibus") == [("10", 1), ("11", 9)]


def test_clear_hours_empties_hour_without_rows(spark, tmp_root):
    a = spark.createDataFrame([("20240115", "10", 3), ("20240115", "11", 2)], TOTAL_LINHAS)
    write_hours(a, tmp_root)
    new = spark.createDataFrame([("20240115", "11", 5)], TOTAL_LINHAS)
    write_hours(new, tmp_root)
    cleared = clear_hours(spark, tmp_root, new, [("20240115", "10"), ("20240115", "11")], TOTAL_LINHAS)
    assert cleared == [("20240115", "10")]
    back = spark.read.schema(TOTAL_LINHAS).parquet(tmp_root)
    assert rows(back, "hora_id_ref", "qtde_linhas") == [("11", 5)]


def test_upsert_inserts_updates_never_deletes(spark, tmp_root):
    t = TABLES["media_onibus_geral"]
    first = spark.createDataFrame([("20240115", "10", 1), ("20240115", "11", 2)], MEDIA_GERAL)
    upsert_table(spark, first, tmp_root, t.name)
    stage = spark.createDataFrame([("20240115", "11", 7), ("20240115", "12", None)], MEDIA_GERAL)
    upsert_table(spark, stage, tmp_root, t.name)
    back = read_gold(spark, tmp_root, t.name)
    assert rows(back, "hora_id_ref", "qtde_onibus") == sorted([("10", 1), ("11", 7), ("12", None)],
                                                               key=lambda r: (r[0], r[1] or 0))


def test_upsert_fails_on_duplicate_or_null_key(spark, tmp_root):
    dup = spark.createDataFrame([("20240115", "11", 7), ("20240115", "11", 8)], MEDIA_GERAL)
    with pytest.raises(KeyViolation):
        upsert_table(spark, dup, tmp_root, "media_onibus_geral")
    nul = spark.createDataFrame([(None, "11", 7)], MEDIA_GERAL)
    with pytest.raises(KeyViolation):
        upsert_table(spark, nul, tmp_root, "media_onibus_geral")


def test_key_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, n long")
    assert rows(key_violations(df, ["k", "n"]), "k", "n_rows") == [("a", 2)]
    assert [r.null_keys for r in null_key_violations(df, ["k", "n"]).collect()] == ["n"]


def test_jobs_are_idempotent_and_match_lazy_results(spark, tmp_root):
    silver_path, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    s = load_silver(spark, SF, exact_count=True)
    write_hours(s, silver_path)
    stats_job(spark, silver_path, gold)
    once = rows(read_gold(spark, gold, "media_onibus_por_linha"), "data_ref", "hora_id_ref", "id_linha", "qtde_onibus")
    stats_job(spark, silver_path, gold)
    twice = rows(read_gold(spark, gold, "media_onibus_por_linha"), "data_ref", "hora_id_ref", "id_linha", "qtde_onibus")
    assert once == twice and len(once) == 868
    target_job(spark, gold, load_target(spark, SF))
    assert read_gold(spark, gold, "linhas_atingida_meta").count() == 585
    assert read_gold(spark, gold, "linhas_abaixo_meta").count() == 3132
    assert read_silver(spark, silver_path).count() == 1000


def test_recompute_one_hour_leaves_others(spark, tmp_root):
    silver_path, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    s = load_silver(spark, SF, exact_count=True)
    write_hours(s, silver_path)
    stats_job(spark, silver_path, gold)
    before = read_gold(spark, gold, "total_onibus_geral").count()
    hour = s.select("data_ref", "hora_id_ref").orderBy("data_ref", "hora_id_ref").first()
    stats_job(spark, silver_path, gold, [(hour[0], hour[1])])
    assert read_gold(spark, gold, "total_onibus_geral").count() == before
    assert spark.read.parquet(f"{gold}/_job_runs").where(F.col("job") == "stats").count() == 1


def test_stats_rerun_clears_an_emptied_hour(spark, tmp_root):
    silver_path, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    s = load_silver(spark, SF, exact_count=True)
    hours = [(r[0], r[1]) for r in s.select("data_ref", "hora_id_ref").distinct().orderBy("data_ref", "hora_id_ref").limit(3).collect()]
    write_hours(s, silver_path)
    stats_job(spark, silver_path, gold, hours)
    d, h = hours[1]
    s.limit(0).drop("data_ref", "hora_id_ref").write.mode("overwrite").parquet(f"{silver_path}/data_ref={d}/hora_id_ref={h}")
    stats_job(spark, silver_path, gold, hours)
    for t in ("total_onibus_por_linha", "total_onibus_geral", "media_onibus_por_linha", "media_onibus_geral"):
        left = read_gold(spark, gold, t, keep_hour_column=True).select("data_ref", "hora_id_ref").distinct().collect()
        assert sorted((r[0], r[1]) for r in left) == [hours[0], hours[2]]


def test_stats_job_fails_on_a_label_change_before_writing(spark, tmp_root):
    silver_path, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    s = load_silver(spark, SF, exact_count=True)
    one = s.orderBy("cod_onibus").limit(1)
    write_hours(one.unionByName(one.withColumn("let_cod_linha", F.lit("renamed"))), silver_path)
    with pytest.raises(KeyViolation):
        stats_job(spark, silver_path, gold)
    from fleetlake.sinks.lake import table_exists
    assert not table_exists(spark, f"{gold}/total_onibus_geral")


def test_jdbc_stage_append_and_partitioned_read(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([("20240115", "10", 1), ("20240115", "11", 2)], MEDIA_GERAL)
    jdbc_sink.write_stage(df, url, "STAGE", props)
    jdbc_sink.write_stage(df, url, "STAGE", props)          # truncate, not duplicate
    jdbc_sink.append_rows(df.limit(1), url, "STAGE", props)
    back = read_jdbc(spark, url, "STAGE", props, column="QTDE_ONIBUS", lower=0, upper=3, num_partitions=2)
    assert back.count() == 3
    assert back.where(F.col("DATA_REF") == "20240115").count() == 3


def test_latest_per_key(spark):
    from fleetlake.operators.merge import latest_per_key
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "k string, v long, q long")
    assert rows(latest_per_key(df, ["k"], ["v"]), "k", "v", "q") == [("a", 2, 20), ("b", 1, 5)]


def test_target_rerun_moves_line_between_lists(spark, tmp_root):
    """A line that moves from below to reached leaves no stale row."""
    from fleetlake.schemas import MEDIA_POR_LINHA, META
    meta = spark.createDataFrame([("10", 1, 1, "1-10", "D", "O", 5)], META)
    means_path = f"{tmp_root}/media_onibus_por_linha"
    low = spark.createDataFrame([("20240115", "10", 1, 1, "1-10", "D", "O", 2)], MEDIA_POR_LINHA)
    write_hours(low, means_path)
    target_job(spark, tmp_root, meta, [("20240115", "10")])
    assert read_gold(spark, tmp_root, "total_linhas_abaixo_meta").count() == 1
    high = spark.createDataFrame([("20240115", "10", 1, 1, "1-10", "D", "O", 9)], MEDIA_POR_LINHA)
    write_hours(high, means_path)
    target_job(spark, tmp_root, meta, [("20240115", "10")])
    assert read_gold(spark, tmp_root, "linhas_abaixo_meta").count() == 0
    assert read_gold(spark, tmp_root, "total_linhas_abaixo_meta").count() == 0
    assert read_gold(spark, tmp_root, "linhas_atingida_meta").count() == 1


def test_stats_job_observes_input_rows(spark, tmp_root):
    silver_path, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    write_hours(load_silver(spark, SF, exact_count=True), silver_path)
    run = stats_job(spark, silver_path, gold)
    assert run.observation.get["silver_rows"] == 1000


def test_route_payloads(spark, tmp_root):
    from fleetlake.operators.ingest import validate_payloads
    from fleetlake.sinks.lake import route_payloads
    df = spark.createDataFrame([(1, "a", "x" * 10), (2, "b", "y" * 4000), (3, "c", None)],
                               "payload_id long, name string, body string")
    flagged = validate_payloads(df).withColumn("recv_ts", F.lit("2024-01-15 10:07:00").cast("timestamp_ntz"))
    route_payloads(flagged, f"{tmp_root}/ok", f"{tmp_root}/nok")
    ok = spark.read.parquet(f"{tmp_root}/ok").collect()
    nok = spark.read.parquet(f"{tmp_root}/nok").collect()
    assert [(r.payload_id, r.file_name, r.recv_hour) for r in ok] == [(2, "20240115_10_2.json", "10")]
    assert sorted(r.payload_id for r in nok) == [1, 3]


def test_cli_hour_list():
    from fleetlake.plans.cli import hour_list

    class A:
        first, last, hours_back, zone = "2024011522", "2024011601", 0, "America/Sao_Paulo"
    assert hour_list(A) == [("20240115", "22"), ("20240115", "23"), ("20240116", "00"), ("20240116", "01")]


def test_stats_job_upsert_mode_equals_overwrite(spark, tmp_root):
    silver_path = f"{tmp_root}/silver"
    write_hours(load_silver(spark, SF, exact_count=True), silver_path)
    stats_job(spark, silver_path, f"{tmp_root}/a")
    stats_job(spark, silver_path, f"{tmp_root}/b", upsert=True)
    stats_job(spark, silver_path, f"{tmp_root}/b", upsert=True)      # second run only updates
    for t in ("total_onibus_por_linha", "media_onibus_geral"):
        cols = TABLES[t].columns
        assert rows(read_gold(spark, f"{tmp_root}/a", t), *cols) == rows(read_gold(spark, f"{tmp_root}/b", t), *cols)


def test_payload_size_is_bytes_and_strictly_larger(spark):
    from fleetlake.operators.ingest import validate_payloads
    df = spark.createDataFrame([(1, "é" * 1500), (2, "é" * 1501), (3, None)], "payload_id long, body string")
    got = {r.payload_id: (r.payload_len, r.payload_ok) for r in validate_payloads(df).collect()}
    assert got == {1: (3000, False), 2: (3002, True), 3: (None, None)}
