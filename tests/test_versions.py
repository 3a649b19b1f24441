"""K7 manifest commits, G9 emptied hours, K6 on versions, A14 row counts, G10 missing input."""

import re

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.quality import KeyViolation
from fleetlake.plans import jobs
from fleetlake.plans.jobs import hours_predicate, silver_job, stats_job, target_job
from fleetlake.schemas import MEDIA_GERAL, META, SILVER, TABLES
from fleetlake.sinks import versions
from fleetlake.sinks.lake import prepare_upsert, upsert_table, write_hours
from fleetlake.sources.bronze import write_bronze
from fleetlake.sources.lake import read_gold, read_silver, with_hour_column

H10, H11, H12 = ("20240115", "10"), ("20240115", "11"), ("20240115", "12")
STATS = ("total_onibus_por_linha", "total_onibus_geral", "media_onibus_por_linha", "media_onibus_geral")


def position(hour=H10, minute="05", line=1, n=3, bus=1):
    return (hour[0], f"{hour[1]}:{minute}", bus, 1, f"{line}-10", "D", "O", None, -23.5, -46.5, line, n, hour[1])


def put_silver(spark, path, rows):
    write_hours(spark.createDataFrame(rows, with_hour_column(SILVER)), path)


def totals(spark, gold):
    return {t: sorted(tuple(r) for r in read_gold(spark, gold, t).collect()) for t in STATS}


def test_a_job_killed_between_its_writes_changes_no_table(spark, tmp_root, monkeypatch):
    silver, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    put_silver(spark, silver, [position(), position(H11, n=4)])
    stats_job(spark, silver, gold, [H10, H11])
    before = totals(spark, gold)
    put_silver(spark, silver, [position(n=9), position(H11, n=8)])
    real, written = jobs.write_hours, []

    def dies(df, path, *args, **kw):
        if len(written) == 2:
            raise RuntimeError("killed")
        written.append(path)
        real(df, path, *args, **kw)

    monkeypatch.setattr(jobs, "write_hours", dies)
    monkeypatch.setattr(jobs, "run_concurrently", lambda tasks: {k: f() for k, f in tasks.items()})
    with pytest.raises(RuntimeError, match="killed"):
        stats_job(spark, silver, gold, [H10, H11])
    assert len(written) == 2 and totals(spark, gold) == before
    monkeypatch.undo()
    stats_job(spark, silver, gold, [H10, H11])
    after = totals(spark, gold)
    assert all(after[t] != before[t] for t in STATS)
    # what nobody reads any more goes, and nothing else
    gone = versions.vacuum(spark, gold, "total_onibus_por_linha", older_than_s=0)
    assert len(gone) == 4 and totals(spark, gold) == after
    assert versions.vacuum(spark, gold, "total_onibus_por_linha", older_than_s=3600) == []


def test_manifest_compacts_to_the_same_readings(spark, tmp_root):
    for n in (1, 2, 3):
        upsert_table(spark, spark.createDataFrame([(*H10, n), (*(H11 if n < 3 else H12), 10 * n)], MEDIA_GERAL), tmp_root, "media_onibus_geral")
    read = lambda: sorted(tuple(r) for r in read_gold(spark, tmp_root, "media_onibus_geral").collect())
    want = [(*H10, 3), (*H11, 20), (*H12, 30)]
    assert read() == want
    assert versions.compact(spark, tmp_root) == 3 and len(versions.manifest(spark, tmp_root).files()) == 1
    assert read() == want and versions.compact(spark, tmp_root) == 0


def test_first_commit_adopts_plain_hours(spark, tmp_root):
    path = f"{tmp_root}/media_onibus_geral"
    write_hours(spark.createDataFrame([(*H10, 1), (*H11, 2)], MEDIA_GERAL), path)
    upsert_table(spark, spark.createDataFrame([(*H11, 7), (*H12, 8)], MEDIA_GERAL), tmp_root, "media_onibus_geral")
    assert sorted(tuple(r) for r in read_gold(spark, tmp_root, "media_onibus_geral").collect()) == [(*H10, 1), (*H11, 7), (*H12, 8)]
    one = read_gold(spark, tmp_root, "media_onibus_geral", hours_predicate([H11]))
    assert len(one.inputFiles()) == 1 and "run=upsert-" in one.inputFiles()[0]


def test_a_silver_rerun_empties_an_hour_whose_documents_left(spark, tmp_root):
    line = [("1-10", 1, 1, "D", "O", 3, [(7, True, "2024-01-15T13:05:00Z", -23.5, -46.5)])]
    docs = spark.createDataFrame([("10:05", line, "20240115", "10"), ("11:05", line, "20240115", "11")],
                                 "hr string, l array<struct<c:string,cl:bigint,sl:bigint,lt0:string,lt1:string,qv:bigint,"
                                 "vs:array<struct<p:bigint,a:boolean,ta:string,py:double,px:double>>>>, recv_date string, recv_hour string")
    first, second, silver = f"{tmp_root}/b1", f"{tmp_root}/b2", f"{tmp_root}/silver"
    write_bronze(docs, first)
    run = silver_job(spark, first, silver, [H10, H11])
    assert (run.status, run.rows_in, run.rows_out) == ("done", 2, {"silver": 2})
    write_bronze(docs.where("recv_hour = '11'"), second)
    silver_job(spark, second, silver, [H10, H11])
    assert [r.hora_ref for r in read_silver(spark, silver).collect()] == ["11:05"]
    # the emptied hour is known, so the statistics of it are emptied too
    stats_job(spark, silver, f"{tmp_root}/gold", [H10])
    assert versions.known_hours(spark, f"{tmp_root}/gold", "media_onibus_geral") == [H10]
    assert read_gold(spark, f"{tmp_root}/gold", "media_onibus_geral").count() == 0


def test_every_job_reports_rows_and_missing_input(spark, tmp_root):
    silver, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    meta = spark.createDataFrame([("10", 1, 1, "1-10", "D", "O", 5), ("10", 2, 1, "2-10", "D", "O", 1)], META)
    for run in (silver_job(spark, f"{tmp_root}/none", silver, [H10]), silver_job(spark, f"{tmp_root}/none", silver),
                stats_job(spark, silver, gold, [H10]), target_job(spark, gold, meta, [H10])):
        assert (run.status, run.rows_in, run.rows_out) == ("no input", 0, {})
    assert versions.folders(spark, f"{tmp_root}/*") == []          # nothing written, nothing marked
    put_silver(spark, silver, [position(bus=1), position(bus=2), position(line=2, n=4)])
    run = stats_job(spark, silver, gold, [H10, H11])
    assert run.status == "done" and run.missing == [H11] and run.rows_in == 3
    assert run.rows_out == {"total_onibus_por_linha": 2, "total_onibus_geral": 1, "media_onibus_por_linha": 2, "media_onibus_geral": 1}
    run = target_job(spark, gold, meta, [H10])
    assert (run.rows_in, run.rows_out["linhas_atingida_meta"], run.rows_out["linhas_abaixo_meta"]) == (2, 1, 1)
    assert stats_job(spark, silver, gold, [H12]).status == "no input"


def test_target_job_checks_keys_before_it_writes(spark, tmp_root):
    write_hours(spark.createDataFrame([(*H10, 1, 1, "1-10", "D", "O", 2)], TABLES["media_onibus_por_linha"].schema), f"{tmp_root}/media_onibus_por_linha")
    row = ("10", 1, 1, "1-10", "D", "O", 5)
    for bad in ([row, (*row[:6], 9)], [(None, *row[1:])]):
        with pytest.raises(KeyViolation):
            target_job(spark, tmp_root, spark.createDataFrame(bad, META), [H10])
        assert versions.known_hours(spark, tmp_root, "linhas_abaixo_meta") == []


def test_upsert_computes_its_stage_once(spark, tmp_root):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    stage = spark.createDataFrame([(*H10, 1), (*H11, 2)], MEDIA_GERAL).mapInPandas(count, MEDIA_GERAL)
    upsert_table(spark, stage, tmp_root, "media_onibus_geral")
    assert seen.value == 2
    with pytest.raises(KeyViolation, match="duplicate"):
        prepare_upsert(spark, stage.unionByName(stage), tmp_root, "media_onibus_geral", "r")


def test_panels_open_only_the_hours_they_need(spark):
    from fleetlake.plans import panels, registry
    from tests_helpers import plan
    sf = "/root/testdata/sf0.001"
    root = registry.stored_gold(spark, sf)
    assert root == registry.stored_gold(spark, sf)
    whole = read_gold(spark, root, "total_onibus_geral")
    last = panels.stored_newest(spark, root, "total_onibus_geral", 1)
    assert len(last.inputFiles()) == 1 < len(whole.inputFiles())
    newest = whole.agg(F.max(F.concat("data_ref", F.substring("hora_ref", 1, 2)))).first()[0]
    assert re.search(rf"data_ref={newest[:8]}/hora_id_ref={newest[8:]}/", last.inputFiles()[0])
    span = panels.stored_range(spark, root, "total_onibus_por_linha", registry.TIME_FROM, registry.TIME_TO, 3)
    assert 1 <= len(span.inputFiles()) <= 13
    shown = plan(panels.network_series(last, registry.TIME_FROM, registry.TIME_TO, 3))
    assert "PartitionFilters: [" in shown and "20240115" in shown
    assert panels.stored_newest(spark, root, "total_onibus_geral", 5, "2031-01-01 00:00:00", "2031-01-02 00:00:00").count() == 0
