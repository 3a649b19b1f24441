"""I1-I3 on files, S1/C3 bad documents, S5/K4 inside the target job."""

import json
import os
import uuid

import pytest

from fleetlake.operators.silver import flatten_positions
from fleetlake.plans.jobs import hours_predicate, silver_job, target_job
from fleetlake.schemas import META, TABLES
from fleetlake.sinks.jdbc import publish_stage, write_stage
from fleetlake.sinks.lake import route_documents, write_hours
from fleetlake.sources.bronze import read_bronze
from fleetlake.sources.jdbc import column_bounds, read_jdbc, read_target
from fleetlake.sources.lake import read_silver

LINE = {"c": "1-10", "cl": 1, "sl": 1, "lt0": "D", "lt1": "O", "qv": 1, "vs": [{"p": 7, "a": True, "ta": "2024-01-15T13:07:00Z", "py": -23.5, "px": -46.5}]}


def drop(path, files):
    os.makedirs(path)
    for name, text in files.items():
        with open(f"{path}/{name}", "w", encoding="utf-8") as f:
            f.write(text)


def test_files_are_routed_by_size_and_read_back(spark, tmp_root, tmp_path):
    doc = {"hr": "10:05", "l": [LINE]}
    drop(f"{tmp_path}/drop", {"20240115T100700_a1.json": json.dumps(doc), "20240115T110700_b2.json": json.dumps(doc | {"hr": "11:05"}, indent=2),
                              "20240115T110900_c3.json": "{}", "20240115T110901_d4": "", "unnamed.json": "x" * 60})
    landing, nok = f"{tmp_root}/ok", f"{tmp_root}/nok"
    for _ in range(2):  # a second routing replaces its own files
        assert route_documents(spark, f"{tmp_path}/drop", landing, nok, min_length=60) == {"ok": 2, "nok": 3}
    docs = read_bronze(spark, landing, multi_line=True)       # the second document spans lines
    assert sorted((r.hr, r.recv_date, r.recv_hour, r.document) for r in docs.collect()) == [
        ("10:05", "20240115", "10", "20240115_10_a1"), ("11:05", "20240115", "11", "20240115_11_b2")]
    assert sorted((r.hora_ref, r.cod_onibus) for r in flatten_positions(docs).collect()) == [("10:05", 7), ("11:05", 7)]
    failed = {r.document: (r.slot, r.value) for r in spark.read.text(nok, wholetext=True).collect()}
    assert failed["20240115_11_c3"][0] == "20240115_11" and failed["20240115_11_c3"][1].strip() == "{}"
    assert any(name.endswith("_unnamed") for name in failed)


def test_bad_documents_are_kept_with_their_source(spark, tmp_root, tmp_path):
    good, landing, silver = json.dumps({"hr": "10:05", "l": [LINE]}), f"{tmp_path}/bronze", f"{tmp_root}/silver"
    drop(f"{landing}/recv_date=20240115/recv_hour=10", {"a.json": "\n".join([good, good[:60], '{"hr": "25:00", "l": []}', '{"l": []}']), "b.json": good.replace("10:05", "10:10")})
    for _ in range(2):
        run = silver_job(spark, landing, silver, [("20240115", "10")], 0)
        assert (run.rows_in, run.bad_documents, run.rows_out) == (5, 3, {"silver": 2})
    assert sorted(r.hora_ref for r in read_silver(spark, silver).collect()) == ["10:05", "10:10"]
    kept = spark.read.parquet(f"{silver}_quarantine").collect()
    assert sorted((r.reason, r.document is not None) for r in kept) == [("does not parse", True), ("no reference time", False), ("no reference time", False)]
    assert all(r.source_file.endswith("/a.json") for r in kept)


def test_jobs_refuse_a_changed_schema(spark, tmp_root):
    write_hours(spark.createDataFrame([("20240115", "10", 1, 1, "1-10", "D", "O", 2)], TABLES["media_onibus_por_linha"].schema), f"{tmp_root}/media_onibus_por_linha")
    with pytest.raises(ValueError, match="schema"):
        target_job(spark, tmp_root, spark.createDataFrame([("10", "one")], "hora_id_ref string, id_linha string"), [("20240115", "10")])


def test_target_over_jdbc_and_published_stage(spark, tmp_root):
    url, props = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    meta = spark.createDataFrame([(f"{h:02d}", i, 1, f"{i}-10", "D", "O", 5) for h in (9, 10, 11) for i in range(1, 9)], META)
    write_stage(meta, url, "targets", props)
    assert column_bounds(spark, url, "targets", "id_linha", props) == (1, 8)
    hours = [("20240115", "10"), ("20240116", "10")]
    got = read_target(spark, url, "targets", hours, props, num_partitions=3)
    assert got.schema == META and got.count() == 8 and got.rdd.getNumPartitions() == 3
    assert "PushedFilters: [*" in got._jdf.queryExecution().executedPlan().toString() and "hora_id_ref" in got._jdf.queryExecution().executedPlan().toString()
    write_hours(spark.createDataFrame([("20240115", "10", 1, 1, "1-10", "D", "O", 6)], TABLES["media_onibus_por_linha"].schema), f"{tmp_root}/media_onibus_por_linha")
    run = target_job(spark, tmp_root, got, hours)
    names = publish_stage(spark, tmp_root, run.tables, hours_predicate(hours), url, props)
    assert read_jdbc(spark, url, names["linhas_abaixo_meta"], props).count() == 15
    assert read_jdbc(spark, url, names["linhas_atingida_meta"], props).count() == 1
    empty = read_target(spark, url, "targets", [("20240115", "23")], props)
    assert empty.count() == 0
