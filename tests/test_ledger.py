"""The dirty-hour ledger, late and touched hours."""

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.silver import document_date
from fleetlake.schemas import META
from fleetlake.sinks.ledger import HourLedger
from fleetlake.sources.bronze import BRONZE_WITH_PARTITIONS, landed, write_bronze
from fleetlake.sources.lake import read_gold, read_silver
from fleetlake.streaming import recompute
from fleetlake.streaming.recompute import process_pending

H10 = ("20240115", "10")
PAIRS = "data_ref string, hora_id_ref string, recv_date string, recv_hour string"


def document(hr, recv, n=3, line=1, day="2024-01-15"):
    """One line of ``n`` vehicles, captured at ``hr`` local time (three hours behind UTC)."""
    h, m = hr.split(":")
    ta = f"{day}T{int(h) + 3:02d}:{m}:00Z"
    return (hr, [(f"{line}-10", line, 1, "D", "O", n, [(100 * line + i, True, ta, -23.5, -46.5) for i in range(n)])], *recv)


def land(spark, path, *docs):
    write_bronze(spark.createDataFrame(list(docs), BRONZE_WITH_PARTITIONS), path, mode="append")


def test_hours_get_dirty_built_due_and_checked(spark, tmp_root):
    ledger = HourLedger(spark, tmp_root)
    assert ledger.pending() == {} and ledger.due() == {}
    v1 = ledger.record_seen(spark.createDataFrame([(*H10, "20240115", "10"), (*H10, "20240115", "10"), (*H10, "20240115", "11"), (None, "10", "20240115", "11")], PAIRS))
    assert list(ledger.dirty()) == [H10] and ledger.dirty()[H10].receptions == [("20240115", "10"), ("20240115", "11")]
    ledger.record_built({H10: v1})
    assert ledger.dirty() == {} and ledger.due() == {}           # built, not yet closed
    v2 = ledger.record_seen(spark.createDataFrame([("20240115", "12", "20240115", "12")], PAIRS))
    assert v2 > v1 and ledger.due() == {H10: v1}                 # closed by a reception two hours on
    ledger.record_checked(ledger.due())
    assert ledger.due() == {} and list(ledger.dirty()) == [("20240115", "12")]
    v3 = ledger.record_seen(spark.createDataFrame([(*H10, "20240118", "03")], PAIRS))
    assert ledger.dirty()[H10].receptions == [("20240115", "10"), ("20240115", "11"), ("20240118", "03")]
    assert H10 not in ledger.due()                               # dirty hours are rebuilt first
    ledger.record_built({H10: v3})
    assert ledger.due()[H10] == v3                               # checked again
    before = ledger.pending()
    assert ledger.compact() > 1 and len(ledger.log.files()) == 1
    assert ledger.pending() == before
    assert ledger.record_seen(spark.createDataFrame([(*H10, "20240118", "04")], PAIRS)) > v3


def run_wave(spark, bronze, lake, meta, docs):
    land(spark, bronze, *docs)
    rows = spark.createDataFrame(list(docs), BRONZE_WITH_PARTITIONS).select(
        document_date().alias("data_ref"), F.substring("hr", 1, 2).alias("hora_id_ref"), "recv_date", "recv_hour")
    HourLedger(spark, lake).record_seen(rows)
    return process_pending(spark, bronze, lake, meta)


def test_a_document_of_any_lateness_rebuilds_and_rechecks_its_hour(spark, tmp_root):
    bronze, lake = f"{tmp_root}/bronze", f"{tmp_root}/lake"
    meta = spark.createDataFrame([("10", 1, 1, "1-10", "D", "O", 5)], META)
    day = "20240115"
    assert run_wave(spark, bronze, lake, meta, [document("10:05", (day, "10")), document("13:05", (day, "13"))]) == ([H10, (day, "13")], [H10])
    lists = lambda t: [r.avg_qtde_onibus for r in read_gold(spark, f"{lake}/gold", t).where("hora_id_ref = '10'").collect()]
    assert (lists("linhas_abaixo_meta"), lists("linhas_atingida_meta")) == ([3], [])
    # five days later more buses of the same hour turn up: the line reached its target after all
    assert run_wave(spark, bronze, lake, meta, [document("10:35", ("20240120", "02"), n=9)])[0] == [H10]
    assert (lists("linhas_abaixo_meta"), lists("linhas_atingida_meta")) == ([], [6])
    assert sorted({r.hora_ref for r in read_silver(spark, f"{lake}/silver").collect()}) == ["10:05", "10:35", "13:05"]
    assert process_pending(spark, bronze, lake, meta) == ([], [])


def test_a_run_that_stopped_half_way_is_done_again(spark, tmp_root, monkeypatch):
    bronze, lake = f"{tmp_root}/bronze", f"{tmp_root}/lake"
    meta = spark.createDataFrame([("10", 1, 1, "1-10", "D", "O", 5)], META)
    docs = [document("10:05", ("20240115", "10")), document("13:05", ("20240115", "13"))]
    monkeypatch.setattr(recompute, "target_job", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        run_wave(spark, bronze, lake, meta, docs)
    monkeypatch.undo()
    assert process_pending(spark, bronze, lake, meta) == ([], [H10])
    assert read_gold(spark, f"{lake}/gold", "linhas_abaixo_meta").count() == 1


def test_only_the_named_reception_folders_are_read(spark, tmp_root):
    land(spark, tmp_root, document("10:05", ("20240115", "10")), document("11:05", ("20240115", "11")), document("10:35", ("20240120", "02")))
    got = landed(spark, tmp_root, [("20240115", "10"), ("20240120", "02"), ("20240116", "09")])
    assert [p[len(tmp_root):] for p in got] == ["/recv_date=20240115/recv_hour=10", "/recv_date=20240120/recv_hour=02"]


def test_document_date_of_late_and_odd_documents(spark):
    rows = [document("10:05", ("20240115", "10")),                                     # in time
            document("10:05", ("20240122", "23")),                                     # a week late
            document("00:02", ("20240116", "00"), day="2024-01-16"),
            ("00:02", document("20:58", ("", ""))[1], "20240116", "09"),               # hr after midnight, captured just before
            ("10:05", [("1-10", 1, 1, "D", "O", 1, [(1, True, "soon", 0.0, 0.0)])], "20240117", "10"),   # no capture time that parses
            ("10:05", [("1-10", 1, 1, "D", "O", 1, [(1, True, "2029-01-01T00:00:00Z", 0.0, 0.0)])], "20240117", "10"),  # clock years ahead
            ("10:05", [("1-10", 1, 1, "D", "O", 0, None)], "20240117", "10"), ("10:05", None, "20240117", "10")]
    got = [r[0] for r in spark.createDataFrame(rows, BRONZE_WITH_PARTITIONS).select(document_date()).collect()]
    assert got == ["20240115", "20240115", "20240116", "20240116", "20240117", "20240117", "20240117", "20240117"]
