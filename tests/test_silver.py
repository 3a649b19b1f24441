"""Flattening hand-made snapshot documents."""

import datetime as dt

from pyspark.sql import Row

from fleetlake.operators.silver import explode_lines, explode_vehicles, flatten_positions
from fleetlake.schemas import SILVER_COLUMNS
from fleetlake.sources.bronze import BRONZE_WITH_PARTITIONS, read_bronze, write_bronze


def veh(p, ta, py=-23.5, px=-46.6):
    return {"p": p, "a": True, "ta": ta, "py": py, "px": px}


def line(cl, vs, qv=2):
    return {"c": f"{cl}-10", "cl": cl, "sl": 1, "lt0": "DEST", "lt1": "ORIG", "qv": qv, "vs": vs}


def docs(spark, rows):
    return spark.createDataFrame(rows, BRONZE_WITH_PARTITIONS)


def test_empty_and_null_vehicle_arrays_drop_the_line(spark):
    d = docs(spark, [Row(hr="10:05", l=[line(1, [veh(11, "2024-01-15T13:05:01Z"), veh(12, "2024-01-15T13:05:02Z")]),
                                         line(2, []), line(3, None)], recv_date="20240115", recv_hour="10")])
    assert explode_lines(d).count() == 3
    out = flatten_positions(d).collect()
    assert len(out) == 2
    assert {r.cod_onibus for r in out} == {11, 12}
    assert all(r.id_linha == 1 for r in out)


def test_capture_time_zone_forms(spark):
    d = docs(spark, [Row(hr="10:05", l=[line(1, [veh(1, "2024-01-15T13:05:01Z"), veh(2, "2024-01-15T13:05:01+00:00"),
                                                  veh(3, "2024-01-15T13:05:01"), veh(4, "not a time")])],
                         recv_date="20240115", recv_hour="10")])
    got = {r.cod_onibus: r.timestamp_pos for r in flatten_positions(d).collect()}
    local = dt.datetime(2024, 1, 15, 10, 5, 1)      # UTC-3 in January 2024
    assert got[1] == local and got[2] == local and got[3] == local
    assert got[4] is None


def test_capture_time_independent_of_session_zone(spark):
    d = docs(spark, [Row(hr="23:04", l=[line(1, [veh(1, "2024-09-19T23:04:00Z")])], recv_date="20240919",
                         recv_hour="20")])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        ts_sp = flatten_positions(d).collect()[0].timestamp_pos
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    ts_utc = flatten_positions(d).collect()[0].timestamp_pos
    assert ts_utc == dt.datetime(2024, 9, 19, 20, 4)
    assert ts_sp == ts_utc


def test_latitude_comes_from_py(spark):
    d = docs(spark, [Row(hr="10:05", l=[line(1, [veh(1, "2024-01-15T13:05:01Z", py=-23.1, px=-46.2)])],
                         recv_date="20240115", recv_hour="10")])
    r = flatten_positions(d).collect()[0]
    assert r.latitude_pos == -23.1 and r.longitude_pos == -46.2


def test_snapshot_received_after_midnight_keeps_its_day(spark):
    d = docs(spark, [Row(hr="23:59", l=[line(1, [veh(1, "2024-01-16T02:59:00Z")])], recv_date="20240116",
                         recv_hour="00"),
                     Row(hr="00:01", l=[line(1, [veh(2, "2024-01-16T03:01:00Z")])], recv_date="20240116",
                         recv_hour="00")])
    got = {r.cod_onibus: (r.data_ref, r.hora_id_ref) for r in flatten_positions(d).collect()}
    assert got == {1: ("20240115", "23"), 2: ("20240116", "00")}
    # the original behaviour (literal date) stays available
    assert {r.data_ref for r in flatten_positions(d, "20240116").collect()} == {"20240116"}


def test_two_documents_same_hr_are_both_kept(spark):
    d = docs(spark, [Row(hr="10:05", l=[line(1, [veh(1, "2024-01-15T13:05:01Z")])], recv_date="20240115",
                         recv_hour="10"),
                     Row(hr="10:05", l=[line(1, [veh(2, "2024-01-15T13:05:03Z")])], recv_date="20240115",
                         recv_hour="10")])
    assert flatten_positions(d).count() == 2


def test_silver_columns_and_json_roundtrip(spark, tmp_root):
    d = docs(spark, [Row(hr="10:05", l=[line(1, [veh(1, "2024-01-15T13:05:01Z")])], recv_date="20240115",
                         recv_hour="10")])
    write_bronze(d, tmp_root)
    back = read_bronze(spark, tmp_root)
    out = flatten_positions(back, with_hour=False)
    assert tuple(out.columns) == SILVER_COLUMNS
    assert out.count() == 1
    assert explode_vehicles(explode_lines(back)).count() == 1


def test_corrupt_documents_are_kept_aside(spark, tmp_root):
    import os
    local = tmp_root.removeprefix("file:")
    os.makedirs(f"{local}/recv_date=20240115/recv_hour=10", exist_ok=True)
    with open(f"{local}/recv_date=20240115/recv_hour=10/a.json", "w") as f:
        f.write('{"hr": "10:05", "l": []}\n{broken\n')
    df = read_bronze(spark, tmp_root, keep_corrupt=True)
    rows = df.collect()
    assert len(rows) == 2
    assert sum(1 for r in rows if r["_corrupt_record"] is not None) == 1


def test_clock_slightly_ahead_keeps_the_day(spark):
    d = docs(spark, [Row(hr="11:00", l=[line(1, [veh(1, "2024-01-15T13:59:00Z")])], recv_date="20240115", recv_hour="10"),
                     Row(hr="00:00", l=[line(1, [veh(2, "2024-01-16T02:59:00Z")])], recv_date="20240115", recv_hour="23")])
    got = {r.cod_onibus: r.data_ref for r in flatten_positions(d).collect()}
    assert got == {1: "20240115", 2: "20240116"}
