"""Query registry: one function per operator / indicator / panel.

Every function takes ``(spark, sf_dir)``, reads the driver tables of that
scale through the fixed mapping in ``sources.fixtures`` and returns a
DataFrame (lazy where the feature allows; sinks write to the shared checkpoint
folder and return the read-back table).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import hour_id, hour_range_predicate, ts_literal
from fleetlake.operators import ingest, merge, quality, silver as silver_ops, stats, targets
from fleetlake.plans import panels
from fleetlake.plans.jobs import hours_predicate, silver_job, stats_job, target_job
from fleetlake.schemas import HOUR_PARTITIONS, SILVER_COLUMNS, TABLES
from fleetlake.session import ensure_conf, scratch_path
from fleetlake.sinks import jdbc as jdbc_sink
from fleetlake.sinks.lake import route_documents, upsert_table, write_hours
from fleetlake.sinks.versions import new_run, run_path
from fleetlake.sources import fixtures
from fleetlake.sources.bronze import read_bronze, write_bronze
from fleetlake.sources.jdbc import read_jdbc, read_target
from fleetlake.sources.lake import read_gold, read_silver

# Fixed parameters of the registered queries.
ONE_HOUR = ("20240115", "10")                      # the original one-hour target run
PARTITION_SPAN = (("20240115", "06"), ("20240115", "17"))
TIME_FROM, TIME_TO = "2024-01-15 09:00:00", "2024-01-15 21:00:00"   # UTC = 06:00-18:00 local
UPSERT_TARGET_LAST, UPSERT_STAGE_FIRST = "20240120", "20240115"
LATE_CUTOFF = "2024-01-15 12:32:00"
LATE_MINUTE, LATE_DAYS = "30", 3                    # documents of that minute land so many days late
STREAM_DELAY = "10 minutes"
STREAM_CHUNKS = (("00000000", "20240116"), ("20240116", "99999999"))


# ---- shared building blocks ---------------------------------------------------

def _ensure(spark, sf):
    ensure_conf(spark)
    return sf


def _silver(spark, sf, exact=False) -> DataFrame:
    ensure_conf(spark)
    return fixtures.load_silver(spark, sf, exact_count=exact)


def _a1(spark, sf):
    return stats.snapshot_per_line(_silver(spark, sf))


def _a4(spark, sf):
    return stats.network_per_snapshot(_a1(spark, sf))


def _gold(spark, sf) -> dict[str, DataFrame]:
    a1 = _a1(spark, sf)
    a4 = stats.network_per_snapshot(a1)
    return {"total_onibus_por_linha": stats.total_per_line(a1),
            "total_onibus_geral": stats.total_network(a4),
            "media_onibus_por_linha": stats.hourly_mean_per_line(a1),
            "media_onibus_geral": stats.hourly_mean_network(a4)}


def _checked(spark, sf) -> DataFrame:
    meta = fixtures.load_target(spark, sf)
    return targets.target_check(meta, _gold(spark, sf)["media_onibus_por_linha"])


def _facts(spark, sf, table) -> DataFrame:
    if table in ("total_onibus_por_linha", "total_onibus_geral", "media_onibus_por_linha", "media_onibus_geral"):
        return _gold(spark, sf)[table]
    return targets.target_outputs(_checked(spark, sf))[table]


UPSERT_MEASURE = {
    "total_onibus_por_linha": "qtde_onibus", "total_onibus_geral": "qtde_onibus",
    "media_onibus_por_linha": "qtde_onibus", "media_onibus_geral": "qtde_onibus",
    "linhas_atingida_meta": "avg_qtde_onibus", "total_linhas_atingida_meta": "qtde_linhas",
    "linhas_abaixo_meta": "avg_qtde_onibus", "total_linhas_abaixo_meta": "qtde_linhas",
}


def _stage_rows(facts: DataFrame, table: str) -> DataFrame:
    m = UPSERT_MEASURE[table]
    return facts.where(F.col("data_ref") >= UPSERT_STAGE_FIRST).withColumn(m, F.col(m) + 1)


# ---- silver -------------------------------------------------------------------

def q_flatten_positions(spark, sf):
    ensure_conf(spark)
    landing = scratch_path(spark, "bronze")
    write_bronze(fixtures.load_bronze(spark, sf), landing)
    flat = silver_ops.flatten_positions(read_bronze(spark, landing), with_hour=False)
    return flat.select(*SILVER_COLUMNS)


def q_silver_job_late_documents(spark, sf):
    """Documents land 5 minutes after their poll, so the last polls of an
    hour (and of a day) are received in the next reception hour; the silver job
    reads each event hour's reception span and stamps the event date."""
    ensure_conf(spark)
    bronze = fixtures.load_bronze(spark, sf, recv_delay_minutes=5)
    landing, silver_path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    write_bronze(bronze, landing)
    # the event hours landed (one key per hour) – the job's hour list
    hours = [(r[0], r[1]) for r in bronze.select(silver_ops.reference_date(), hour_id("hr")).distinct().collect()]
    silver_job(spark, landing, silver_path, hours, lateness_hours=1)
    return read_silver(spark, silver_path).select(*SILVER_COLUMNS)


def q_explode_lines(spark, sf):
    ensure_conf(spark)
    lines = silver_ops.explode_lines(fixtures.load_bronze(spark, sf))
    return lines.select(F.col("recv_date").alias("data_ref"), "hr", F.col("line.c").alias("c"),
                        F.col("line.cl").alias("cl"), F.col("line.qv").alias("qv"))


def q_explode_vehicles(spark, sf):
    ensure_conf(spark)
    veh = silver_ops.explode_vehicles(silver_ops.explode_lines(fixtures.load_bronze(spark, sf)))
    return veh.select(F.col("recv_date").alias("data_ref"), "hr", F.col("line.cl").alias("cl"),
                      F.col("vehicle.p").alias("p"))


def q_hour_partition(spark, sf):
    path = scratch_path(spark, "silver")
    write_hours(_silver(spark, sf, exact=True), path)
    return read_silver(spark, path, hour_range_predicate(*PARTITION_SPAN)).select(*SILVER_COLUMNS)


def q_silver_roundtrip(spark, sf):
    path = scratch_path(spark, "silver")
    write_hours(_silver(spark, sf, exact=True), path)
    return read_silver(spark, path).select(*SILVER_COLUMNS)


# ---- statistics ---------------------------------------------------------------

def q_snapshot_total_per_line(spark, sf):
    return stats.total_per_line(_a1(spark, sf))


def q_hourly_mean_per_line(spark, sf):
    return stats.hourly_mean_per_line(_a1(spark, sf))


def q_snapshot_total_network(spark, sf):
    return stats.total_network(_a4(spark, sf))


def q_hourly_mean_network(spark, sf):
    return stats.hourly_mean_network(_a4(spark, sf))


def q_gold_roundtrip(spark, sf):
    silver_path, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    write_hours(_silver(spark, sf), silver_path)
    stats_job(spark, silver_path, gold_root)
    return read_gold(spark, gold_root, "total_onibus_por_linha")


def q_hour_overwrite(spark, sf):
    """First run sees only rows captured before the cutoff; the closing run
    recomputes every hour the late rows touch, from all of their rows."""
    silver = _silver(spark, sf)
    silver_path, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    cutoff = ts_literal(LATE_CUTOFF)
    write_hours(silver.where(F.col("timestamp_pos") < cutoff), silver_path)
    stats_job(spark, silver_path, gold_root)
    late = silver.where(F.col("timestamp_pos") >= cutoff)
    touched = [(r[0], r[1]) for r in late.select(*HOUR_PARTITIONS).distinct().collect()]
    write_hours(silver.where(hours_predicate(touched)), silver_path)
    stats_job(spark, silver_path, gold_root, touched)
    return read_gold(spark, gold_root, "media_onibus_por_linha")


# ---- targets ------------------------------------------------------------------

def q_target_one_hour(spark, sf):
    meta = fixtures.load_target(spark, _ensure(spark, sf))
    return targets.target_one_hour(meta, _gold(spark, sf)["media_onibus_por_linha"], *ONE_HOUR)


def q_target_job_roundtrip(spark, sf):
    """The target job over written hourly means, all hours, read back."""
    gold_root = scratch_path(spark, "gold")
    means = _gold(spark, sf)["media_onibus_por_linha"]
    write_hours(means, f"{gold_root}/media_onibus_por_linha")
    target_job(spark, gold_root, fixtures.load_target(spark, sf))
    return read_gold(spark, gold_root, "linhas_abaixo_meta")


def q_target_check(spark, sf):
    return _checked(spark, sf)


def q_lines_reached(spark, sf):
    return targets.lines_reached(_checked(spark, sf))


def q_lines_below(spark, sf):
    return targets.lines_below(_checked(spark, sf))


def q_lines_without_bus(spark, sf):
    return targets.lines_without_bus(_checked(spark, sf))


def q_lines_reached_total(spark, sf):
    return targets.count_lines(targets.lines_reached(_checked(spark, sf)))


def q_lines_below_total(spark, sf):
    return targets.count_lines(targets.lines_below(_checked(spark, sf)))


# ---- sinks --------------------------------------------------------------------

def _upsert_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        facts = _facts(spark, sf, table)
        root = scratch_path(spark, "gold")
        existing = facts.where(F.col("data_ref") <= UPSERT_TARGET_LAST)
        t = TABLES[table]
        if "hora_id_ref" not in t.columns:
            existing = existing.withColumn("hora_id_ref", F.substring(t.hour_col, 1, 2))
        write_hours(existing, f"{root}/{table}")
        upsert_table(spark, _stage_rows(facts, table), root, table)
        return read_gold(spark, root, table)
    run.__name__ = f"q_upsert_{table}"
    return run


def q_jdbc_roundtrip(spark, sf):
    """Stage write (truncate) + append into an in-process Derby database, then a
    4-way partitioned read.  Embedded Derby opens no port."""
    facts = _gold(spark, sf)["media_onibus_por_linha"]
    url = f"jdbc:derby:memory:fleetlake_{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    table = "MEDIA_ONIBUS_POR_LINHA"
    jdbc_sink.write_stage(facts.where(F.col("data_ref") < UPSERT_STAGE_FIRST), url, table, props)
    jdbc_sink.append_rows(facts.where(F.col("data_ref") >= UPSERT_STAGE_FIRST), url, table, props)
    back = read_jdbc(spark, url, table, props, column="id_linha", lower=0, upper=5, num_partitions=4)
    return back.select(*[F.col(c.upper()).alias(c) for c in TABLES["media_onibus_por_linha"].columns])


def _duplicated_facts(spark, sf):
    facts = _facts(spark, sf, "total_onibus_por_linha")
    return facts.unionByName(_stage_rows(facts, "total_onibus_por_linha"))


def q_dedup_latest_per_key(spark, sf):
    """Optional dedup ahead of K6: of two rows per key the larger count wins."""
    keys = TABLES["total_onibus_por_linha"].keys
    return merge.latest_per_key(_duplicated_facts(spark, sf), keys, ["qtde_onibus"])


def q_key_violations(spark, sf):
    return quality.key_violations(_duplicated_facts(spark, sf), TABLES["total_onibus_por_linha"].keys)


def q_null_key_violations(spark, sf):
    facts = _facts(spark, sf, "total_onibus_por_linha")
    # injected defect: snapshots at minutes x5 lost their line id
    broken = facts.withColumn("id_linha", F.when(F.substring("hora_ref", 5, 1) == "5", F.lit(None))
                              .otherwise(F.col("id_linha")))
    return quality.null_key_violations(broken, TABLES["total_onibus_por_linha"].keys)


# ---- ingestion ----------------------------------------------------------------

def _flagged(spark, sf):
    ensure_conf(spark)
    return ingest.validate_payloads(fixtures.load_payloads(spark, sf))


def q_payload_ok(spark, sf):
    return ingest.ok_payloads(_flagged(spark, sf)).select("payload_id", "name", "payload_len")


def q_payload_nok(spark, sf):
    return ingest.nok_payloads(_flagged(spark, sf)).select("payload_id", "name", "payload_len")


def q_ingest_documents(spark, sf):
    """I1-I3 end to end: raw files are routed by size, read back as bronze and
    flattened; one row per side and reception hour."""
    ensure_conf(spark)
    drop, landing, nok = (scratch_path(spark, n) for n in ("drop", "landing", "nok"))
    fixtures.write_raw_documents(spark, sf, drop)
    route_documents(spark, drop, landing, nok, min_length=fixtures.RAW_MIN)
    by = ["recv_date", "recv_hour"]
    docs = read_bronze(spark, landing, multi_line=True)
    landed = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"))
    flat = silver_ops.flatten_positions(docs).groupBy(F.col("data_ref").alias("recv_date"), F.col("hora_id_ref").alias("recv_hour")).agg(
        F.count(F.lit(1)).alias("positions"))
    ok = landed.join(flat, by).select(F.lit("ok").alias("side"), *by, "documents", "positions")
    failed = spark.read.text(nok, wholetext=True).select(F.split("slot", "_").alias("slot"))
    failed = failed.groupBy(F.col("slot")[0].alias("recv_date"), F.col("slot")[1].alias("recv_hour")).agg(F.count(F.lit(1)).alias("documents"))
    return ok.unionByName(failed.select(F.lit("nok").alias("side"), *by, "documents", F.lit(0).cast("long").alias("positions")))


def q_bad_documents(spark, sf):
    """Documents that do not parse go to quarantine, the rest to silver."""
    ensure_conf(spark)
    landing, silver_path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    fixtures.write_damaged_bronze(spark, sf, landing)
    silver_job(spark, landing, silver_path)
    by = ["recv_date", "recv_hour"]
    good = read_silver(spark, silver_path).groupBy(F.col("data_ref").alias("recv_date"), F.col("hora_id_ref").alias("recv_hour")).agg(
        F.count(F.lit(1)).alias("positions"))
    bad = spark.read.parquet(f"{silver_path}_quarantine").where(F.col("source_file").isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("bad_documents"))
    return good.join(bad, by, "full").na.fill(0, ["positions", "bad_documents"])


def q_silver_emptied_hour(spark, sf):
    """Documents of one hour are withdrawn; a rerun of its day leaves none of its rows."""
    ensure_conf(spark)
    bronze, silver_path = fixtures.load_bronze(spark, sf), scratch_path(spark, "silver")
    before, after = scratch_path(spark, "bronze"), scratch_path(spark, "bronze")
    write_bronze(bronze, before)
    silver_job(spark, before, silver_path)
    day = bronze.where(F.col("recv_date") == ONE_HOUR[0])
    hours = [(r[0], r[1]) for r in day.select("recv_date", "recv_hour").distinct().collect()]
    write_bronze(day.where(F.col("recv_hour") != ONE_HOUR[1]), after)
    silver_job(spark, after, silver_path, hours)
    return read_silver(spark, silver_path).select(*SILVER_COLUMNS)


# ---- one commit for a job's tables ------------------------------------------------

def q_commit_killed_job(spark, sf):
    """K7: a rerun that ends after writing two of its four tables changes none of them."""
    silver = _silver(spark, sf)
    silver_path, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    early = silver.where(F.col("timestamp_pos") < ts_literal(LATE_CUTOFF))
    write_hours(early, silver_path)
    stats_job(spark, silver_path, gold_root)
    whole, run = _gold(spark, sf), new_run("stats")
    for table in ("total_onibus_por_linha", "total_onibus_geral"):  # written, never committed
        write_hours(whole[table].withColumn("hora_id_ref", F.substring("hora_ref", 1, 2)), run_path(gold_root, table, run))
    out = None
    for table in whole:
        rows = read_gold(spark, gold_root, table).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qtde_onibus").alias("qtde_onibus"))
        rows = rows.select(F.lit(table).alias("table_name"), "n_rows", "qtde_onibus")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_key_violations_by_table(spark, sf):
    """C1 on every table a job writes: violated keys after some target rows were doubled."""
    meta = fixtures.load_target(spark, _ensure(spark, sf))
    doubled = meta.unionByName(meta.where(F.col("id_linha") == 3))
    gold = _gold(spark, sf)
    tables = {"meta_onibus_por_linha": doubled, **gold, **targets.target_outputs(targets.target_check(doubled, gold["media_onibus_por_linha"]))}
    out = None
    for name, df in tables.items():
        rows = quality.key_violations(df, TABLES[name].keys).agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        rows = rows.select(F.lit(name).alias("table_name"), "n_keys", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_jdbc_target_job(spark, sf):
    """S5/K4 inside the target job: target hours read over JDBC with the filter pushed
    down and bounds taken from the table; the committed list replaces its stage table."""
    url, props = f"jdbc:derby:memory:fleetlake_{uuid.uuid4().hex[:8]};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    gold_root, hours = scratch_path(spark, "gold"), [ONE_HOUR, (ONE_HOUR[0], "11"), ("20240116", "10")]
    jdbc_sink.write_stage(fixtures.load_target(spark, _ensure(spark, sf)), url, "meta_onibus_por_linha", props)
    write_hours(_gold(spark, sf)["media_onibus_por_linha"], f"{gold_root}/media_onibus_por_linha")
    run = target_job(spark, gold_root, read_target(spark, url, "meta_onibus_por_linha", hours, props), hours)
    names = jdbc_sink.publish_stage(spark, gold_root, run.tables, hours_predicate(hours), url, props)
    back = read_jdbc(spark, url, names["linhas_abaixo_meta"], props)
    return back.select(*[F.col(c.upper()).alias(c) for c in TABLES["linhas_abaixo_meta"].columns])


# ---- dashboard panels -----------------------------------------------------------

_STORED: dict[tuple[str, str], str] = {}


def stored_gold(spark, sf) -> str:
    """Root of the gold tables of ``sf``, written by the jobs on first use in a session.

    Panels serve stored tables, as the dashboard does: what a panel costs is its own
    read, not the jobs before it."""
    ensure_conf(spark)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        lake = scratch_path(spark, "lake")
        write_hours(_silver(spark, sf), f"{lake}/silver")
        stats_job(spark, f"{lake}/silver", f"{lake}/gold")
        target_job(spark, f"{lake}/gold", fixtures.load_target(spark, sf))
        _STORED[key] = f"{lake}/gold"
    return _STORED[key]


def _range(spark, sf, table, shift):
    return panels.stored_range(spark, stored_gold(spark, sf), table, TIME_FROM, TIME_TO, shift)


def _newest(spark, sf, table, rows, shift=None):
    span = () if shift is None else (TIME_FROM, TIME_TO, shift)
    return panels.stored_newest(spark, stored_gold(spark, sf), table, rows, *span)


def q_panel_below_total(spark, sf):
    return panels.stored_below_total_last(spark, stored_gold(spark, sf))


def q_panel_below_top20(spark, sf):
    return panels.below_top(_newest(spark, sf, "linhas_abaixo_meta", 20))


def q_panel_network_last(spark, sf):
    return panels.network_last(_newest(spark, sf, "total_onibus_geral", 1))


def q_panel_network_series(spark, sf):
    return panels.network_series(_range(spark, sf, "total_onibus_geral", panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)


def q_panel_line_last25(spark, sf):
    return panels.line_totals_top(_newest(spark, sf, "total_onibus_por_linha", 25, panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)


def q_panel_mean_network_last(spark, sf):
    return panels.mean_network_last(_newest(spark, sf, "media_onibus_geral", 1, panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)


def q_panel_line_table(spark, sf):
    return panels.line_table(_range(spark, sf, "total_onibus_por_linha", panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)


def q_panel_line_table_by_origin(spark, sf):
    return panels.line_table(_range(spark, sf, "total_onibus_por_linha", panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT,
                             sort_desc=False, sort_by="origem")


def q_panel_line_table_total(spark, sf):
    table = panels.line_table(_range(spark, sf, "total_onibus_por_linha", panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)
    return panels.line_table_grand_total(table)


def q_panel_mean_line_last25(spark, sf):
    return panels.mean_line_top(_newest(spark, sf, "media_onibus_por_linha", 25, panels.NEW_SHIFT), TIME_FROM, TIME_TO, panels.NEW_SHIFT)


def q_panel_network_series_local(spark, sf):
    return panels.network_series(_range(spark, sf, "total_onibus_geral", panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT)


def q_panel_mean_network_series(spark, sf):
    return panels.mean_network_series(_range(spark, sf, "media_onibus_geral", panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT)


def q_panel_mean_line_first25(spark, sf):
    return panels.mean_line_top(_range(spark, sf, "media_onibus_por_linha", panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT,
                                newest_first=False)


def q_panel_line_last25_local(spark, sf):
    return panels.line_totals_top(_newest(spark, sf, "total_onibus_por_linha", 25, panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT)


def q_panel_line_totals(spark, sf):
    return panels.line_totals_range(_range(spark, sf, "total_onibus_por_linha", panels.OLD_SHIFT), TIME_FROM, TIME_TO, panels.OLD_SHIFT)


# ---- streaming ------------------------------------------------------------------

def q_stream_hourly_recompute(spark, sf):
    """V1/V2: early rows land, the stream recomputes their hours; late rows land
    in the same hour folders, the next run recomputes the hours they touch."""
    from fleetlake.streaming.recompute import start_recompute
    silver = _silver(spark, sf)
    silver_path, gold_root = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    ckpt = scratch_path(spark, "stream-ckpt")
    cutoff = ts_literal(LATE_CUTOFF)
    for part in (silver.where(F.col("timestamp_pos") < cutoff), silver.where(F.col("timestamp_pos") >= cutoff)):
        write_hours(part, silver_path, mode="append")
        start_recompute(spark, silver_path, gold_root, ckpt, max_files_per_trigger=256).awaitTermination()
    return read_gold(spark, gold_root, "media_onibus_por_linha")


def q_stream_pipeline(spark, sf):
    """V1-V3 in one stream: documents land 5 minutes after their poll in two
    waves; each run rebuilds the touched hours and target-checks closed hours."""
    from fleetlake.streaming.recompute import start_pipeline
    ensure_conf(spark)
    bronze = fixtures.load_bronze(spark, sf, recv_delay_minutes=5)
    landing, lake, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "lake"), scratch_path(spark, "pipe-ckpt")
    meta = fixtures.load_target(spark, sf)
    for part in (bronze.where(F.col("recv_date") < "20240115"), bronze.where(F.col("recv_date") >= "20240115")):
        write_bronze(part, landing, mode="append")
        start_pipeline(spark, landing, lake, meta, ckpt, max_files_per_trigger=400).awaitTermination()
    return read_gold(spark, f"{lake}/gold", "linhas_abaixo_meta")


def q_stream_late_wave(spark, sf):
    """A wave of documents lands three days late, after their hours were
    checked; the ledger has their hours rebuilt and checked again."""
    from fleetlake.streaming.recompute import start_pipeline
    ensure_conf(spark)
    bronze = fixtures.load_bronze(spark, sf, recv_delay_minutes=5, late_minute=LATE_MINUTE, late_days=LATE_DAYS)
    landing, lake, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "lake"), scratch_path(spark, "pipe-ckpt")
    meta, late = fixtures.load_target(spark, sf), F.substring("hr", 4, 2) == LATE_MINUTE
    for part in (bronze.where(~late), bronze.where(late)):
        write_bronze(part, landing, mode="append")
        start_pipeline(spark, landing, lake, meta, ckpt).awaitTermination()
    return read_gold(spark, f"{lake}/gold", "linhas_abaixo_meta")


def q_stream_hourly_watermark(spark, sf):
    """V7: chained event-time windows in append mode; each run takes the files
    landed since the last run (time-ordered chunks), like a scheduled job."""
    from fleetlake.schemas import SILVER
    from fleetlake.sources.lake import with_hour_column
    from fleetlake.streaming.rollup import start_hourly_means
    silver = _silver(spark, sf)
    src, out, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "hourly"), scratch_path(spark, "wm-ckpt")
    for lo, hi in STREAM_CHUNKS:
        chunk = silver.where((F.col("data_ref") >= lo) & (F.col("data_ref") < hi))
        write_hours(chunk, src, mode="append")
        stream = spark.readStream.schema(with_hour_column(SILVER)).parquet(src)
        start_hourly_means(spark, stream, out, ckpt, delay=STREAM_DELAY).awaitTermination()
    return spark.read.schema(TABLES["media_onibus_por_linha"].schema).parquet(out)


# ---- registry -------------------------------------------------------------------

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "flatten_positions": q_flatten_positions,
        "silver_job_late_documents": q_silver_job_late_documents,
        "explode_lines": q_explode_lines,
        "explode_vehicles": q_explode_vehicles,
        "hour_partition": q_hour_partition,
        "snapshot_total_per_line": q_snapshot_total_per_line,
        "hourly_mean_per_line": q_hourly_mean_per_line,
        "snapshot_total_network": q_snapshot_total_network,
        "hourly_mean_network": q_hourly_mean_network,
        "target_one_hour": q_target_one_hour,
        "target_check": q_target_check,
        "target_job_roundtrip": q_target_job_roundtrip,
        "lines_reached": q_lines_reached,
        "lines_below": q_lines_below,
        "lines_without_bus": q_lines_without_bus,
        "lines_reached_total": q_lines_reached_total,
        "lines_below_total": q_lines_below_total,
    }
    for table in UPSERT_MEASURE:
        q[f"upsert_{table}"] = _upsert_query(table)
    q.update({
        "silver_roundtrip": q_silver_roundtrip,
        "gold_roundtrip": q_gold_roundtrip,
        "hour_overwrite": q_hour_overwrite,
        "jdbc_roundtrip": q_jdbc_roundtrip,
        "dedup_latest_per_key": q_dedup_latest_per_key,
        "key_violations": q_key_violations,
        "null_key_violations": q_null_key_violations,
        "payload_ok": q_payload_ok,
        "payload_nok": q_payload_nok,
        "ingest_documents": q_ingest_documents,
        "bad_documents": q_bad_documents,
        "silver_emptied_hour": q_silver_emptied_hour,
        "commit_killed_job": q_commit_killed_job,
        "key_violations_by_table": q_key_violations_by_table,
        "jdbc_target_job": q_jdbc_target_job,
        "panel_below_total": q_panel_below_total,
        "panel_below_top20": q_panel_below_top20,
        "panel_network_last": q_panel_network_last,
        "panel_network_series": q_panel_network_series,
        "panel_line_last25": q_panel_line_last25,
        "panel_mean_network_last": q_panel_mean_network_last,
        "panel_line_table": q_panel_line_table,
        "panel_line_table_by_origin": q_panel_line_table_by_origin,
        "panel_line_table_total": q_panel_line_table_total,
        "panel_mean_line_last25": q_panel_mean_line_last25,
        "panel_network_series_local": q_panel_network_series_local,
        "panel_mean_network_series": q_panel_mean_network_series,
        "panel_mean_line_first25": q_panel_mean_line_first25,
        "panel_line_last25_local": q_panel_line_last25_local,
        "panel_line_totals": q_panel_line_totals,
        "stream_hourly_recompute": q_stream_hourly_recompute,
        "stream_hourly_watermark": q_stream_hourly_watermark,
        "stream_pipeline": q_stream_pipeline,
        "stream_late_wave": q_stream_late_wave,
    })
    return q
