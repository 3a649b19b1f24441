"""Hour-partitioned Parquet tables.

* ``write_hours`` replaces exactly the hours present in the frame (dynamic
  partition overwrite), so re-runs are idempotent (V4) and other hours are
  untouched.
* ``clear_hours`` empties processed hours that produced no rows (G9): a dynamic
  overwrite with no rows would otherwise leave the previous run's rows.
* ``upsert_table`` merges a stage frame into a table by key, rewriting only the
  touched hours, as a new version of them that the manifest then publishes: the
  files that the merge reads are never overwritten.
* ``mark_done`` records one completion row per (job, hour) after all tables of
  a job are committed.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from fleetlake.operators.merge import upsert_frames
from fleetlake.operators.quality import raise_violations
from fleetlake.schemas import HOUR_PARTITIONS, TABLES
from fleetlake.session import scratch_path
from fleetlake.sinks.versions import commit, new_run, run_path
from fleetlake.sources.lake import read_gold


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` can be read as a table (the reader checks the path eagerly)."""
    try:
        spark.read.format("parquet").load(path).schema
        return True
    except AnalysisException:
        return False


def write_hours(df: DataFrame, path: str, partition_cols=HOUR_PARTITIONS, *, rebalance: bool = True,
                layout: str | None = None, hours_hint: int | None = None,
                max_records_per_file: int | None = None, mode: str = "overwrite") -> None:
    """Write partitioned by (date, hour); ``overwrite`` replaces only the hours present.

    Layouts:

    * ``"rebalance"`` (default) – ``REBALANCE`` hint on the partition columns:
      each hour is written by few tasks, and AQE splits a hot hour over several
      tasks and merges small ones.  For raw rows, where one hour may be huge.
    * ``"hash"`` – hash-partition by hour into ``min(hours_hint, shuffle
      partitions)`` tasks: one file per hour, all hours written in parallel.
      For gold tables, whose rows per hour are bounded by lines x polls, so no
      hour can overload a task, and tiny tables (one row per hour) are not
      coalesced into a single task writing thousands of files.
    * ``"none"`` – keep the upstream partitioning (narrow plans whose tasks
      already hold one or two hours).
    """
    layout = layout or ("rebalance" if rebalance else "none")
    out = df
    if layout == "rebalance":
        out = df.hint("rebalance", *partition_cols)
    elif layout == "hash":
        width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = df.repartition(max(1, min(width, hours_hint or width)), *partition_cols)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(*partition_cols).parquet(path)


def clear_hours(spark: SparkSession, path: str, written: DataFrame, processed: list[tuple[str, str]],
                schema) -> list[tuple[str, str]]:
    """Empty the processed hours that still hold rows from an earlier run
    but produced no rows now (a dynamic overwrite leaves such hours untouched).

    ``processed`` is the driver-side list of hours the job covered; which of
    them exist on disk and which were just written are two small distinct
    queries over partition columns.  Only stale hours get an (empty) static
    overwrite, so a normal run launches no per-hour jobs.
    """
    if not processed or not table_exists(spark, path):
        return []
    keys = sorted({d + h for d, h in processed})
    in_scope = F.concat(F.col("data_ref"), F.col("hora_id_ref")).isin(keys)
    on_disk = {(r[0], r[1]) for r in spark.read.schema(schema).parquet(path).where(in_scope)
               .select(*HOUR_PARTITIONS).distinct().collect()}
    present = {(r[0], r[1]) for r in written.select(*HOUR_PARTITIONS).distinct().collect()}
    stale = sorted(on_disk - present)
    blank = spark.createDataFrame([], schema)
    for d, h in stale:
        blank.write.mode("overwrite").parquet(f"{path.rstrip('/')}/data_ref={d}/hora_id_ref={h}")
    return stale


def _stage_with_hour(stage: DataFrame, hour_col: str) -> DataFrame:
    if "hora_id_ref" in stage.columns:
        return stage
    return stage.withColumn("hora_id_ref", F.substring(hour_col, 1, 2))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back, so that what
    follows (checks, hour lists, several outputs) evaluates it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_hours(stage: DataFrame, keys, sample: int = 20) -> list[tuple[str, str]]:
    """Hours of a staged frame, or ``KeyViolation``: keys, NULLs and hours in one aggregate.

    The driver gets one row per hour, with one of its offending keys."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    by = list(dict.fromkeys([*HOUR_PARTITIONS, *keys]))
    counted = stage.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("null_key", any_null)
    offending = F.when((F.col("n_rows") > 1) | F.col("null_key"), F.struct(*keys, "n_rows", "null_key"))
    per_hour = counted.groupBy(*HOUR_PARTITIONS).agg(F.min(offending).alias("bad")).collect()
    raise_violations(keys, [r["bad"] for r in per_hour if r["bad"] is not None][:sample])
    return sorted((r[0], r[1]) for r in per_hour)


def prepare_upsert(spark: SparkSession, stage: DataFrame, root: str, table: str, run: str, *,
                   check_keys: bool = True) -> tuple[DataFrame, list[tuple[str, str]]]:
    """K6 up to publication: the merged rows of the touched hours, written as version ``run``.

    The stage is computed once, into the shared scratch folder."""
    t = TABLES[table]
    rows = staged(_stage_with_hour(stage.select(*t.columns), t.hour_col), f"stage-{table}")
    touched = checked_hours(rows, t.keys) if check_keys else sorted((r[0], r[1]) for r in rows.select(*HOUR_PARTITIONS).distinct().collect())
    # a predicate on partition columns only: the scan reads just those hours
    hours = F.concat(F.col("data_ref"), F.col("hora_id_ref")).isin([d + h for d, h in touched])
    try:
        current = read_gold(spark, root, table, hours, keep_hour_column=True)
        merged = upsert_frames(current.select(*rows.columns), rows, t.keys)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # anything else would lose the table's rows
            raise
        merged = rows                              # first run
    if touched:
        write_hours(merged, run_path(root, table, run), layout="hash", hours_hint=len(touched))
    return merged, touched


def upsert_table(spark: SparkSession, stage: DataFrame, root: str, table: str, *,
                 check_keys: bool = True) -> DataFrame:
    """K6: ``INSERT .. ON CONFLICT (keys) DO UPDATE`` on a Parquet table.

    Only the hours present in ``stage`` are read and rewritten, as a new version that
    readers see once it is complete.  Duplicate or NULL stage keys fail the call
    (C1/C2), as the database statement would.  Returns the merged rows of the touched hours.
    """
    run = new_run("upsert")
    merged, touched = prepare_upsert(spark, stage, root, table, run, check_keys=check_keys)
    if touched:
        commit(spark, root, "upsert", run, {table: touched})
    return merged


def route_payloads(flagged: DataFrame, landing_root: str, quarantine_root: str,
                   recv_ts: str = "recv_ts") -> None:
    """OK payloads to the landing zone by reception date/hour, failed ones
    to quarantine by reception ``yyyyMMdd_HH`` – two writes of one flagged frame."""
    from fleetlake.operators.ingest import landing_name, nok_payloads, ok_payloads
    named = flagged.withColumn("file_name", landing_name(recv_ts))
    ok = (ok_payloads(named).withColumn("recv_date", F.date_format(recv_ts, "yyyyMMdd"))
          .withColumn("recv_hour", F.date_format(recv_ts, "HH")))
    write_hours(ok.drop(recv_ts), landing_root, ("recv_date", "recv_hour"))
    nok = nok_payloads(named).withColumn("recv_slot", F.date_format(recv_ts, "yyyyMMdd_HH"))
    write_hours(nok.drop(recv_ts), quarantine_root, ("recv_slot",))


def route_documents(spark: SparkSession, drop_zone: str, landing_root: str, quarantine_root: str,
                    min_length: int | None = None) -> dict[str, int]:
    """I1-I3 on files: OK documents to the landing zone, failed ones to quarantine; returns both counts.

    A document is a file of its own in a folder that carries its name:
    ``recv_date=yyyyMMdd/recv_hour=HH/document=yyyyMMdd_HH_<id>`` in the landing zone,
    which ``read_bronze`` and the pipeline stream read (``multi_line``, as a document
    may span lines), ``slot=yyyyMMdd_HH/document=..`` in quarantine.  A file routed
    again replaces its own copy.  The counts are observed in the writes.
    """
    from fleetlake.operators.ingest import MIN_PAYLOAD, document_name, flag_documents, nok_payloads, ok_payloads, raw_documents
    flagged = flag_documents(raw_documents(spark, drop_zone), MIN_PAYLOAD if min_length is None else min_length).withColumn("document", document_name())
    sides = {"ok": (ok_payloads(flagged), landing_root, ("recv_date", "recv_hour", "document")),
             "nok": (nok_payloads(flagged).withColumn("slot", F.concat_ws("_", "recv_date", "recv_hour")), quarantine_root, ("slot", "document"))}
    counts = {}
    for side, (rows, root, by) in sides.items():
        seen = Observation(f"route_{side}")
        (rows.observe(seen, F.count(F.lit(1)).alias("n")).select("body", *by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*by).text(root))
        counts[side] = seen.get["n"]
    return counts


def mark_done(spark: SparkSession, root: str, job: str, hours: list[tuple[str, str]]) -> None:
    """K7: completion marker rows, appended after every table of the job is written."""
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    rows = [(job, d, h, now) for d, h in hours]
    # one file for each day, however many default partitions the session has
    (spark.createDataFrame(rows, "job string, data_ref string, hora_id_ref string, finished_utc string").coalesce(1)
     .write.mode("append").partitionBy("job", "data_ref").parquet(f"{root.rstrip('/')}/_job_runs"))
