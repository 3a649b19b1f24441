"""The three batch jobs of the pipeline, for one hour or any span of hours.

* ``silver_job``  – bronze landing -> silver positions (event-hour partitions)
* ``stats_job``   – silver -> the four statistics tables
* ``target_job``  – hourly means + target table -> the four target tables

Each job recomputes whole event hours and replaces them (idempotent, V4), so a
re-run after late files (V2) or a backfill over many hours (S7) is the same
call with a different hour list.  What several outputs share is written once to
the shared scratch folder, so they do not rescan the input and a lost executor
does not bring the scan back.  A job's tables are written as new versions and
published by one manifest file (K7, ``sinks/versions``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators.quality import assert_keys_valid
from fleetlake.operators.silver import document_date, flatten_positions
from fleetlake.operators.stats import (hourly_mean_network, hourly_mean_per_line, network_per_snapshot,
                                       snapshot_per_line, total_network, total_per_line)
from fleetlake.operators.targets import target_check, target_outputs
from fleetlake.schemas import META, SILVER, TABLES, assert_schema
from fleetlake.sinks.lake import mark_done, prepare_upsert, staged, write_hours
from fleetlake.sinks.versions import commit, known_hours, new_run, run_path
from fleetlake.sources.bronze import BRONZE_WITH_PARTITIONS, CORRUPT, bad_document, landed, read_bronze
from fleetlake.sources.lake import read_gold, read_silver, split_path, with_hour_column


def hours_predicate(hours: list[tuple[str, str]] | None, date_col="data_ref", hour_col="hora_id_ref") -> Column | None:
    """Partition-column predicate for an explicit list of hours (None = all)."""
    if hours is None:
        return None
    keys = sorted({d + h for d, h in hours})
    return F.concat(F.col(date_col), F.col(hour_col)).isin(keys)


def _reception_span(hours: list[tuple[str, str]], lateness_hours: int) -> list[tuple[str, str]]:
    from datetime import datetime, timedelta
    out = set()
    for d, h in hours:
        t = datetime.strptime(d + h, "%Y%m%d%H")
        for k in range(lateness_hours + 1):
            u = t + timedelta(hours=k)
            out.add((u.strftime("%Y%m%d"), u.strftime("%H")))
    return sorted(out)


@dataclass
class JobRun:
    """What a job did: its tables (lazy frames), row counts (A14) and status.

    ``rows_in`` and ``rows_out`` are observed in the writes themselves, so they cost no
    job of their own (a stage that Spark has to run again may count its rows again).
    ``status`` is ``done``, or ``no input`` where none of the asked hours exists in the
    job's input (G10): nothing is written or marked then.
    """

    tables: dict[str, DataFrame] = field(default_factory=dict)
    observation: Observation | None = None
    status: str = "done"
    rows_in: int = 0
    rows_out: dict[str, int] = field(default_factory=dict)
    bad_documents: int = 0
    missing: list[tuple[str, str]] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def items(self):
        return self.tables.items()


def run_concurrently(tasks: dict) -> dict:
    """Submit independent write jobs from driver threads so they share the
    cluster instead of running one after another; re-raises the first error."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted in whatever action runs it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def observed(seen: Observation, name: str) -> int:
    """A count after its action; 0 where Spark found the input empty and dropped its plan, counts included."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return 0


def silver_job(spark: SparkSession, bronze_root: str, silver_path: str,
               hours: list[tuple[str, str]] | None = None, lateness_hours: int = 1, *,
               receptions: list[tuple[str, str]] | None = None, quarantine: str | None = None,
               multi_line: bool = False) -> JobRun:
    """Bronze -> silver for the given *event* hours (None = everything landed).

    Which reception hours are read: the ``receptions`` named (the hour ledger knows
    them, whatever the lateness), or else, as an event hour's documents can arrive
    up to ``lateness_hours`` later, [h, h + lateness] (G4).  Only the asked event
    hours are written, all of them: one that has no rows any more is emptied (G9).

    Documents that do not parse, or name no minute, are no rows: they go to
    ``quarantine`` (``<silver>_quarantine`` unless named) with their source file.
    Both sides come from the same PERMISSIVE read, and their counts from the silver
    write; only where there are bad documents are they read again to be kept.
    """
    run = JobRun()
    if hours is not None and receptions is None:
        receptions = _reception_span(hours, lateness_hours)
    try:
        if receptions is not None and not landed(spark, bronze_root, receptions):
            return JobRun(status="no input", missing=list(hours or []))
        documents = read_bronze(spark, bronze_root, receptions=receptions, multi_line=multi_line, keep_corrupt=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return JobRun(status="no input", missing=list(hours or []))
    assert_schema(documents, BRONZE_WITH_PARTITIONS)
    bad = bad_document()
    seen = Observation("silver_input")
    watched = documents.observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(bad).alias("bad"))
    silver = flatten_positions(watched.where(~bad), document_date())
    assert_schema(silver, with_hour_column(SILVER))
    if hours is not None:
        silver = silver.where(hours_predicate(hours))
    out, written = counted(silver, "silver_rows")
    root, table = split_path(silver_path)
    version = new_run("silver")
    # The plan is narrow (scan, explode, project): landing files are already
    # grouped by reception hour, so each task holds rows of one or two event
    # hours.  No REBALANCE here – it would shuffle every raw position of a
    # backfill only to shape files.
    write_hours(out, run_path(root, table, version), rebalance=False)
    commit(spark, root, "silver", version, {table: hours or []})
    run.tables, run.observation = {table: silver}, seen
    run.rows_in, run.bad_documents, run.rows_out = observed(seen, "documents"), observed(seen, "bad"), {table: observed(written, "rows")}
    if run.bad_documents:
        kept = documents.where(bad).select(
            F.col("_metadata.file_path").alias("source_file"), F.col(CORRUPT).alias("document"), "hr", F.size("l").alias("n_lines"),
            F.when(F.col(CORRUPT).isNotNull(), "does not parse").otherwise("no reference time").alias("reason"), "recv_date", "recv_hour")
        # whole reception hours are replaced, so a rerun keeps one copy
        write_hours(kept, quarantine or f"{silver_path.rstrip('/')}_quarantine", ("recv_date", "recv_hour"))
    return run


def stats_job(spark: SparkSession, silver_path: str, gold_root: str,
              hours: list[tuple[str, str]] | None = None, *, upsert: bool = False) -> JobRun:
    """Silver -> total/mean per line and network for the given hours.

    Duplicate or NULL keys fail the job before any table changes (G5); a listed
    hour without silver rows ends up empty in all four tables (G9).  The four
    tables are published together (K7).  ``upsert`` merges by key instead of
    replacing the hours.
    """
    known = known_hours(spark, *split_path(silver_path), hours_predicate(hours))
    if not known:
        return JobRun(status="no input", missing=list(hours or []))
    silver = read_silver(spark, silver_path, hours_predicate(hours))
    assert_schema(silver, SILVER)
    # Counted where the plan runs, in the write of the first aggregate
    seen = Observation("stats_input")
    rows = silver.observe(seen, F.count(F.lit(1)).alias("silver_rows"))
    a1 = staged(snapshot_per_line(rows), "snapshot-per-line")
    a4 = network_per_snapshot(a1)
    out = {
        "total_onibus_por_linha": total_per_line(a1).withColumn("hora_id_ref", F.substring("hora_ref", 1, 2)),
        "total_onibus_geral": total_network(a4).withColumn("hora_id_ref", F.substring("hora_ref", 1, 2)),
        "media_onibus_por_linha": hourly_mean_per_line(a1),
        "media_onibus_geral": hourly_mean_network(a4),
    }
    run = _publish(spark, gold_root, "stats", out, hours, upsert=upsert,
                   # The network tables group by their keys, and an upsert checks its own stage
                   check=() if upsert else ("total_onibus_por_linha", "media_onibus_por_linha"))
    run.observation, run.rows_in = seen, observed(seen, "silver_rows")
    run.missing = sorted(set(hours or []) - set(known))
    return run


def _publish(spark: SparkSession, root: str, job: str, out: dict[str, DataFrame], hours: list[tuple[str, str]] | None, *,
             upsert: bool = False, check: tuple[str, ...] = ()) -> JobRun:
    """Check keys, write every table of a job as one version, then publish them all (K7)."""
    for name, df in out.items():
        assert_schema(df, TABLES[name].schema)
    run_concurrently({name: lambda name=name: assert_keys_valid(out[name], TABLES[name].keys) for name in check})
    version = new_run(job)
    watched = {name: counted(df, f"{job}_{name}") for name, df in out.items()}

    def writer(name):
        df = watched[name][0]
        if upsert:
            return lambda: prepare_upsert(spark, df, root, name, version)[1]

        def replace():
            write_hours(df, run_path(root, name, version), layout="hash", hours_hint=len(hours) if hours else None)
            return hours or []
        return replace

    covered = run_concurrently({name: writer(name) for name in out})
    commit(spark, root, job, version, covered)
    if hours:
        mark_done(spark, root, job, hours)
    return JobRun(out, rows_out={name: observed(w[1], "rows") for name, w in watched.items()})


def target_job(spark: SparkSession, gold_root: str, meta: DataFrame,
               hours: list[tuple[str, str]] | None = None) -> JobRun:
    """Hourly means vs targets; both lists of a processed hour are replaced
    whole, so a line that moved from one list to the other leaves no stale row
    (G6), and an hour with no qualifying line ends up empty (G9).

    Doubled or NULL keys of the target table fail the job before it writes, and so
    do those of the lists (C1/C2); the four tables are published together (K7).
    """
    known = known_hours(spark, gold_root, "media_onibus_por_linha", hours_predicate(hours))
    if not known:
        return JobRun(status="no input", missing=list(hours or []))
    assert_schema(meta, META)
    # one row per hour of day and line: small, and read again by the check
    target = staged(meta.select(*META.names), "targets")
    assert_keys_valid(target, TABLES["meta_onibus_por_linha"].keys)
    avg = read_gold(spark, gold_root, "media_onibus_por_linha", hours_predicate(hours))
    seen = Observation("targets_input")
    means = avg.observe(seen, F.count(F.lit(1)).alias("mean_rows"))
    # the asked hours drive the check: an hour without means gives every target line with mean 0
    asked = spark.createDataFrame(hours if hours is not None else known, "data_ref string, hora_id_ref string")
    checked = staged(target_check(target, means, asked), "targets-checked")
    processed = hours if hours is not None else known
    run = _publish(spark, gold_root, "targets", target_outputs(checked), processed,
                   check=("linhas_atingida_meta", "linhas_abaixo_meta"))  # the counts group by their keys
    run.observation, run.rows_in = seen, observed(seen, "mean_rows")
    run.missing = sorted(set(hours or []) - set(known))
    return run
