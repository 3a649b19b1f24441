"""V1-V3: incremental statistics by recomputing the hours new files touch.

The original re-ran the batch job every few minutes for the current hour and
once more after the hour closed.  Here a file-source stream over the silver
table notices new files; each micro-batch (``foreachBatch``) collects the few
(date, hour) keys it touched and re-runs the statistics job for exactly those
hours, reading *all* of their rows – so provisional numbers are replaced as
data arrives and late files are counted.  A retried epoch recomputes the same
hours (idempotent overwrite), so the sink is effectively exactly-once.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import hour_id
from fleetlake.operators.silver import document_date
from fleetlake.plans.jobs import silver_job, stats_job, target_job
from fleetlake.schemas import HOUR_PARTITIONS, SILVER
from fleetlake.sinks.lake import table_exists
from fleetlake.sinks.ledger import HourLedger
from fleetlake.sinks.versions import compact, known_hours
from fleetlake.sources.bronze import BRONZE_WITH_PARTITIONS
from fleetlake.sources.lake import with_hour_column


def start_recompute(spark: SparkSession, silver_path: str, gold_root: str, checkpoint: str, *,
                    max_files_per_trigger: int | None = None, available_now: bool = True,
                    processing_time: str | None = None):
    reader = spark.readStream.schema(with_hour_column(SILVER))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(silver_path)

    def recompute(batch: DataFrame, epoch_id: int) -> None:
        # the touched hours of one micro-batch: a handful of keys
        hours = [(r[0], r[1]) for r in batch.select(*HOUR_PARTITIONS).distinct().collect()]
        if hours:
            stats_job(batch.sparkSession, silver_path, gold_root, hours)

    w = stream.select(*HOUR_PARTITIONS).writeStream.foreachBatch(recompute).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "3 minutes")
    return w.start()


def closed_hours(spark: SparkSession, gold_root: str, newest_recv: str, lateness_hours: int,
                 horizon_hours: int | None = None, earliest: str | None = None) -> list[tuple[str, str]]:
    """Event hours that are final and not yet target-checked, for runs without an hour ledger (V2/V3).

    An event hour ``h`` is closed once a document received in hour
    ``h + 1 + lateness`` or later has landed; ``newest_recv`` (``yyyyMMddHH``)
    is the newest reception hour seen.  Candidates are all hours with means up to the
    limit that no completion marker names, however old: a gap in the input never hides
    an hour.  A caller that knows its backlog may bound the look-back by
    ``horizon_hours`` before the limit (``earliest``, ``yyyyMMddHH``, moves that bound
    further back).  Hours come from the manifest or a folder listing, not from data
    files.  A marker stays for good: an hour touched after it is found by the ledger
    (``sinks/ledger``), not here.
    """
    limit = datetime.strptime(newest_recv, "%Y%m%d%H") - timedelta(hours=1 + lateness_hours)
    first = datetime(1970, 1, 1) if horizon_hours is None else limit - timedelta(hours=horizon_hours)
    if earliest:
        first = min(first, datetime.strptime(earliest, "%Y%m%d%H"))
    lo, hi = first.strftime("%Y%m%d%H"), limit.strftime("%Y%m%d%H")
    todo = known_hours(spark, gold_root, "media_onibus_por_linha", F.concat("data_ref", "hora_id_ref").between(lo, hi))
    runs = f"{gold_root.rstrip('/')}/_job_runs"
    if not todo or not table_exists(spark, runs):
        return todo
    day_span = F.col("data_ref").between(first.strftime("%Y%m%d"), limit.strftime("%Y%m%d"))
    done = spark.read.parquet(runs).where((F.col("job") == "targets") & day_span).select("data_ref", "hora_id_ref").distinct()
    return sorted(set(todo) - {(r[0], r[1]) for r in done.collect()})


def process_pending(spark: SparkSession, bronze_root: str, lake_root: str, meta: DataFrame, *, lateness_hours: int = 1,
                    multi_line: bool = False) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Rebuild the ledger's dirty hours, then check the hours that are due; returns both lists.

    A dirty hour's silver is read from exactly the reception hours that the ledger
    names for it, so a document of any lateness counts, and the hour is due for a
    check again afterwards.  Every step replaces whole hours and records them last, so
    a run that stopped half-way is simply done again.
    """
    lake, ledger = lake_root.rstrip("/"), HourLedger(spark, lake_root)
    dirty = ledger.dirty()
    if dirty:
        hours = sorted(dirty)
        receptions = sorted({r for s in dirty.values() for r in s.receptions})
        silver_job(spark, bronze_root, f"{lake}/silver", hours, receptions=receptions, multi_line=multi_line)
        stats_job(spark, f"{lake}/silver", f"{lake}/gold", hours)
        ledger.record_built({hour: s.seen for hour, s in dirty.items()})
    due = ledger.due(lateness_hours)
    if due:
        target_job(spark, f"{lake}/gold", meta, sorted(due))
        ledger.record_checked(due)
    return sorted(dirty), sorted(due)


def start_pipeline(spark: SparkSession, bronze_root: str, lake_root: str, meta: DataFrame, checkpoint: str, *,
                   lateness_hours: int = 1, max_files_per_trigger: int | None = None, available_now: bool = True,
                   processing_time: str | None = None, multi_line: bool = False, compact_every: int = 480):
    """V1-V3 as one stream over the bronze landing.

    Per micro-batch: its documents' event and reception hours go into the hour
    ledger; then the dirty hours are rebuilt in silver and in the statistics tables,
    and every closed hour whose last rebuild was not checked is compared with the
    targets.  A replayed epoch records the same hours and converges to the same
    tables.  Every ``compact_every`` epochs ledger and manifests become one file each.
    """
    reader = spark.readStream.schema(BRONZE_WITH_PARTITIONS).option("multiLine", str(multi_line).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = reader.json(bronze_root).select(document_date().alias("data_ref"), hour_id("hr").alias("hora_id_ref"), "recv_date", "recv_hour")

    def run(batch: DataFrame, epoch_id: int) -> None:
        s, lake = batch.sparkSession, lake_root.rstrip("/")
        ledger = HourLedger(s, lake)
        ledger.record_seen(batch)
        process_pending(s, bronze_root, lake, meta, lateness_hours=lateness_hours, multi_line=multi_line)
        if epoch_id and epoch_id % compact_every == 0:
            ledger.compact()
            for root in (lake, f"{lake}/gold"):
                compact(s, root)

    w = docs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "3 minutes")
    return w.start()
