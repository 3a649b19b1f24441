"""K7: versioned hour folders, published for all tables of a job by one manifest file.

A job writes each of its tables below ``<root>/<table>/run=<run>/`` and then appends
one file to ``<root>/_manifest`` that names the run for every (table, hour) it
covered.  Readers take an hour from the newest run that the manifest names, so a job
that is killed between two writes leaves them the old version of all its tables, and
they never see one table new and another old.  An hour that ended up without rows is
named too (``filled`` false), which empties it (G9) without touching any file.

Tables written as plain hour folders (``<root>/<table>/data_ref=../hora_id_ref=..``)
stay readable: the first commit of a table adopts the plain hours it finds.

Folders that no reader needs are left in place until ``vacuum``.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from fleetlake.schemas import HOUR_PARTITIONS
from fleetlake.sinks.log import Log, delete, folders, modified_ms

#: run name of hours that lie in plain folders
PLAIN = ""
MANIFEST = StructType([
    StructField("seq", LongType()), StructField("run", StringType()), StructField("job", StringType()),
    StructField("table", StringType()), StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
    StructField("filled", BooleanType()), StructField("committed_ms", LongType())])
_HOUR = re.compile(r"/data_ref=([^/]*)/hora_id_ref=([^/]*)/?$")


def manifest(spark: SparkSession, root: str) -> Log:
    return Log(spark, f"{root.rstrip('/')}/_manifest", MANIFEST)


def new_run(job: str) -> str:
    return f"{job}-{uuid.uuid4().hex[:16]}"


def run_path(root: str, table: str, run: str) -> str:
    base = f"{root.rstrip('/')}/{table}"
    return f"{base}/run={run}" if run else base


def hour_folders(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Hours that have a folder below ``path`` (a listing; no file is opened)."""
    return sorted(_HOUR.search(p).groups() for p in folders(spark, f"{path.rstrip('/')}/data_ref=*/hora_id_ref=*"))


def newest(rows: DataFrame) -> DataFrame:
    """Per table and hour the row of the last commit."""
    rest = [c for c in MANIFEST.names if c not in ("table", *HOUR_PARTITIONS)]
    return (rows.groupBy("table", *HOUR_PARTITIONS)
            .agg(F.max_by(F.struct(*rest), F.struct("seq", "run")).alias("last"))
            .select("table", *HOUR_PARTITIONS, *[F.col(f"last.{c}").alias(c) for c in rest]))


def commit(spark: SparkSession, root: str, job: str, run: str, covered: dict[str, list[tuple[str, str]]]) -> None:
    """Publish ``run`` for all ``covered`` hours of all its tables at once.

    Hours of a table that the run wrote no folder for are published as empty."""
    log = manifest(spark, root)
    known = {r["table"]: r["seq"] for r in log.read().groupBy("table").agg(F.max("seq").alias("seq")).collect()}
    seq, now = max([time.time_ns(), *(s + 1 for s in known.values())]), time.time_ns() // 1_000_000
    rows = []
    for table, hours in covered.items():
        if table not in known:
            rows += [(0, PLAIN, "adopted", table, d, h, True, now) for d, h in hour_folders(spark, run_path(root, table, PLAIN))]
        filled = set(hour_folders(spark, run_path(root, table, run)))
        rows += [(seq, run, job, table, d, h, (d, h) in filled, now) for d, h in sorted(filled | set(hours))]
    if rows:
        log.append(spark.createDataFrame(rows, MANIFEST))


def _current(spark: SparkSession, root: str, table: str, hours: Column | None) -> DataFrame:
    rows = manifest(spark, root).read().where(F.col("table") == table)
    return newest(rows if hours is None else rows.where(hours))


def is_versioned(spark: SparkSession, root: str, table: str) -> bool:
    return not manifest(spark, root).read().where(F.col("table") == table).isEmpty()


def published(spark: SparkSession, root: str, table: str, hours: Column | None = None) -> list[Row] | None:
    """Current manifest rows of a table's hours, in order; None for a table that was never committed."""
    found = _current(spark, root, table, hours).orderBy(*HOUR_PARTITIONS).collect()
    return found if found or is_versioned(spark, root, table) else None


def known_hours(spark: SparkSession, root: str, table: str, hours: Column | None = None) -> list[tuple[str, str]]:
    """Hours of a table that exist, empty ones included: the input check of the jobs."""
    rows = published(spark, root, table, hours)
    if rows is not None:
        return [(r["data_ref"], r["hora_id_ref"]) for r in rows]
    found = hour_folders(spark, run_path(root, table, PLAIN))
    if hours is None or not found:
        return found
    frame = spark.createDataFrame(found, "data_ref string, hora_id_ref string")
    return sorted((r[0], r[1]) for r in frame.where(hours).collect())


def newest_hours(spark: SparkSession, root: str, table: str, n: int, hours: Column | None = None) -> list[tuple[str, str]]:
    """The last ``n`` hours that hold rows, newest first, from the manifest (or the folder list) alone."""
    found = (_current(spark, root, table, hours).where("filled")
             .orderBy(F.desc("data_ref"), F.desc("hora_id_ref")).limit(n).collect())
    if found or is_versioned(spark, root, table):
        return [(r["data_ref"], r["hora_id_ref"]) for r in found]
    return known_hours(spark, root, table, hours)[::-1][:n]


def read_published(spark: SparkSession, root: str, table: str, schema: StructType, hours: Column | None = None) -> DataFrame | None:
    """The published rows of the asked hours; None where the table was never committed.

    Only the hours' own folders are listed and opened (one path for each hour)."""
    rows = published(spark, root, table, hours)
    if rows is None:
        return None
    base, paths = run_path(root, table, PLAIN), {False: [], True: []}
    for r in rows:
        if r["filled"]:
            paths[r["run"] == PLAIN].append(f"{run_path(root, table, r['run'])}/data_ref={r['data_ref']}/hora_id_ref={r['hora_id_ref']}")
    out = None
    for some in paths.values():  # plain folders have one level less, so they are a scan of their own
        if some:
            df = spark.read.schema(schema).option("basePath", base).parquet(*some).select(*schema.names)
            out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out


def compact(spark: SparkSession, root: str) -> int:
    """One manifest file with the last row of each table and hour."""
    return manifest(spark, root).compact(newest)


def vacuum(spark: SparkSession, root: str, table: str, older_than_s: int = 86_400) -> list[str]:
    """Delete hour folders of runs that are superseded or were never committed.

    Folders younger than ``older_than_s`` stay: a run may be at work in them, or a
    reader may have resolved them just before the next commit."""
    rows = published(spark, root, table)
    if rows is None:
        return []
    keep = {(r["run"], r["data_ref"], r["hora_id_ref"]) for r in rows if r["filled"]}
    limit, gone = time.time() * 1000 - older_than_s * 1000, []
    for path in folders(spark, f"{run_path(root, table, PLAIN)}/run=*/data_ref=*/hora_id_ref=*"):
        run = re.search(r"/run=([^/]*)/", path)[1]
        if (run, *_HOUR.search(path).groups()) not in keep and modified_ms(spark, path) < limit:
            delete(spark, path)
            gone.append(path)
    return gone
