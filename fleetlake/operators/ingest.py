"""Payload validation and routing of the ingestion flow, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_PAYLOAD = 3000  # parameter; the original threshold value is not published


def validate_payloads(payloads: DataFrame, min_length: int = MIN_PAYLOAD, body: str = "body") -> DataFrame:
    """Flag each payload OK when it is larger, in UTF-8 bytes, than the minimum."""
    size = F.octet_length(body).cast("bigint")
    return payloads.withColumn("payload_len", size).withColumn("payload_ok", size > F.lit(min_length))


def ok_payloads(flagged: DataFrame) -> DataFrame:
    """Payloads routed to the landing zone."""
    return flagged.where(F.col("payload_ok"))


def nok_payloads(flagged: DataFrame) -> DataFrame:
    """Payloads routed to quarantine (NULL bodies count as failed)."""
    return flagged.where(~F.coalesce(F.col("payload_ok"), F.lit(False)))


def landing_name(recv_ts: str = "recv_ts", payload_id: str = "payload_id"):
    """I2 file name ``yyyyMMdd_HH_<id>.json`` from reception time and id."""
    return F.concat(F.date_format(recv_ts, "yyyyMMdd_HH"), F.lit("_"), F.col(payload_id).cast("string"),
                    F.lit(".json"))


def file_sizes(spark, path: str) -> DataFrame:
    """I1 on raw files: size of every landed file without reading its content."""
    return (spark.read.format("binaryFile").load(path)
            .select(F.col("path"), F.col("length").alias("payload_len")))


#: how a raw document's path names it: reception time to the second, then an id
RAW_NAME = r"([0-9]{8})T([0-9]{2})[0-9]{4}_([^/.]+)"


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a drop zone, one per file: payload_id, recv_date, recv_hour, payload_len, body, source_file.

    The size is the file's own (``_metadata.file_size``).  Reception time and id are
    the ones in the path (``20240115T100700_<id>``, as file or folder); where it has
    none, the file's modification time in the session zone (for a file without
    bytes, the time of the run) and its name.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    full = files.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").alias("at"))
    # a scan skips files without bytes: their names come from the scan's own listing
    key = F.regexp_replace("file", "^([a-z0-9]+):/+", "$1:/")
    listed = spark.createDataFrame([(f,) for f in files.inputFiles()], "file string").withColumn("key", key)
    empty = listed.join(full.select(key.alias("key")), "key", "left_anti").select(
        F.lit("").alias("value"), "file", F.lit(0).cast("long").alias("size"), F.current_timestamp().alias("at"))
    files, where = full.unionByName(empty), F.col("file")
    named = where.rlike(RAW_NAME)

    def part(i):
        return F.regexp_extract(where, RAW_NAME, i)

    return files.select(
        F.when(named, part(3)).otherwise(F.regexp_extract(where, r"([^/]*?)(\.[A-Za-z0-9]+)?$", 1)).alias("payload_id"),
        F.when(named, part(1)).otherwise(F.date_format("at", "yyyyMMdd")).alias("recv_date"),
        F.when(named, part(2)).otherwise(F.date_format("at", "HH")).alias("recv_hour"),
        F.col("size").alias("payload_len"), F.col("value").alias("body"), where.alias("source_file"))


def flag_documents(documents: DataFrame, min_length: int = MIN_PAYLOAD) -> DataFrame:
    """I1 by file size: OK when the file is larger than the minimum."""
    return documents.withColumn("payload_ok", F.col("payload_len") > F.lit(min_length))


def document_name() -> Column:
    """I2/I3 name ``yyyyMMdd_HH_<id>`` of a routed document (characters that no path may hold become ``-``)."""
    return F.concat_ws("_", "recv_date", "recv_hour", F.regexp_replace("payload_id", r"[^A-Za-z0-9._-]", "-"))
