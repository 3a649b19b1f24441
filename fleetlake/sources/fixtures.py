"""Map the driver's generic test tables onto the pipeline's input tables.

The original pipeline ships no sample data; its inputs are rebuilt from the
driver tables (``events``, ``part``, ``pages``) by a fixed rule so that a DuckDB
query can rebuild the same rows independently:

* one ``events`` row is one vehicle row of a snapshot; the snapshot is the
  5-minute bucket of ``ts`` and the line is ``user_id % 5``;
* the target table comes from ``part``; payload sizes from ``pages.html``.

Every function is a lazy DataFrame transformation over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import capture_time_local, hour_id

# Fixed values of the test mapping (shared with the DuckDB twins in plans/oracle.py).
N_LINES = 5                 # line = user_id % 5
SNAPSHOT = "5 minutes"      # poll bucket
TARGET_LINES = 7            # target line = floor(p_partkey / 24) % 7
UTC_OFFSET_HOURS = 3        # capture text = local ts + 3 h, written with 'Z'
LAT0, LON0 = -23.5, -46.5   # latitude = -23.5 - (event_id % 1000) / 1000.0
LAT_MOD, LON_MOD = 1000, 997
DOC_VEHICLES = 512          # most vehicle rows per generated bronze document


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_labels(id_linha: str = "id_linha") -> list:
    """Direction and the three sign texts, all derived from the line id."""
    lid = F.col(id_linha)
    txt = lid.cast("string")
    return [(F.lit(1) + lid % 2).cast("bigint").alias("sentido_linha"),
            F.concat(txt, F.lit("-10")).alias("let_cod_linha"),
            F.concat(F.lit("DEST "), txt).alias("let_destino"),
            F.concat(F.lit("ORIG "), txt).alias("let_origem")]


def _vehicle_rows(events: DataFrame) -> DataFrame:
    """Per-vehicle columns before the line count is attached."""
    bucket = F.window("ts", SNAPSHOT).start
    ta = F.date_format(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(UTC_OFFSET_HOURS)),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'")
    eid = F.col("event_id")
    return events.select(
        F.date_format("ts", "yyyyMMdd").alias("data_ref"),
        F.date_format(bucket, "HH:mm").alias("hora_ref"),
        eid.alias("cod_onibus"),
        (F.col("user_id") % N_LINES).alias("id_linha"),
        ta.alias("ta"),
        (F.col("event_type") == "view").alias("acessivel"),
        # double arithmetic on purpose (same IEEE steps as the SQL twin)
        (F.lit(LAT0) - (eid % LAT_MOD) / F.lit(1000.0)).alias("latitude_pos"),
        (F.lit(LON0) - (eid % LON_MOD) / F.lit(1000.0)).alias("longitude_pos"),
        F.floor("value").alias("veiculos"),
    )


def _with_line_count(rows: DataFrame) -> DataFrame:
    """``qtde_onibus`` = max vehicle count of the line in its snapshot.

    Aggregate-then-join instead of a window: the aggregate is combined map-side,
    and the join of raw rows to one row per (snapshot, line) is split by AQE's
    skew handling or broadcast when its measured size allows – a window would
    sort a hot line's whole snapshot inside one task.
    """
    keys = ["data_ref", "hora_ref", "id_linha"]
    counts = rows.groupBy(*keys).agg(F.max("veiculos").alias("qtde_onibus"))
    return rows.join(counts, keys, "inner")


def silver_rows(events: DataFrame, exact_count: bool = True) -> DataFrame:
    """The 12 silver columns (plus ``hora_id_ref``) built from ``events``.

    ``exact_count=False`` leaves each row's own count in ``qtde_onibus``; every
    statistic starts with ``max`` per (snapshot, line), so the results are the
    same while the join is skipped.
    """
    rows = _vehicle_rows(events)
    rows = _with_line_count(rows) if exact_count else rows.withColumn("qtde_onibus", F.col("veiculos"))
    return rows.select(
        "data_ref", "hora_ref", "cod_onibus",
        *line_labels(),
        capture_time_local("ta").alias("timestamp_pos"),
        "latitude_pos", "longitude_pos", "id_linha",
        F.col("qtde_onibus").cast("bigint").alias("qtde_onibus"),
        hour_id("hora_ref").alias("hora_id_ref"),
    )


def load_silver(spark: SparkSession, sf_dir: str, exact_count: bool = True) -> DataFrame:
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return silver_rows(ev, exact_count=exact_count)


def bronze_documents(events: DataFrame, doc_vehicles: int = DOC_VEHICLES, recv_delay_minutes: int = 0,
                     late_minute: str | None = None, late_days: int = 0) -> DataFrame:
    """Nested snapshot documents ``(recv_date, recv_hour, hr, l[..vs[..]])``.

    Built by two bounded ``collect_list`` steps: vehicles per (document, line),
    then lines per document.  A document holds the vehicles of one snapshot
    whose ids share ``floor(id / doc_vehicles)``, so no group ever exceeds
    ``doc_vehicles`` rows however hot a snapshot or line is; several documents
    may carry the same ``hr``, which the flatten step handles like the API's
    repeated polls.  ``recv_delay_minutes`` lands each document that long after
    its poll, so polls late in an hour are received in the next hour (and polls
    just before midnight on the next day).  Polls of ``late_minute`` land another
    ``late_days`` later.
    """
    rows = _with_line_count(_vehicle_rows(events))
    rows = rows.select("*", *line_labels(),
                       F.floor(F.col("cod_onibus") / doc_vehicles).alias("doc"))
    vehicle = F.struct(F.col("cod_onibus").alias("p"), F.col("acessivel").alias("a"), F.col("ta").alias("ta"),
                       F.col("latitude_pos").alias("py"), F.col("longitude_pos").alias("px"))
    per_line = (rows.groupBy("data_ref", "hora_ref", "doc", "id_linha", "sentido_linha", "let_cod_linha",
                             "let_destino", "let_origem", "qtde_onibus")
                .agg(F.collect_list(vehicle).alias("vs")))
    line = F.struct(F.col("let_cod_linha").alias("c"), F.col("id_linha").alias("cl"),
                    F.col("sentido_linha").alias("sl"), F.col("let_destino").alias("lt0"),
                    F.col("let_origem").alias("lt1"), F.col("qtde_onibus").cast("bigint").alias("qv"),
                    F.col("vs"))
    docs = per_line.groupBy("data_ref", "hora_ref", "doc").agg(F.collect_list(line).alias("l"))
    poll = F.to_timestamp_ntz(F.concat_ws(" ", "data_ref", "hora_ref"), F.lit("yyyyMMdd HH:mm"))
    received = poll + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(recv_delay_minutes))
    if late_minute is not None:
        received = F.when(F.substring("hora_ref", 4, 2) == late_minute, received + F.make_dt_interval(F.lit(late_days))).otherwise(received)
    return docs.select(F.date_format(received, "yyyyMMdd").alias("recv_date"),
                       F.date_format(received, "HH").alias("recv_hour"),
                       F.col("hora_ref").alias("hr"), "l")


def load_bronze(spark: SparkSession, sf_dir: str, recv_delay_minutes: int = 0, late_minute: str | None = None, late_days: int = 0) -> DataFrame:
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return bronze_documents(ev, recv_delay_minutes=recv_delay_minutes, late_minute=late_minute, late_days=late_days)


# Stand-in raw payloads: what the flow receives is a document's text, or an error text.
RAW_MIN = 100               # the registered ingestion's minimum; a document has more bytes, the error text fewer
FAILED_MINUTE = "45"        # polls of this minute answered with an error text
DAMAGED_MINUTE = "50"       # documents of this minute were cut off on their way


def _document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_bronze(spark, sf_dir)
    return docs.select("recv_date", "recv_hour", "hr", F.to_json(F.struct("hr", "l")).alias("body"))


def write_raw_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A drop zone: one file per payload, whose folder carries reception time and id."""
    raw = _document_texts(spark, sf_dir)
    body = F.when(F.substring("hr", 4, 2) == FAILED_MINUTE, F.lit('{"Message": "unavailable"}')).otherwise(F.col("body"))
    stamp = F.concat("recv_date", F.lit("T"), "recv_hour", F.substring("hr", 4, 2), F.lit("00_"), F.sha1("body"))
    raw.select(body.alias("body"), stamp.alias("raw")).write.partitionBy("raw").text(path)


def write_damaged_bronze(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A landing zone, one document per line, some of them cut off in the middle."""
    raw = _document_texts(spark, sf_dir)
    cut = F.expr("substring(body, 1, cast(length(body) / 2 as int))")
    body = F.when(F.substring("hr", 4, 2) == DAMAGED_MINUTE, cut).otherwise(F.col("body"))
    (raw.select(body.alias("body"), "recv_date", "recv_hour").hint("rebalance", "recv_date", "recv_hour")
     .write.partitionBy("recv_date", "recv_hour").text(path))


def target_table(part: DataFrame) -> DataFrame:
    """``meta_onibus_por_linha`` from ``part``: one row per (hour of day, line)."""
    keyed = part.select(
        F.lpad((F.col("p_partkey") % 24).cast("string"), 2, "0").alias("hora_id_ref"),
        (F.floor(F.col("p_partkey") / 24) % TARGET_LINES).cast("bigint").alias("id_linha"),
        F.col("p_size"))
    meta = keyed.groupBy("hora_id_ref", "id_linha").agg(F.max("p_size").cast("bigint").alias("meta_qtde_onibus"))
    return meta.select("hora_id_ref", "id_linha", *line_labels(), "meta_qtde_onibus")


def load_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_table(_read(spark, sf_dir, "part").select("p_partkey", "p_size"))


def load_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API payloads as (payload_id, name, body) – here the ``pages`` table."""
    return _read(spark, sf_dir, "pages").select(F.col("page_id").alias("payload_id"),
                                                F.col("url").alias("name"), F.col("html").alias("body"))
