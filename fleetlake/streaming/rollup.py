"""V7: hourly means as a pure streaming pipeline with an event-time watermark.

Two chained windowed aggregations: per poll minute and line ``max`` (A1), then
per hour ``ceil(avg)`` (A3) over the first aggregation's ``window_time``.  In
append mode an hour is emitted once the watermark passes its end, so only
closed hours appear, each exactly once; state older than the watermark is
dropped, keeping memory bounded by the open windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.timeutil import ref_timestamp
from fleetlake.operators.stats import LINE_COLUMNS


def hourly_means_stream(silver_stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    snap = (silver_stream
            .withColumn("snapshot_ts", ref_timestamp("data_ref", "hora_ref").cast("timestamp"))
            .withWatermark("snapshot_ts", delay))
    per_poll = (snap.groupBy(F.window("snapshot_ts", "1 minute").alias("poll"), *LINE_COLUMNS)
                .agg(F.max("qtde_onibus").alias("qtde_onibus")))
    hourly = (per_poll.groupBy(F.window(F.window_time("poll"), "1 hour").alias("hour"), *LINE_COLUMNS)
              .agg(F.ceil(F.avg("qtde_onibus")).alias("qtde_onibus")))
    start = F.col("hour.start").cast("timestamp_ntz")
    return hourly.select(F.date_format(start, "yyyyMMdd").alias("data_ref"),
                         F.date_format(start, "HH").alias("hora_id_ref"),
                         *LINE_COLUMNS, "qtde_onibus")


def start_hourly_means(spark, silver_stream: DataFrame, path: str, checkpoint: str, *, delay: str = "10 minutes",
                       state_partitions: int = 16, available_now: bool = True, processing_time: str | None = None):
    """Run ``hourly_means_stream`` into a Parquet sink (append: closed hours only).

    The state-store partition count is fixed by the query's first start and kept
    in its checkpoint.  The state here is one row per open window and line, so
    it is sized explicitly (``state_partitions``) instead of inheriting the
    session's shuffle width, which on a large cluster is sized for batch joins.
    """
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        w = (hourly_means_stream(silver_stream, delay).writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", checkpoint))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "3 minutes")
        return w.start(path)
    finally:
        spark.conf.set(key, previous)
