"""Small append-only tables: the manifest and the hour ledger.

A log is a folder of Parquet files of one declared schema.  Every append is one
file, so it shows whole or not at all.  ``compact`` appends a snapshot of the rows
that still matter and then deletes the older files; readers of both the snapshot
and the old files come to the same result, so it may stop at any point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _filesystem(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on any file system that Spark reads."""
    fs, jpath = _filesystem(spark, pattern)
    found = fs.globStatus(jpath)
    return sorted(str(s.getPath().toString()) for s in found or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _filesystem(spark, path)
    fs.delete(jpath, True)


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, jpath = _filesystem(spark, path)
    return fs.getFileStatus(jpath).getModificationTime()


class Log:
    """Append-only table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def append(self, rows: DataFrame) -> None:
        """One file, whatever the plan of ``rows``: a log's rows are bounded by hours, not by data."""
        rows.select(*self.schema.names).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; an absent log is empty."""
        if not folders(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def files(self) -> list[str]:
        return folders(self.spark, f"{self.path}/*.parquet")

    def compact(self, current) -> int:
        """Replace all files by ``current(rows)``; returns the number of files removed."""
        old = self.files()
        if len(old) < 2:
            return 0
        rows = self.spark.read.schema(self.schema).parquet(*old)
        self.append(current(rows))
        for path in old:
            delete(self.spark, path)
        return len(old)
