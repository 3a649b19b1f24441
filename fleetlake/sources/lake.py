"""Silver and gold Parquet tables partitioned by event hour.

Tables live at ``<root>/<table>/data_ref=yyyyMMdd/hora_id_ref=HH/``.  Readers
always pass the declared schema (partition values stay text) and take an
optional hour predicate that references only partition columns, so the scan
lists and opens only the selected hours (``PartitionFilters`` in the plan).
Omitting the predicate is the all-hours backfill read.

A table that a job has committed is read through its manifest (``sinks/versions``):
the predicate picks the hours there and the scan gets just their folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from fleetlake.schemas import SILVER, TABLES
from fleetlake.sinks.versions import read_published

HOUR_COLUMN = StructField("hora_id_ref", StringType())


def with_hour_column(schema: StructType) -> StructType:
    names = {f.name for f in schema.fields}
    return schema if "hora_id_ref" in names else StructType(schema.fields + [HOUR_COLUMN])


def split_path(path: str) -> tuple[str, str]:
    """(root, table) of a table's path."""
    root, _, table = path.rstrip("/").rpartition("/")
    return root, table


def _read_table(spark: SparkSession, root: str, table: str, schema: StructType, hours: Column | None) -> DataFrame:
    df = read_published(spark, root, table, schema, hours)
    if df is None:
        df = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{table}")
    return df if hours is None else df.where(hours)


def read_silver(spark: SparkSession, path: str, hours: Column | None = None) -> DataFrame:
    return _read_table(spark, *split_path(path), with_hour_column(SILVER), hours)


def read_gold(spark: SparkSession, root: str, table: str, hours: Column | None = None,
              *, keep_hour_column: bool = False) -> DataFrame:
    """One gold table, optionally restricted to an hour predicate."""
    t = TABLES[table]
    df = _read_table(spark, root, table, with_hour_column(t.schema), hours)
    return df if keep_hour_column or "hora_id_ref" in t.columns else df.select(*t.columns)
