"""Bronze landing zone – nested JSON snapshot documents.

Layout: ``<root>/recv_date=yyyyMMdd/recv_hour=HH/*.json`` (reception time), one
document per line.  The schema is always declared: inference costs a full pass
over the input and fails on an empty hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetlake.schemas import BRONZE
from fleetlake.sinks.log import folders

BRONZE_WITH_PARTITIONS = StructType(BRONZE.fields + [StructField("recv_date", StringType()),
                                                     StructField("recv_hour", StringType())])
CORRUPT = "_corrupt_record"


def read_bronze(spark: SparkSession, root: str, hours: Column | None = None, *,
                multi_line: bool = False, keep_corrupt: bool = False,
                receptions: list[tuple[str, str]] | None = None) -> DataFrame:
    """Read landing documents; ``hours`` is a predicate on ``recv_date``/``recv_hour``.

    ``receptions`` names the reception hours outright: only their folders are
    listed and opened, however long the landing's history is; those without a
    folder are left out, and with none left the frame is empty.

    ``multi_line`` reads pretty-printed documents; ``keep_corrupt`` keeps
    unparsable lines in ``_corrupt_record`` (PERMISSIVE mode) instead of
    silently turning them into all-null rows.
    """
    schema = BRONZE_WITH_PARTITIONS
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    reader = (spark.read.schema(schema).option("mode", "PERMISSIVE")
              .option("multiLine", str(multi_line).lower()))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if receptions is None:
        df = reader.json(root)
    else:
        paths = landed(spark, root, receptions)
        df = reader.option("basePath", root).json(paths) if paths else spark.createDataFrame([], schema)
    return df.where(hours) if hours is not None else df


def landed(spark: SparkSession, root: str, receptions: list[tuple[str, str]]) -> list[str]:
    """Folders of the asked reception hours that exist (one listing for each day asked)."""
    there = set()
    for day in sorted({d for d, _ in receptions}):
        there |= {tuple(x.partition("=")[2] for x in p.rstrip("/").rsplit("/", 2)[1:]) for p in folders(spark, f"{root.rstrip('/')}/recv_date={day}/recv_hour=*")}
    return [f"{root.rstrip('/')}/recv_date={d}/recv_hour={h}" for d, h in sorted(set(receptions) & there)]


def bad_document(column: str = CORRUPT) -> Column:
    """True for a document that does not parse, or whose ``hr`` names no minute of a day."""
    return F.col(column).isNotNull() | ~F.coalesce(F.col("hr").rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$"), F.lit(False))


def write_bronze(docs: DataFrame, root: str, mode: str = "overwrite") -> None:
    """I2 landing write: documents partitioned by reception date and hour."""
    (docs.hint("rebalance", "recv_date", "recv_hour").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("recv_date", "recv_hour").json(root))


def reception_hour(recv_date: str, recv_hour: str) -> Column:
    return (F.col("recv_date") == recv_date) & (F.col("recv_hour") == recv_hour)
