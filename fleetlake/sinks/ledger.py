"""The dirty-hour ledger.

Three kinds of rows, all with a version that only grows:

* ``seen``    – documents of an event hour landed in a reception hour;
* ``built``   – the event hour was rebuilt (silver and statistics) from everything
  seen up to that version;
* ``checked`` – the hour's rebuild of that version was compared with the targets.

An hour is *dirty* while something was seen after its last rebuild, and *due* when it
is closed and its last rebuild was never checked.  Both follow from the rows alone:
a run that stopped half-way leaves its hours dirty or due, and a document of any
lateness makes its hour dirty again, then due again, and names the reception hours
its rebuild has to read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fleetlake.sinks.log import Log

Hour = tuple[str, str]
LEDGER = StructType([
    StructField("kind", StringType()), StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
    StructField("recv_date", StringType()), StructField("recv_hour", StringType()), StructField("version", LongType())])


@dataclass
class HourState:
    """What the ledger knows of one event hour."""

    seen: int = 0
    built: int = 0
    checked: int = 0
    receptions: list[Hour] = field(default_factory=list)

    @property
    def dirty(self) -> bool:
        return self.seen > self.built


def _summary(rows: DataFrame) -> DataFrame:
    """One row per kind, hour and reception hour with its last version (also the compacted form)."""
    return (rows.groupBy("kind", "data_ref", "hora_id_ref", "recv_date", "recv_hour")
            .agg(F.max("version").alias("version")).select(*LEDGER.names))


class HourLedger:
    def __init__(self, spark: SparkSession, lake_root: str):
        self.spark = spark
        self.log = Log(spark, f"{lake_root.rstrip('/')}/_ledger", LEDGER)

    def _next(self) -> int:
        last = self.log.read().agg(F.max("version")).first()[0] or 0
        return max(time.time_ns(), last + 1)

    def record_seen(self, documents: DataFrame) -> int:
        """``documents`` has data_ref, hora_id_ref, recv_date, recv_hour; returns the version given to them.

        One row per event and reception hour is kept, combined before the shuffle."""
        version = self._next()
        pairs = documents.where(F.col("data_ref").isNotNull() & F.col("hora_id_ref").isNotNull()).groupBy(
            "data_ref", "hora_id_ref", "recv_date", "recv_hour").agg(F.count(F.lit(1)).alias("n"))
        self.log.append(pairs.withColumns({"kind": F.lit("seen"), "version": F.lit(version).cast("long")}))
        return version

    def _record(self, kind: str, versions: dict[Hour, int]) -> None:
        if versions:
            rows = [(kind, d, h, None, None, v) for (d, h), v in sorted(versions.items())]
            self.log.append(self.spark.createDataFrame(rows, LEDGER))

    def record_built(self, versions: dict[Hour, int]) -> None:
        self._record("built", versions)

    def record_checked(self, versions: dict[Hour, int]) -> None:
        self._record("checked", versions)

    def pending(self) -> dict[Hour, HourState]:
        """The hours that are dirty or whose last rebuild is unchecked; hours that need nothing stay in Spark."""
        per = _summary(self.log.read()).groupBy("data_ref", "hora_id_ref").agg(
            *[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("version"))), F.lit(0)).alias(k) for k in ("seen", "built", "checked")],
            F.collect_set(F.when(F.col("kind") == "seen", F.struct("recv_date", "recv_hour"))).alias("receptions"))
        open_ = per.where((F.col("seen") > F.col("built")) | (F.col("built") > F.col("checked")))
        return {(r["data_ref"], r["hora_id_ref"]): HourState(r["seen"], r["built"], r["checked"], sorted((x[0], x[1]) for x in r["receptions"]))
                for r in open_.collect()}

    def dirty(self) -> dict[Hour, HourState]:
        return {hour: s for hour, s in self.pending().items() if s.dirty}

    def due(self, lateness_hours: int = 1) -> dict[Hour, int]:
        """Closed hours whose last rebuild was never checked, with that rebuild's version.

        An hour ``h`` is closed once a document received in hour ``h + 1 + lateness`` or later was seen."""
        newest = self.log.read().where(F.col("kind") == "seen").agg(F.max(F.concat("recv_date", "recv_hour"))).first()[0]
        if newest is None:
            return {}
        limit = (datetime.strptime(newest, "%Y%m%d%H") - timedelta(hours=1 + lateness_hours)).strftime("%Y%m%d%H")
        return {hour: s.built for hour, s in self.pending().items() if not s.dirty and s.built > s.checked and "".join(hour) <= limit}

    def compact(self) -> int:
        """One file; superseded versions are dropped, the reception hours stay."""
        return self.log.compact(_summary)
