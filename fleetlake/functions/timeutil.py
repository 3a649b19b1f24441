"""Hour addressing and time expressions.

Conventions (fixed by the original tables):

* ``data_ref``    – ``yyyyMMdd`` text, the local date of the snapshot
* ``hora_ref``    – ``HH:mm`` text, the snapshot's reference time
* ``hora_id_ref`` – ``HH`` text, the hour of day (first two characters of ``hora_ref``)

All timestamps produced here are ``TIMESTAMP_NTZ`` (wall clock, no zone), so
results do not depend on the session zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Sao_Paulo"

# Text layouts of the original tables and dashboards.
DATE_LAYOUT = "yyyyMMdd"            # data_ref
REF_LAYOUT = "yyyyMMdd HH[:mm]"     # data_ref || ' ' || hora_ref, or || hora_id_ref alone
DISPLAY_LAYOUT = "dd/MM/yyyy HH:mm"  # dashboard text, 'DD/MM/YYYY HH24:MI'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_id(hora_ref="hora_ref") -> Column:
    """Hour of day ``HH`` from ``HH:mm`` (1-based substring)."""
    return F.substring(_c(hora_ref), 1, 2)


def ref_timestamp(data_ref="data_ref", hora="hora_ref", suffix: str | None = None) -> Column:
    """``data_ref || ' ' || hora [|| suffix]`` parsed as a wall-clock timestamp.

    Accepts ``HH`` and ``HH:mm`` alike (the dashboard passes both).
    """
    parts = [_c(data_ref), F.lit(" "), _c(hora)]
    if suffix:
        parts.append(F.lit(suffix))
    return F.to_timestamp_ntz(F.concat(*parts), F.lit(REF_LAYOUT))


def shifted(ts: Column, hours: int) -> Column:
    """fixed shift local -> UTC (``+ INTERVAL 'n HOURS'``)."""
    if not hours:
        return ts
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def display_text(ts: Column) -> Column:
    """F8: ``TO_CHAR(ts, 'DD/MM/YYYY HH24:MI')``."""
    return F.date_format(ts, DISPLAY_LAYOUT)


def date_plus_hours(data_ref="data_ref", hora_id_ref="hora_id_ref") -> Column:
    """``TO_DATE(data_ref) + (hora::int || ' hours')::interval``."""
    day = F.to_timestamp_ntz(_c(data_ref), F.lit(DATE_LAYOUT))
    return day + F.make_dt_interval(F.lit(0), _c(hora_id_ref).cast("int"))


def ts_literal(value: datetime | str) -> Column:
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(text).cast("timestamp_ntz")


def time_range_predicate(ts: Column, time_from, time_to, shift_hours: int = 0,
                         data_ref="data_ref") -> Column:
    """Closed range on the (shifted) reference time.

    A redundant, equivalent bound on ``data_ref`` is added so the predicate also
    prunes date partitions and row groups: the reference time's date *is*
    ``data_ref``, so the local date of each bound brackets it exactly.
    """
    lo = _as_dt(time_from) - timedelta(hours=shift_hours)
    hi = _as_dt(time_to) - timedelta(hours=shift_hours)
    pred = shifted(ts, shift_hours).between(ts_literal(time_from), ts_literal(time_to))
    return pred & _c(data_ref).between(F.lit(lo.strftime("%Y%m%d")), F.lit(hi.strftime("%Y%m%d")))


def _as_dt(v) -> datetime:
    return v if isinstance(v, datetime) else datetime.fromisoformat(str(v))


def capture_time_local(ta="ta", zone: str = LOCAL_ZONE) -> Column:
    """Capture-time text (UTC) -> local wall clock.

    ``Z``, ``+00:00`` and zone-less text are all read as UTC instants, whatever
    the session zone; malformed text gives NULL instead of failing the job.  The
    instant is then rendered in ``zone`` as ``TIMESTAMP_NTZ``.
    """
    text = F.trim(_c(ta))
    zoned = F.when(text.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    instant = F.try_to_timestamp(zoned)
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


@dataclass(frozen=True)
class HourSpec:
    """S6/S9: "now in zone minus N hours" -> the hour a job processes.

    ``now`` is injectable; ``None`` means the wall clock (production runs).
    """

    hours_back: int = 0
    now: datetime | None = None
    zone: str = LOCAL_ZONE

    @property
    def local(self) -> datetime:
        tz = ZoneInfo(self.zone)
        now = self.now.astimezone(tz) if (self.now and self.now.tzinfo) else (
            self.now.replace(tzinfo=tz) if self.now else datetime.now(tz))
        return now - timedelta(hours=self.hours_back)

    @property
    def data_ref(self) -> str:
        return self.local.strftime("%Y%m%d")

    @property
    def hora_id_ref(self) -> str:
        return self.local.strftime("%H")

    @property
    def path_suffix(self) -> str:
        return self.local.strftime("%Y/%m/%d/%H")

    def predicate(self) -> Column:
        return (F.col("data_ref") == self.data_ref) & (F.col("hora_id_ref") == self.hora_id_ref)


def hour_range_predicate(first: tuple[str, str], last: tuple[str, str]) -> Column:
    """Partition-only predicate for a closed span of (data_ref, hora_id_ref) hours.

    Written on the partition columns alone so the scan prunes directories.
    """
    key = F.concat(F.col("data_ref"), F.col("hora_id_ref"))
    return key.between(F.lit(first[0] + first[1]), F.lit(last[0] + last[1]))


def hours_between(start: datetime, end: datetime) -> list[tuple[str, str]]:
    """Driver-side list of (data_ref, hora_id_ref) from ``start`` to ``end`` (local)."""
    out, t = [], start.replace(minute=0, second=0, microsecond=0)
    while t <= end:
        out.append((t.strftime("%Y%m%d"), t.strftime("%H")))
        t += timedelta(hours=1)
    return out
