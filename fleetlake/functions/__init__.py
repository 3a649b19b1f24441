"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from fleetlake.functions.timeutil import (HourSpec, capture_time_local, date_plus_hours, display_text,
                                          hour_id, hour_range_predicate, ref_timestamp, shifted,
                                          time_range_predicate, ts_literal)

__all__ = ["HourSpec", "capture_time_local", "date_plus_hours", "display_text", "hour_id",
           "hour_range_predicate", "ref_timestamp", "shifted", "time_range_predicate", "ts_literal"]
