"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Each query is executed fully
through Spark's ``noop`` sink (no driver collection), after one warm-up pass of
the whole set so JVM/codegen start-up is not charged to the first query.  The
stored tables that the panels read are written before the timed runs; what that
took is reported beside them (``stored_gold_sec``) and not in the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlake.plans import registry  # noqa: E402
from fleetlake.session import local_test_session  # noqa: E402

HEADLINE = [
    "flatten_positions",          # bronze JSON -> silver (write + read landing)
    "snapshot_total_per_line",    # indicator 2
    "hourly_mean_per_line",       # indicator 1
    "snapshot_total_network",
    "hourly_mean_network",
    "target_check",
    "lines_reached",              # indicator 3
    "lines_below",                # indicator 4
    "lines_below_total",
    "upsert_media_onibus_por_linha",
    "gold_roundtrip",             # statistics job: 4 tables written + read back
    "panel_line_last25",
    "panel_below_top20",
    "panel_mean_line_last25",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_test_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    qs = registry.queries()
    names = [n for n in HEADLINE if n in qs]
    # warm-up on the smallest scale (start-up, class loading, codegen caches)
    warm = "/root/testdata/sf0.001"
    for n in names:
        qs[n](spark, warm).write.format("noop").mode("overwrite").save()
    # panels serve stored tables: the jobs that write them are timed on their own
    t0 = time.perf_counter()
    registry.stored_gold(spark, sf_dir)
    stored = round(time.perf_counter() - t0, 3)
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                      "cpus": cpus, "stored_gold_sec": stored}))
    spark.stop()


if __name__ == "__main__":
    main()
