"""Shuffle volume and time per job description, from a Spark event log.

usage:
    python tools/shuffle_report.py <event-log dir> [key ...]

Runs the given registered queries (default: the bench headline set) at
$SF_DIR (default sf0.1) with the event log written to <event-log dir> (a fresh
scratch folder), then prints shuffle bytes/records and wall time per query.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(log_dir: str):
    for f in sorted(glob.glob(f"{log_dir}/*/events*") + glob.glob(f"{log_dir}/events*")):
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            for line in stream:
                yield json.loads(line)


def shuffle_by_job(log_dir: str) -> dict:
    stage_job, out = {}, collections.defaultdict(lambda: [0, 0])
    for e in read_events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description", "")
            for s in e["Stage IDs"]:
                stage_job[s] = desc
        elif e["Event"] == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
            acc = out[stage_job.get(e["Stage ID"], "")]
            acc[0] += m.get("Shuffle Bytes Written", 0)
            acc[1] += m.get("Shuffle Records Written", 0)
    return dict(out)


def main():
    log_dir = sys.argv[1]
    keys = sys.argv[2:]
    from bench import HEADLINE
    from fleetlake.plans import registry
    from fleetlake.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(master="local[8]", shuffle_partitions=8,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    times = {}
    for k in keys or HEADLINE:
        spark.sparkContext.setJobDescription(k)
        t0 = time.perf_counter()
        qs[k](spark, sf).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sh = shuffle_by_job(log_dir)
    for k, sec in times.items():
        b, r = sh.get(k, (0, 0))
        print(json.dumps({"query": k, "sec": sec, "shuffle_bytes": b, "shuffle_records": r}))


if __name__ == "__main__":
    main()
