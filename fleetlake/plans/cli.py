"""Job entry point for ``spark-submit``.

    python -m fleetlake.plans.cli silver  --hours-back 0 --bronze <landing> --lake <root>
    python -m fleetlake.plans.cli stats   --hours-back 1 --lake <root>
    python -m fleetlake.plans.cli targets --hours-back 1 --lake <root> --target <parquet path>

``--hours-back N`` selects the local hour "now minus N" (the original job
argument); ``--first/--last yyyyMMddHH`` selects a span for backfills instead.
The target table may come over JDBC (``--target-url``), and the hours that a job
committed may replace the stage tables of a database (``--publish-url``).
The schedule itself (every 3 minutes for the current hour, minute 2 for the
closing run, minute 5 for targets) belongs to the cluster's scheduler.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from fleetlake.functions.timeutil import LOCAL_ZONE, HourSpec, hours_between
from fleetlake.plans.jobs import hours_predicate, silver_job, stats_job, target_job
from fleetlake.schemas import META
from fleetlake.session import build_session
from fleetlake.sinks.jdbc import publish_stage
from fleetlake.sources.jdbc import read_target


def hour_list(args) -> list[tuple[str, str]]:
    if args.first:
        first = datetime.strptime(args.first, "%Y%m%d%H")
        last = datetime.strptime(args.last or args.first, "%Y%m%d%H")
        return hours_between(first, last)
    spec = HourSpec(hours_back=args.hours_back, zone=args.zone)
    return [(spec.data_ref, spec.hora_id_ref)]


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="fleetlake")
    p.add_argument("job", choices=["silver", "stats", "targets"])
    p.add_argument("--hours-back", type=int, default=0)
    p.add_argument("--first")
    p.add_argument("--last")
    p.add_argument("--zone", default=LOCAL_ZONE)
    p.add_argument("--bronze")
    p.add_argument("--lake", required=True)
    p.add_argument("--target", help="Parquet path of the target table")
    p.add_argument("--target-url", help="JDBC URL to read the target table from instead")
    p.add_argument("--target-table", default="meta_onibus_por_linha")
    p.add_argument("--publish-url", help="JDBC URL whose stage tables get the job's hours after its commit")
    p.add_argument("--jdbc-driver")
    p.add_argument("--upsert", action="store_true", help="statistics: merge by key instead of replacing the hours")
    p.add_argument("--quarantine", help="folder of documents that do not parse")
    p.add_argument("--lateness-hours", type=int, default=1)
    args = p.parse_args(argv)
    spark = build_session(app=f"fleetlake-{args.job}")
    hours = hour_list(args)
    lake = args.lake.rstrip("/")
    props = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
    if args.job == "silver":
        run = silver_job(spark, args.bronze, f"{lake}/silver", hours, args.lateness_hours, quarantine=args.quarantine)
    elif args.job == "stats":
        run = stats_job(spark, f"{lake}/silver", f"{lake}/gold", hours, upsert=args.upsert)
    else:
        meta = (read_target(spark, args.target_url, args.target_table, hours, props) if args.target_url
                else spark.read.schema(META).parquet(args.target))
        run = target_job(spark, f"{lake}/gold", meta, hours)
    if args.publish_url and args.job != "silver" and run.status == "done":
        publish_stage(spark, f"{lake}/gold", run.tables, hours_predicate(hours), args.publish_url, props)
    print(f"{args.job}: {run.status}, rows in {run.rows_in}, rows out {run.rows_out}"
          + (f", bad documents {run.bad_documents}" if run.bad_documents else "") + (f", hours without input {run.missing}" if run.missing else ""))


if __name__ == "__main__":
    main()
