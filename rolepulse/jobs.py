"""The three jobs a deployment runs, each from paths to paths.

    python -m rolepulse.jobs ingest RAW FLOWS CHECKPOINT [--follow] [--rolled]
    python -m rolepulse.jobs load FLOWS TABLES
    python -m rolepulse.jobs churn FLOWS OUT --as-of 2016-12-01
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from rolepulse.layouts import FLOW_FIELDS, LOST_DAY, RAW_FILE, RAW_ZONES, VALID_ZONES
from rolepulse.operators.tableops import write_version
from rolepulse.plans import activity as A
from rolepulse.plans import churn as C
from rolepulse.plans import training as T
from rolepulse.sinks.flowtables import load_flow_tables
from rolepulse.sources import flowfiles
from rolepulse.sources.formatlog import TASK_ACTION
from rolepulse.sources.manifest import manifest
from rolepulse.streaming import ingest


def load_job(spark: SparkSession, flows: str, tables: str, zones=VALID_ZONES, run: str | None = None) -> dict[str, str]:
    """Flow files of either layout to flow tables, all seven types.

    A load is named by ``run``, or else by the files it reads: repeated as it was, it only does what is
    not done yet.
    """
    files = manifest(spark, flows, zones)
    present = files.types()
    wanted = [t for t in FLOW_FIELDS if t in present]
    return load_flow_tables(lambda t: files.only(types=[t]).lines(), tables, wanted, zones, run or files.fingerprint())


def churn_job(
    spark: SparkSession, flows: str, out: str, as_of: str | dt.date, replay: bool = True, zones=VALID_ZONES,
    zone_name: str = "UTC", lost_day: int = LOST_DAY,
) -> dict[str, DataFrame]:
    """Flow files to role state, features, lost rate, class statistics and model weights below ``out``.

    State and features are written first; all later passes read those tables.
    """
    events, created = flowfiles.activity_inputs(spark, flows, as_of, zones)
    cohort = A.stored_cohort(created, as_of)
    roles = write_version(A.role_activity(events, as_of, replay, zone_name, cohort=cohort), f"{out}/role_state")
    top = C.global_max(roles, cohort.first_day(), zone_name)
    features = write_version(C.score(roles, top, lost_day), f"{out}/features")
    names = C.select_features(roles)
    return {
        "role_state": roles,
        "features": features,
        "lost_rate": write_version(C.lost_rate(features, cohort.roles), f"{out}/lost_rate"),
        "class_feature_stats": write_version(C.class_feature_stats(features, names), f"{out}/class_feature_stats"),
        "weights": write_version(T.weights_table(features, names, **T.train(features, names)), f"{out}/weights"),
    }


def main() -> None:
    parser = argparse.ArgumentParser(prog="rolepulse.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    p = jobs.add_parser("ingest", help="raw log files to routed flow files")
    p.add_argument("raw"), p.add_argument("flows"), p.add_argument("checkpoint")
    p.add_argument("--follow", action="store_true", help="keep running instead of stopping when caught up")
    p.add_argument("--file-name", default=RAW_FILE, help="name or glob of the raw files")
    p.add_argument("--zones", nargs="+", default=RAW_ZONES)
    p.add_argument("--rolled", action="store_true", help="files are complete when they appear: read each as a whole")
    p.add_argument("--idle", type=float, default=600.0, help="seconds after which a file's last line needs no line end")
    p.add_argument("--rejects", help="folder for lines that carry a marker and match no pattern or path")
    p.add_argument("--task-action", default=TASK_ACTION, help="regular expression of a task line's action")
    p = jobs.add_parser("load", help="flow files to numbered tables")
    p.add_argument("flows"), p.add_argument("tables"), p.add_argument("--zones", nargs="+", default=VALID_ZONES)
    p.add_argument("--run", help="name of the load; the same files under a new name are loaded again")
    p = jobs.add_parser("churn", help="flow files to churn statistics and weights")
    p.add_argument("flows"), p.add_argument("out")
    p.add_argument("--as-of", required=True), p.add_argument("--time-zone", default="UTC")
    p.add_argument("--zones", nargs="+", default=VALID_ZONES)
    p.add_argument("--event-time", action="store_true", help="event-time rules instead of the replay")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"rolepulse-{args.job}").getOrCreate()
    if args.job == "ingest":
        options = dict(task_action=args.task_action, file_name=args.file_name, zones=args.zones, growing=not args.rolled, idle=args.idle,
                       rejects=args.rejects)
        if args.follow:
            ingest.start_ingest(
                spark, args.raw, args.flows, args.checkpoint, once=False, on_batch=lambda n, counts: print(f"batch {n}: {counts}"), **options,
            ).awaitTermination()
        else:
            print(ingest.run_once(spark, args.raw, args.flows, args.checkpoint, **options))
    elif args.job == "load":
        load_job(spark, args.flows, args.tables, args.zones, args.run)
    else:
        result = churn_job(spark, args.flows, args.out, args.as_of, not args.event_time, args.zones, args.time_zone)
        for name in ("lost_rate", "class_feature_stats", "weights"):
            result[name].show(truncate=False)


if __name__ == "__main__":
    main()
