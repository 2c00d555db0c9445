"""``python -m ordermill JOB SOURCE TARGET`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import inspect
import json

from pyspark.sql import SparkSession

from ordermill.plans.eventlog import described, executed_plans, read_log, stage_report
from ordermill.plans.inspect import plan_facts
from ordermill.plans.jobs import JOBS, SKU_MONTH_REPORTS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordermill", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("source", help="CSV orders with a header line")
    parser.add_argument("target", help="folder for the result files")
    parser.add_argument("--single-file", action="store_true", help="write one file, from one task")
    parser.add_argument(
        "--rejects", metavar="FOLDER", help="lines not used, with the reason (the two CSV jobs)")
    parser.add_argument(
        "--reports", metavar="FOLDER", help="comparison and size reports (sku-month-std)")
    parser.add_argument(
        "--event-log", metavar="FOLDER",
        help="existing folder for Spark's event log; prints the executed plans and stages")
    args = parser.parse_args(argv)
    options = {"rejects": args.rejects, "reports_to": args.reports}
    options = {name: value for name, value in options.items() if value}
    known = inspect.signature(JOBS[args.job]).parameters
    for name in options:
        if name not in known:
            parser.error(f"{args.job} has no {name.split('_')[0]}")
    builder = SparkSession.builder.appName(f"ordermill {args.job}").config(
        "spark.ui.enabled", "false")
    if args.event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", args.event_log).config("spark.eventLog.compress", "false")
    spark = builder.getOrCreate()
    with described(spark, args.job) as name:
        counts = JOBS[args.job](spark, args.source, args.target, args.single_file, **options)
    print(json.dumps({"job": args.job, "rows": counts}))
    if args.reports:
        for report in SKU_MONTH_REPORTS:
            print(report)
            spark.read.parquet(f"{args.reports.rstrip('/')}/{report}").show(20, False)
    if args.event_log:
        log = f"{args.event_log.rstrip('/')}/*{spark.sparkContext.applicationId}*"
        events = read_log(spark, log)
        for plan in executed_plans(events, name):
            print(json.dumps(plan_facts(plan)))
            print(plan)
        stage_report(events, name).orderBy("stage").show(1000, False)


if __name__ == "__main__":
    main()
