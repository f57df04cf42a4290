"""Command line: `python -m eventlake <command>`."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import functions as F

from eventlake.config import Settings, get_spark
from eventlake.operators import layout, quality, serving
from eventlake.plans import daily
from eventlake.sources.streams import heartbeat_source, json_lines_source
from eventlake.sources.tables import TableStore, write_jdbc
from eventlake.streaming import jobs, sinks


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake")
    parser.add_argument("--database", default=Settings().database)
    parser.add_argument("--provider", default=Settings().provider)
    parser.add_argument("--lake", help="folder of the tables, where there is no metastore")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="run one streaming job")
    stream.add_argument("job", choices=jobs.JOBS)
    stream.add_argument("--path", help="folder of JSON lines to read instead of Kafka")
    stream.add_argument("--files", type=int, help="most files per partition and micro-batch")
    stream.add_argument("--trigger", help="'once', or an interval such as '30 seconds'")
    stream.add_argument("--distinct", help="leave out events sent again within a span such as '1 hour'")
    stream.add_argument("--heartbeat", metavar="GRACE", help="alert jobs: judge silent minutes so long after their end, such as '2 minutes'")

    yesterday = (date.today() - timedelta(days=1)).isoformat()
    for name in ("daily", "quality", "aggregate", "reviews", "searches"):
        command = commands.add_parser(name)
        command.add_argument("day", nargs="?", default=yesterday)
        if name == "daily":
            command.add_argument("--cohorts", action="store_true", help="retention as of the day too")
    cohorts = commands.add_parser("cohorts")
    cohorts.add_argument("day", nargs="?", default=date.today().isoformat())
    cohorts.add_argument("--rebuild", action="store_true")

    layouts = commands.add_parser("layouts", help="compare data layouts")
    layouts.add_argument("path")
    layouts.add_argument("rows", nargs="?", type=int, default=1_000_000)

    for command in (stream, cohorts):
        command.add_argument("--jdbc-url")
        command.add_argument("--jdbc-user", default="")
        command.add_argument("--jdbc-password", default="")
        command.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    return parser.parse_args()


def _jdbc_properties(args: argparse.Namespace) -> dict[str, str]:
    return {"user": args.jdbc_user, "password": args.jdbc_password, "driver": args.jdbc_driver}


def _compare_layouts(spark, store: TableStore, path: str, rows: int) -> None:
    load = layout.write_layouts(layout.synthetic_events(spark, rows), path)
    parameters = {
        "day_from": "2021-01-01", "day_to": "2021-01-02", "product": "1234",
        "month_from": "2021-01-01", "month_to": "2021-06-01",
    }
    timings = layout.time_layouts(spark, path, parameters, load_seconds=load)
    store.create("benchmark_results")
    store.append(timings, "benchmark_results")
    timings.show(20, truncate=False)
    days = tuple(F.lit(parameters[name]).cast("timestamp") for name in ("day_from", "day_to"))
    product = (F.lit(parameters["product"]),) * 2
    touched = layout.layout_files(spark, path, {"time_range": ("event_timestamp", *days), "product_lookup": ("product_id", *product)})
    store.create("benchmark_files")
    store.append(touched, "benchmark_files")
    touched.show(truncate=False)
    layout.layout_report(timings).show(truncate=False)


def main() -> None:
    args = _arguments()
    settings = Settings(database=args.database, provider=args.provider, lake_path=args.lake)
    spark = get_spark(f"eventlake-{args.command}")
    store = TableStore(spark, settings)
    if args.command == "stream":
        extra = ()
        if args.jdbc_url and args.job == jobs.ALERT_JOB:
            extra = (sinks.jdbc_sink(args.jdbc_url, "analytics_anomaly_alerts", _jdbc_properties(args)),)
        source = json_lines_source(args.path) if args.path else None
        late = jobs.LateRows()
        spark.streams.addListener(late)
        beat = {"heartbeat": heartbeat_source(), "grace": args.heartbeat} if args.heartbeat else {}
        query = jobs.start(spark, args.job, settings, source, args.trigger, extra, args.files, args.distinct, **beat)
        query.awaitTermination()
        print(f"rows left out as late: {late.counts.get(str(query.id), 0)}")
    elif args.command == "daily":
        daily.run_daily(spark, args.day, settings, with_cohorts=args.cohorts)
    elif args.command == "quality":
        checks = daily.run_quality(store, args.day)
        quality.quality_report(checks).show()
        checks.filter("status <> 'PASS'").show(truncate=False)
        quality.quality_gate(checks)
    elif args.command == "aggregate":
        daily.run_aggregation(store, args.day)
    elif args.command == "reviews":
        daily.run_reviews(store, args.day)
    elif args.command == "searches":
        daily.run_searches(store, args.day)
    elif args.command == "cohorts":
        found = daily.run_cohorts(store, args.day, args.rebuild)
        if args.jdbc_url:
            write_jdbc(found, args.jdbc_url, "analytics_cohort_retention", _jdbc_properties(args), "overwrite")
        serving.latest_cohorts(found).show(20)
    elif args.command == "layouts":
        _compare_layouts(spark, store, args.path, args.rows)


if __name__ == "__main__":
    main()
