"""``python -m clickloom {session,page,area,ads} ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import os

from clickloom.params import TaskParams
from clickloom.plans import jobs
from clickloom.session import build_session
from clickloom.sinks.outputs import Sink, jdbc_options, jdbc_sink, parquet_sink
from clickloom.sources import ad_log, dimensions, tables
from clickloom.streaming.ad_stream import AdStream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("session", "page", "area"):
        command = commands.add_parser(name)
        command.add_argument("--task", required=True, help="task parameters as JSON")
        _add_sink(command)
        command.add_argument("--actions", default="user_visit_action")
        command.add_argument("--users", default="user_info")
        command.add_argument("--products", default="product_info")
        command.add_argument("--cities", help="city table; the built-in one if left out")
        command.add_argument("--sample-size", type=int, default=100)
    ads = commands.add_parser("ads")
    ads.add_argument("--root", required=True, help="shared folder for state and results")
    ads.add_argument("--files", help="folder of record files, in place of Kafka")
    ads.add_argument("--brokers")
    ads.add_argument("--topic")
    ads.add_argument("--threshold", type=int, default=100)
    ads.add_argument("--open-days", type=int, help="reject clicks of days older than this; "
                     "by default clicks of every day count")
    ads.add_argument("--max-per-batch", type=int, help="records (files) a batch takes at most")
    export = commands.add_parser("ads-export", help="write the ad tables as of the newest batch")
    export.add_argument("--root", required=True, help="the folder that the ad program runs on")
    _add_sink(export)
    return parser


def _add_sink(command: argparse.ArgumentParser) -> None:
    place = command.add_mutually_exclusive_group(required=True)
    place.add_argument("--out", help="folder for the result tables")
    place.add_argument("--jdbc-url", help="database for the result tables")
    command.add_argument("--jdbc-user")
    command.add_argument("--jdbc-driver")
    command.add_argument("--jdbc-password-variable",
                         help="environment variable that holds the password")


def _sink(args: argparse.Namespace, mode: str = "append") -> Sink:
    if args.out:
        return parquet_sink(args.out, mode)
    variable = args.jdbc_password_variable
    return jdbc_sink(jdbc_options(args.jdbc_url, args.jdbc_user,
                                  os.environ[variable] if variable else None,
                                  args.jdbc_driver), mode)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"clickloom-{args.command}")
    if args.command == "ads":
        lines = (ad_log.file_lines(spark, args.files, args.max_per_batch) if args.files
                 else ad_log.kafka_lines(spark, args.brokers, args.topic,
                                         max_per_batch=args.max_per_batch))
        jobs.ad_stream(lines, args.root, threshold=args.threshold,
                       open_days=args.open_days).awaitTermination()
        return
    if args.command == "ads-export":
        AdStream(spark, args.root).export(_sink(args, "overwrite"))
        return
    params = TaskParams.from_json(spark, args.task)
    actions = tables.read_actions(spark, args.actions, params.start_date, params.end_date)
    sink = _sink(args)
    if args.command == "session":
        jobs.session_analysis(actions, spark.table(args.users), params, sink,
                              sample_size=args.sample_size)
    elif args.command == "page":
        jobs.page_conversion(actions, params, sink)
    else:
        cities = spark.table(args.cities) if args.cities else dimensions.cities(spark)
        jobs.area_top(actions, cities, spark.table(args.products), sink)


if __name__ == "__main__":
    main()
