"""Command line of the applications, for spark-submit.

    spark-submit --py-files rowmill.zip rowmill/apps/jobs.py bus-trips --input RAW --output DIR
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rowmill import schemas
from rowmill.apps import bus_trips, city, city_streams, siblings, word_count
from rowmill.operators.quality import run_dataflows
from rowmill.session import build_session, session_settings
from rowmill.sinks.topics import kafka_sink_options
from rowmill.sources import files
from rowmill.sources.streams import kafka_stream
from rowmill.streaming import run


def run_bus_trips(spark: SparkSession, args) -> None:
    raw = files.read_delimited(spark, args.input, schemas.BUS_TRIPS_RAW)
    bus_trips.save_trips(bus_trips.clean_trips(raw), args.table, f"{args.output}/intermediate")
    bus_trips.two_way_lines(raw).write.mode("overwrite").parquet(f"{args.output}/lines")
    ratios = bus_trips.daily_ratios(spark.table(args.table))
    bus_trips.save_ratios(ratios, f"{args.output}/stats")


def run_traffic_history(spark: SparkSession, args) -> None:
    raw = files.read_delimited(spark, args.input, schemas.TRAFFIC_HISTORY_RAW, sep=";")
    city.save_traffic_history(city.traffic_history(raw), args.output)


def run_traffic_maxima(spark: SparkSession, args) -> None:
    city.save_hourly_maxima(spark.read.parquet(args.input), args.output)


def _publish(spark: SparkSession, args, added: bool, ddl: str) -> None:
    """Give running streams the registry's new version, if rows were added."""
    if args.snapshots and added:
        run.publish_snapshot(spark.read.schema(ddl).parquet(args.output), args.snapshots)


def run_locations(spark: SparkSession, args) -> None:
    added, rejected = city.register_locations(spark, args.input, args.version_pattern, args.output)
    _publish(spark, args, added, schemas.TRAFFIC_LOCATIONS)
    rejected.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}-rejected")


def run_parkings(spark: SparkSession, args) -> None:
    replies = files.read_json_documents(spark, args.input, schemas.PARKING_REPLY)
    details = files.read_json_documents(spark, args.details, schemas.PARKING_DETAIL_REPLY)
    added = city.register_parkings(city.parking_sites(replies, details), args.output)
    _publish(spark, args, added, schemas.PARKING_REGISTRY)


def run_points(spark: SparkSession, args) -> None:
    replies = files.read_json_documents(spark, args.input, schemas.POI_REPLY)
    _, rejected = city.register_points(city.points_of_interest(replies, args.source), args.output)
    rejected.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}-rejected")


def run_siblings(spark: SparkSession, args) -> None:
    people = files.read_delimited(spark, args.input, args.schema)
    if args.department is not None:
        people = people.where(F.col("department_id") == args.department)
    siblings.sibling_title_pairs(people).write.mode("overwrite").parquet(args.output)


def run_word_count(spark: SparkSession, args) -> None:
    word_count.save_counts(word_count.count_words(files.read_lines(spark, args.input)), args.output)


def run_metadata(spark: SparkSession, args) -> None:
    with open(args.metadata, encoding="utf-8") as text:
        dataflows = json.load(text)["dataflows"]
    options = {"kafka.bootstrap.servers": args.servers} if args.servers else None
    failed = run_dataflows(spark, dataflows, options)
    if failed:
        raise ExceptionGroup(f"failed: {', '.join(failed)}", list(failed.values()))


def run_stream(spark: SparkSession, args) -> None:
    topics = [kafka_stream(spark, args.servers, topic, args.per_trigger) for topic in args.topics]
    sink = kafka_sink_options(args.servers, args.out_topic)
    with session_settings(spark, **run.stateful_settings(spark, args.state_partitions)):
        query = _start_stage(spark, args, topics, sink)
    run.finish(query)


def _start_stage(spark: SparkSession, args, topics: list, sink: dict[str, str]):
    if args.stage == "fusion":
        points = spark.read.parquet(args.registry)
        return city_streams.start_fusion(
            points, topics, sink, args.checkpoint, args.window, args.lateness, args.silent_batches
        )
    if args.stage == "bikes":
        return city_streams.start(city_streams.bikes_stage(topics[0]), args.stage, sink, args.checkpoint)
    if args.stage == "parking":
        enrich, ddl = city_streams.parking_stage, schemas.PARKING_REGISTRY
    else:
        hourly, ddl = spark.read.parquet(args.maxima), schemas.TRAFFIC_LOCATIONS
        enrich = lambda messages, locations: city_streams.traffic_stage(messages, locations, hourly)
    if args.refresh:
        return city_streams.start_refreshed(topics[0], args.stage, enrich, args.registry, ddl, sink, args.checkpoint)
    rows = enrich(topics[0], spark.read.schema(ddl).parquet(args.registry))
    return city_streams.start(rows, args.stage, sink, args.checkpoint)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rowmill")
    commands = top.add_subparsers(dest="command", required=True)

    def batch(name: str, action, **extra):
        command = commands.add_parser(name)
        command.add_argument("--input", required=True)
        command.add_argument("--output", required=True)
        for option, settings in extra.items():
            command.add_argument(f"--{option.replace('_', '-')}", **settings)
        command.set_defaults(action=action)

    batch("bus-trips", run_bus_trips, table={"default": "intermediate"})
    batch("traffic-history", run_traffic_history)
    batch("traffic-maxima", run_traffic_maxima)
    snapshots = {"help": "folder of registry versions for streams run with --refresh"}
    batch("locations", run_locations, version_pattern={"default": r"-(\d+)-"}, snapshots=snapshots)
    batch("parkings", run_parkings, details={"required": True}, snapshots=snapshots)
    batch("points", run_points, source={"required": True})
    batch("siblings", run_siblings, department={"type": int}, schema={"default": schemas.EMPLOYEE_RECORDS})
    batch("word-count", run_word_count)

    metadata = commands.add_parser("dataflow")
    metadata.add_argument("--metadata", required=True)
    metadata.add_argument("--servers")
    metadata.set_defaults(action=run_metadata)

    stream = commands.add_parser("stream")
    stream.add_argument("stage", choices=sorted(city_streams.TRIGGERS))
    stream.add_argument("--servers", required=True)
    stream.add_argument("--topics", nargs="+", required=True)
    stream.add_argument("--out-topic", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--registry", help="locations, parking registry or points of interest")
    stream.add_argument("--maxima", help="output of traffic-maxima")
    stream.add_argument("--state-partitions", type=int, required=True, help="kept in the checkpoint for the life of the query")
    stream.add_argument("--per-trigger", type=int, help="most messages of a topic in one batch")
    stream.add_argument("--refresh", action="store_true", help="parking, traffic: the registry is a folder of versions, read anew by each batch")
    stream.add_argument("--window", help="fusion: means of windows such as '1 hour' by the messages' time, not since the start")
    stream.add_argument("--lateness", default="10 minutes", help="fusion: how long a window waits for late messages")
    stream.add_argument("--silent-batches", type=int, help="fusion: batches after which a silent place counts no more")
    stream.set_defaults(action=run_stream)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.action(spark or build_session(f"rowmill-{args.command}"), args)


if __name__ == "__main__":
    main()
