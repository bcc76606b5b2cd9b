"""Command line of the applications.

    spark-submit run.py trade-windows --brokers broker:9092 --checkpoint s3a://bucket/chk/trades
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.avro import load_schema
from millrace.operators.skew import HOT_KEYS, frozen
from millrace.plans import apps
from millrace.resources import INVOICE_ITEM_SCHEMA
from millrace.schemas import USER
from millrace.session import app_session, engine_session, use_object_store
from millrace.sources.files import json_directory, kept_schema, socket_lines, source_schema, text_directory, with_drift
from millrace.sources.tables import BucketedTable, CassandraTable, FileTable, cassandra_settings
from millrace.sources.topics import Topics
from millrace.streaming.manifests import exists
from millrace.streaming.relayout import positions as reached
from millrace.streaming.runner import changelog_sink, console_sink, parquet_sink, snapshot_sink, start

# Output mode, and time between micro-batches if none is given; "" starts the next at once.
APPS = {
    "invoice-files": ("append", "1 minute"),
    "invoice-topic": ("append", "1 minute"),
    "notifications": ("append", "1 minute"),
    "publish-items": ("append", "1 minute"),
    "rewards": ("update", ""),
    "last-login": ("update", "1 minute"),
    "impression-clicks": ("append", "1 minute"),
    "word-count": ("complete", ""),
    "trade-windows": ("update", "1 minute"),
}


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="millrace", description="Run a streaming application.")
    options.add_argument("app", choices=APPS)
    options.add_argument("--checkpoint", required=True, help="folder of this query alone")
    options.add_argument("--brokers", help="Kafka bootstrap servers")
    options.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE",
                         help="further option of the Kafka connector; may be repeated")
    options.add_argument("--topic-folder", help="folder of file topics, instead of brokers")
    options.add_argument("--starting", default="earliest", help="offsets where no checkpoint exists")
    options.add_argument("--source", help="invoice-files: JSON folder; word-count: text folder")
    options.add_argument("--target", help="output folder; without it joins and totals go to the console")
    options.add_argument("--files-per-trigger", type=int)
    options.add_argument("--host", help="word-count: socket to read lines from")
    options.add_argument("--port", type=int, default=9999)
    options.add_argument("--keyspace", help="last-login: Cassandra keyspace")
    options.add_argument("--table", default="users", help="last-login: Cassandra table")
    options.add_argument("--users", help="last-login: Parquet user table, instead of Cassandra")
    options.add_argument("--changes", help="last-login: folder of changes to the Parquet user table")
    options.add_argument("--show", action="store_true", help="last-login: print each batch")
    options.add_argument("--hot-keys", help="impression-clicks: Parquet list of the ids to spread at the first "
                                            "start, instead of those found in the topics; the checkpoint keeps it")
    options.add_argument("--source-schema", help="invoice-files: file with the input's schema, as DDL or JSON; "
                                                 "without it all files are read once, at the first start, to find it")
    options.add_argument("--item-format", choices=("avro", "json"), default="avro",
                         help="publish-items, rewards: how line items are written (Avro needs spark-avro)")
    options.add_argument("--schema-file", help="Avro schema of line items, instead of the package's own")
    options.add_argument("--interval", help='time between micro-batches, such as "1 minute"')
    options.add_argument("--until-caught-up", action="store_true", help="end when the input is done")
    options.add_argument("--resume-from", metavar="CHECKPOINT", help="rewards, impression-clicks: begin a new --checkpoint with the "
                         "state of this stopped query, for the present --shuffle-partitions and the ids that are hot by now")
    options.add_argument("--keep-batches", type=int, help="rewards to a topic folder: batches that stay for streams; older ones "
                                                          "are merged, the last message of each card staying")
    options.add_argument("--buckets", type=int, help="last-login: keep the users in this many buckets in --changes, "
                                                     "beginning with those in --users, and rewrite those a batch touches")
    options.add_argument("--report-drift", choices=("count", "fail"),
                         help="invoice-files: count the lines that do not fit the schema, or fail at the first")
    options.add_argument("--name", help="query name")
    options.add_argument("--print-schema", action="store_true")
    options.add_argument("--master")
    options.add_argument("--packages", help="connector packages to load")
    options.add_argument("--shuffle-partitions", type=int)
    options.add_argument("--s3-endpoint")
    options.add_argument("--s3-credentials-provider", help="class that knows the store's credentials")
    options.add_argument("--cassandra-host")
    options.add_argument("--cassandra-port", type=int, default=9042)
    return options


def launch(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """Start the chosen application."""
    mode, interval = APPS[args.app]

    def topics() -> Topics:
        further = dict(option.split("=", 1) for option in args.kafka_option)
        return Topics(folder=args.topic_folder, brokers=args.brokers, options=further, keep_batches=args.keep_batches)

    def item_schema() -> str | None:
        if args.item_format == "json":
            return None
        return load_schema(args.schema_file) if args.schema_file else INVOICE_ITEM_SCHEMA

    def read(name: str, positions: bool = False) -> DataFrame:
        return topics().stream(spark, name, args.starting, args.files_per_trigger, positions, reached(spark, args.checkpoint))

    def result(rows: DataFrame):
        if args.print_schema:
            rows.printSchema()
        if not args.target:
            return console_sink(rows)
        sink = {"append": parquet_sink, "update": changelog_sink, "complete": snapshot_sink}[mode]
        return sink(rows, args.target)

    if args.app == "invoice-files":
        schema = source_schema(args.source_schema) if args.source_schema else \
            kept_schema(spark, args.source, args.checkpoint)
        files = args.files_per_trigger or 1
        raw = json_directory(spark, args.source, files, schema) if not args.report_drift else \
            with_drift(spark, args.source, schema, files, strict=args.report_drift == "fail")
        if args.print_schema:
            raw.printSchema()
        writer = apps.flatten_files(raw, args.target)
    elif args.app == "invoice-topic":
        writer = apps.flatten_topic(read(apps.INVOICES), args.target)
    elif args.app == "notifications":
        writer = apps.notify(read(apps.INVOICES), topics())
    elif args.app == "publish-items":
        writer = apps.publish_items(read(apps.INVOICES), topics(), item_schema())
    elif args.app == "rewards":
        if args.resume_from:
            apps.carry_rewards(spark, args.resume_from, args.checkpoint)
        writer = apps.reward_cards(read(apps.ITEMS), topics(), item_schema(), args.checkpoint)
    elif args.app == "last-login":
        if args.keyspace:
            users = CassandraTable(args.keyspace, args.table)
        elif args.buckets:
            users = BucketedTable(args.changes, "login_id", USER, args.buckets)
            users.load(spark.read.schema(USER).parquet(args.users))
        else:
            users = FileTable(args.users, args.changes, "login_id", USER)
        writer = apps.record_logins(read(apps.LOGINS), users, args.show)
    elif args.app == "impression-clicks":
        if args.resume_from:
            if args.target and exists(spark, f"{args.target}/_spark_metadata"):
                raise ValueError("a file sink keeps account of one query's batches: give the new checkpoint a new --target")
            apps.carry_clicks(spark, args.resume_from, args.checkpoint)
        given = spark.read.schema(HOT_KEYS).parquet(args.hot_keys) if args.hot_keys else None
        hot = frozen(spark, f"{args.checkpoint}/hot-keys", lambda: apps.hot_inventory(
            topics().table(spark, apps.IMPRESSIONS), topics().table(spark, apps.CLICKS)), given)
        writer = result(apps.matched_clicks(read(apps.IMPRESSIONS, True), read(apps.CLICKS, True), hot,
                                            args.checkpoint))
    elif args.app == "word-count":
        lines = socket_lines(spark, args.host, args.port) if args.host else \
            text_directory(spark, args.source, args.files_per_trigger)
        writer = result(apps.counted_words(lines))
    else:
        writer = result(apps.trade_totals(read(apps.TRADES)))

    if args.until_caught_up:
        return start(writer, args.checkpoint, mode, args.name, until_caught_up=True)
    return start(writer, args.checkpoint, mode, args.name, args.interval or interval or None)


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    settings = {}
    if args.cassandra_host:
        settings = cassandra_settings(args.cassandra_host, args.cassandra_port)
    spark = app_session(f"millrace {args.app}", args.shuffle_partitions, args.master, args.packages,
                        **settings)
    if args.s3_endpoint:
        use_object_store(spark, args.s3_endpoint, args.s3_credentials_provider)
    launch(engine_session(spark), args).awaitTermination()


if __name__ == "__main__":
    main()
