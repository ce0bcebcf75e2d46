"""Run one of the streaming jobs.

    python -m shoptide dau --source /feeds/startup --table /tables/dau --checkpoint /state/dau
    python -m shoptide sales --source /feeds/orders --details /feeds/details --users /tables/users ...

A feed is a folder of JSON-lines files or, with ``--brokers``, a Kafka topic; its messages are the
text of ``value`` and their arrival time. ``--once`` works off what is there and ends.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shoptide import schemas
from shoptide.session import build_session
from shoptide.sources import cdc, decode, kafka, logs
from shoptide.streaming import jobs, sinks

QUARANTINE = {
    "startup": schemas.STARTUP_LOG,
    "event": schemas.EVENT_LOG,
    "order": schemas.ORDER_INFO,
    "detail": schemas.ORDER_DETAIL,
    "user": schemas.USER_INFO,
}


def feed(spark: SparkSession, args: argparse.Namespace, source: str) -> DataFrame:
    if args.brokers:
        limit = {"maxOffsetsPerTrigger": str(args.per_trigger)} if args.per_trigger else {}
        return kafka.kafka_stream(spark, args.brokers, [source], args.group, **limit)
    lines = spark.readStream
    if args.per_trigger:
        lines = lines.option("maxFilesPerTrigger", args.per_trigger)
    # A later file is newer than an earlier one, and within a file lines follow in order.
    return lines.text(source).select("value", F.col("_metadata.file_modification_time").alias("timestamp"), F.col("_metadata.file_block_start").alias("block"))


def routed_output(df: DataFrame, args: argparse.Namespace) -> DataStreamWriter:
    """Messages to their topics, or to a folder per topic."""
    if args.brokers:
        return sinks.kafka(df, args.brokers)
    return df.select("topic", "value").writeStream.format("text").partitionBy("topic").option("path", args.table)


def writer(spark: SparkSession, args: argparse.Namespace) -> DataStreamWriter:
    messages = feed(spark, args, args.source)
    match args.job:
        case "dau":
            return jobs.dau(messages, jobs.dau_table(args.table, writer=args.writer))
        case "first":
            devices = jobs.device_table(f"{args.table}-devices", writer=args.writer)
            return jobs.first_seen(messages, devices, jobs.first_day_table(args.table, writer=args.writer))
        case "gmv":
            hours = jobs.hour_table(args.hours, writer=args.writer) if args.hours else None
            return jobs.gmv(messages, jobs.order_table(args.table, writer=args.writer), hours)
        case "alerts":
            panes = jobs.pane_table(args.table, writer=args.writer)
            if args.docs:
                return jobs.coupon_alert_docs(messages, panes, jobs.alert_table(args.docs, writer=args.writer))
            return jobs.coupon_panes(messages, panes)
        case "users":
            return jobs.users(messages, jobs.user_table(args.table, writer=args.writer))
        case "sales":
            known = jobs.user_table(args.users)
            index = jobs.token_table(args.index, writer=args.writer) if args.index else None
            return jobs.sale_details(messages, feed(spark, args, args.details), known, jobs.sale_table(args.table, writer=args.writer), index=index)
        case "documents":
            return jobs.documents(messages, jobs.document_table(args.table, writer=args.writer))
        case "logs":
            return routed_output(logs.route(messages).filter(~F.col("malformed")), args)
        case "archive":
            return sinks.archive(logs.archive_rows(logs.route(messages)), args.table)
        case "cdc":
            entries = decode.nested(messages, schemas.CDC_ENVELOPE)
            return routed_output(cdc.flatten(cdc.route(entries)), args)
        case "quarantine":
            if args.record == "log":
                return jobs.aside(logs.route(messages).filter("malformed").select(F.col("value").alias("raw")), args.table)
            if args.record == "change":
                return jobs.aside(decode.unparsed(messages, schemas.CDC_ENVELOPE), args.table)
            return jobs.quarantine(messages, QUARANTINE[args.record], args.table)
    raise ValueError(args.job)


# Tables that the compact job knows, by the job that writes them.
TABLES = {
    "dau": jobs.dau_table,
    "first": jobs.first_day_table,
    "devices": jobs.device_table,
    "gmv": jobs.order_table,
    "hours": jobs.hour_table,
    "panes": jobs.pane_table,
    "alerts": jobs.alert_table,
    "users": jobs.user_table,
    "sales": jobs.sale_table,
    "index": jobs.token_table,
    "documents": jobs.document_table,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shoptide", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["dau", "first", "gmv", "alerts", "users", "sales", "documents", "logs", "archive", "cdc", "quarantine", "compact"])
    parser.add_argument("--source", help="feed folder, or topic with --brokers")
    parser.add_argument("--details", help="order-item feed of the sales job")
    parser.add_argument("--users", help="user table of the sales job")
    parser.add_argument("--hours", help="folder of hourly totals that the gmv job keeps beside its orders")
    parser.add_argument("--index", help="folder of the token index that the sales job keeps beside its table")
    parser.add_argument("--docs", help="folder of alert documents that the alerts job keeps beside its panes")
    parser.add_argument("--record", choices=[*sorted(QUARANTINE), "log", "change"], help="record of the quarantine job; log and change are raw device logs and change entries")
    parser.add_argument("--table", help="folder the job writes; not used when it writes topics")
    parser.add_argument("--kind", choices=sorted(TABLES), help="what the table of the compact job holds")
    parser.add_argument("--up-to", help="last day that the compact job merges")
    parser.add_argument("--checkpoint", help="folder for the job's progress and state")
    parser.add_argument("--writer", default="main", help="new name for a job started over with a new checkpoint")
    parser.add_argument("--brokers", help="Kafka bootstrap servers")
    parser.add_argument("--group", help="Kafka consumer group")
    parser.add_argument("--per-trigger", type=int, help="at most so many files, or offsets with --brokers, in a micro-batch")
    parser.add_argument("--once", action="store_true", help="stop when the feed is worked off")
    args = parser.parse_args(argv)

    spark = build_session(f"shoptide-{args.job}")
    if args.job == "compact":
        print(*sinks.compact_closed(spark, TABLES[args.kind](args.table), args.up_to), sep="\n")
        return
    if not (args.source and args.checkpoint):
        parser.error("--source and --checkpoint are needed")
    ready = writer(spark, args)
    if args.once:
        jobs.run_to_end(spark, ready, args.checkpoint)
    else:
        jobs.start(ready, args.checkpoint, args.job).awaitTermination()


if __name__ == "__main__":
    main()
