"""Run a job: ``spark-submit ... -m chatmeter`` or ``python -m chatmeter <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from chatmeter.operators.maintain import bots_of_type
from chatmeter.plans import jobs
from chatmeter.sources.readers import as_dimension, read_dimension, stream_kafka, stream_lines
from chatmeter.sources.store import KpiStore
from chatmeter.streaming import pipeline, timed

BACKFILLS = {
    "backfill-totals": jobs.backfill_totals,
    "backfill-days": jobs.backfill_days,
    "backfill-pv": jobs.backfill_pv,
    "rebuild-history": jobs.rebuild_history,
}
WITH_ARRIVAL = ("backfill-totals", "backfill-days")
STREAMS = ("kpis", "users-day", "answers", "sessions", "words")
STREAM_RULES = {
    "event-time": pipeline.EVENT_TIME,
    "processing-time": pipeline.PROCESSING_TIME,
    "processing-time-case-sensitive": pipeline.PROCESSING_TIME_CASE_SENSITIVE,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chatmeter", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("store", help="folder of the KPI tables, or of the published ones for show, changes and vacuum-published")
        return sub

    for name, function in BACKFILLS.items():
        sub = command(name, function.__doc__.splitlines()[0])
        sub.add_argument("path", help="file, folder or glob of the input")
        sub.add_argument("--job", required=True, help="name of the run; the same name replaces it")
        sub.add_argument("--recursive", action="store_true", help="also files of nested folders")
        if name in WITH_ARRIVAL:
            sub.add_argument("--arrived", help="when the rows arrived; default: as its first run, else now")
    command("merge-history", "add history PV to live PV")
    rollback = command("rollback-day", "forget the users who were new on a day")
    rollback.add_argument("day")
    rollback.add_argument("--type", help="only bots of this type; needs a dimension")
    rollback.add_argument("--dimension", help="parquet table (type, bot_name or botname), or a table of --url")
    rollback.add_argument("--url", help="JDBC address of the database that holds the dimension")
    rollback.add_argument("--user", default="")
    rollback.add_argument("--password-file", help="file with the database password")
    for name, text in (("purge-bots", "forget all users of bots"), ("purge-pv", "drop the total PV of bots")):
        command(name, text).add_argument("bots", nargs="*")
    command("publish", "write the KPI tables for readers").add_argument("out")
    command("refresh", "bring the clustered users and the bitmaps of users in step with the tables")
    for name, text in (("show", "print a published table"), ("changes", "print what changed between two published versions")):
        sub = command(name, text)
        sub.add_argument("table")
        sub.add_argument("--version", type=int, help="default: the latest", required=name == "changes")
        if name == "changes":
            sub.add_argument("--since", type=int, required=True, help="the older version")
        sub.add_argument("--rows", type=int, default=20)
    command("vacuum-published", "delete published versions but the last ones").add_argument("--keep", type=int, default=5)
    compact = command("compact", "fold the batches of a stream or job into one")
    compact.add_argument("source")
    compact.add_argument("--kind", choices=("stream", "job"), default="stream")
    compact.add_argument("--every", type=int, help="fold by levels of so many batches, as streams do themselves")
    vacuum = command("vacuum", "delete data that nothing refers to any more")
    vacuum.add_argument("--hours", type=float, default=24.0, help="age from which on; spares what is under way")
    stream = command("stream", "count the requests of topics, or of files in a folder")
    stream.add_argument("--source", required=True, help="name of the stream, the same over restarts")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--brokers", nargs="+", help="Kafka brokers")
    stream.add_argument("--topics", nargs="+", help="Kafka topics")
    stream.add_argument("--starting", default="latest", help="Kafka offsets of the first start")
    stream.add_argument("--folder", help="watched folder, instead of topics")
    stream.add_argument("--max-per-trigger", type=int, help="Kafka messages, or files, of a batch at most")
    stream.add_argument("--what", choices=STREAMS, default="kpis", help="what the stream fills")
    stream.add_argument("--retention", help="users-day: how long the state holds a day, such as '3 days'; default: for good")
    stream.add_argument("--as-of", help="the day of processing-time rules; default: today")
    stream.add_argument("--rules", choices=STREAM_RULES, default="event-time")
    stream.add_argument("--every", default="1 second", help="trigger interval, or 'once' for all there is")
    stream.add_argument("--upkeep", type=int, default=pipeline.UPKEEP, help="batches between compactions; 0: none")
    return top


def dimension(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if not args.url:
        return as_dimension(spark.read.parquet(args.dimension))
    password = ""
    if args.password_file:
        with open(args.password_file, encoding="utf-8") as file:
            password = file.read().strip()
    return read_dimension(spark, args.url, args.dimension, args.user, password)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    options = parser()
    args = options.parse_args(argv)
    store = KpiStore(spark, args.store)
    if args.command in BACKFILLS:
        more = {"arrived": args.arrived} if args.command in WITH_ARRIVAL else {}
        BACKFILLS[args.command](store, args.path, args.job, recursive=args.recursive, **more)
    elif args.command == "merge-history":
        jobs.merge_history(store)
    elif args.command == "rollback-day":
        if bool(args.type) != bool(args.dimension) or args.url and not args.dimension:
            options.error("--type and --dimension go together, and --url needs both")
        bots = bots_of_type(dimension(spark, args), args.type) if args.type else None
        jobs.rollback_day(store, args.day, bots)
    elif args.command == "purge-bots":
        jobs.purge_bots(store, args.bots)
    elif args.command == "purge-pv":
        jobs.purge_pv(store, args.bots)
    elif args.command == "publish":
        jobs.publish(store, args.out)
    elif args.command == "refresh":
        store.clustered_users().refresh()
        store.user_bits().refresh()
    elif args.command == "show":
        jobs.read_published(spark, args.store, args.table, args.version).show(args.rows, truncate=False)
    elif args.command == "changes":
        jobs.changes(spark, args.store, args.table, args.since, args.version).show(args.rows, truncate=False)
    elif args.command == "vacuum-published":
        jobs.vacuum_published(spark, args.store, args.keep)
    elif args.command == "compact":
        store.compact(args.source, args.kind, args.every)
    elif args.command == "vacuum":
        store.vacuum(args.hours)
    elif args.command == "stream":
        if args.folder:
            lines = stream_lines(spark, args.folder, args.max_per_trigger)
        elif args.brokers and args.topics:
            lines = stream_kafka(
                spark, args.brokers, args.topics, starting=args.starting, max_per_trigger=args.max_per_trigger
            )
        else:
            options.error("give --folder, or --brokers and --topics")
        trigger = pipeline.ONCE if args.every == "once" else {"processingTime": args.every}
        rules = STREAM_RULES[args.rules] | ({"as_of": args.as_of} if args.as_of else {})
        if args.what == "kpis":
            query = pipeline.start_kpis(
                lines, store, args.checkpoint, args.source, trigger=trigger, upkeep=args.upkeep, **rules
            )
        elif args.what == "users-day":
            query = pipeline.start_users_day(
                lines, store, args.checkpoint, args.source, trigger=trigger, retention=args.retention, **rules
            )
        elif args.what == "words":
            query = pipeline.start_word_count(lines, store.path("words"), args.checkpoint, trigger=trigger)
        else:
            start = timed.start_answers if args.what == "answers" else timed.start_sessions
            query = start(lines, store, args.checkpoint, args.source, trigger=trigger)
        query.awaitTermination()


if __name__ == "__main__":
    session = SparkSession.builder.appName("chatmeter").getOrCreate()
    run(session)
    session.stop()
