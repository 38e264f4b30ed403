"""Command line: ``python -m tickloom <job>`` or ``spark-submit tickloom/__main__.py <job>``.

Streams    ingest, bronze, rejects, silver, live
Batch      compact, backfill, rollup, check, missing, maintain, expire
Read       history, latest, lag, skew
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import (
    history_summary,
    keep_symbols,
    lag_stats,
    latest_messages,
    parse_symbols,
    partition_skew,
)
from tickloom.operators.retention import DEFAULT_KEEP_DAYS
from tickloom.plans.checks import check_hours, find_missing_hours, require
from tickloom.plans.compaction import backfill, compact, rows_per_symbol
from tickloom.plans.history import lake_history
from tickloom.plans.maintenance import maintain
from tickloom.plans.retention import drop_folders, expired_folders, expiry_report
from tickloom.plans.rollups import RESOLUTIONS, rollup
from tickloom.session import StoreConfig, build_session
from tickloom.sources import HourRange, Lake, file_messages, kafka_messages
from tickloom.sources.messages import MessageSource
from tickloom.streaming import (
    FileTopic,
    KafkaTopic,
    start_bronze,
    start_event_rejects,
    start_ingest,
    start_live,
    start_rejects,
    start_silver,
)
from tickloom.streaming.jobs import WATERMARK, WINDOW

STREAMS = {"ingest": "2 seconds", "event-rejects": "30 seconds", "bronze": "30 seconds", "rejects": "30 seconds", "silver": "30 seconds", "live": "2 seconds"}


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("--lake", required=True, help="root URI, such as s3a://bucket")
    parser.add_argument("--grain", choices=("hour", "day"), default="hour", help="narrowest time folder")
    jobs = parser.add_subparsers(dest="job", required=True)

    for name, trigger in STREAMS.items():
        stream = jobs.add_parser(name)
        if name in ("ingest", "event-rejects"):
            stream.add_argument("--events", required=True, help="folder of text files, one exchange event per line")
        if name == "ingest":
            stream.add_argument("--symbols", required=True, type=parse_symbols, help="comma-separated")
            stream.add_argument("--partitions", type=int, default=3)
        add_topic(stream, "trades.raw")
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--trigger", default=trigger, help="interval, or 'once' for all that is there")
        stream.add_argument("--window", default=WINDOW)
        stream.add_argument("--watermark", default=WATERMARK)
        stream.add_argument("--trade-ids-below", type=int, help="bound that lets candles skip sorting")
        stream.add_argument("--shuffle-partitions", type=int)
        if name == "live":
            stream.add_argument("--out-topic", default="ohlc.1m")
            stream.add_argument("--out-files", help="folder in place of the output topic")

    for name in ("compact", "backfill", "rollup", "check", "missing", "maintain"):
        batch = jobs.add_parser(name)
        batch.add_argument("--hours", required=True, nargs="+", metavar="KEY", help="hour key, or first and last")
        if name in ("backfill", "maintain"):
            batch.add_argument("--pages", required=name == "backfill", help="JSON lines of symbol and page")
        if name == "backfill":
            batch.add_argument("--run-id", help="repeats a run instead of adding one")
        if name == "missing":
            batch.add_argument("--symbols", type=parse_symbols, help="comma-separated; default: those in the lake")
        if name in ("rollup", "maintain"):
            batch.add_argument("--resolutions", nargs="+", default=RESOLUTIONS)

    expire = jobs.add_parser("expire")
    expire.add_argument("--as-of", type=datetime.date.fromisoformat, default=None)
    expire.add_argument("--keep-days", type=int, default=DEFAULT_KEEP_DAYS)
    expire.add_argument("--drop", action="store_true", help="without it, only report")

    history = jobs.add_parser("history")
    history.add_argument("--symbol", required=True)
    history.add_argument("--resolution", default="1m")
    history.add_argument("--limit", type=int, default=120)

    lag = jobs.add_parser("lag")
    lag.add_argument("--hours", required=True, nargs="+", metavar="KEY", help="hour key, or first and last")
    lag.add_argument("--window", default="1 hour")

    latest = jobs.add_parser("latest")
    add_topic(latest, "ohlc.1m")
    latest.add_argument("--symbols", nargs="+")
    latest.add_argument("--since", type=datetime.datetime.fromisoformat, help="read a topic from this UTC time on only")

    skew = jobs.add_parser("skew")
    add_topic(skew, "trades.raw")
    return parser


def add_topic(parser: argparse.ArgumentParser, topic: str) -> None:
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--topic", default=topic)
    parser.add_argument("--files", help="folder in place of the topic")
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--fail-on-data-loss", action="store_true")


def messages(args: argparse.Namespace) -> MessageSource:
    if args.files:
        return file_messages(args.files)
    return kafka_messages(args.servers, args.topic, args.starting_offsets, args.fail_on_data_loss)


def run_stream(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    trigger = {"availableNow": True} if args.trigger == "once" else {"processingTime": args.trigger}
    if args.job == "event-rejects":
        query = start_event_rejects(spark.readStream.text(args.events), lake, args.checkpoint, trigger)
        query.awaitTermination()
        return
    stream = None if args.job == "ingest" else messages(args).stream(spark)
    if args.job == "ingest":
        events = spark.readStream.text(args.events)
        out = FileTopic(args.files) if args.files else KafkaTopic(args.servers, args.topic)
        query = start_ingest(events, out, args.checkpoint, args.symbols, args.partitions, trigger)
    elif args.job == "bronze":
        query = start_bronze(stream, lake, args.checkpoint, trigger)
    elif args.job == "rejects":
        query = start_rejects(stream, lake, args.checkpoint, trigger)
    else:
        candles = (args.window, args.watermark, trigger, args.trade_ids_below)
        if args.job == "silver":
            query = start_silver(stream, lake, args.checkpoint, *candles)
        else:
            out = FileTopic(args.out_files) if args.out_files else KafkaTopic(args.servers, args.out_topic)
            query = start_live(stream, out, args.checkpoint, *candles)
    query.awaitTermination()


def show(rows: DataFrame) -> None:
    """Print every row, as tab-separated text, without holding them all."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def run_batch(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    hours = HourRange.of(*args.hours)
    landed = getattr(args, "pages", None)
    pages = spark.read.schema("symbol string, page string").json(landed) if landed else None
    if args.job == "compact":
        show(compact(spark, lake, hours))
    elif args.job == "backfill":
        print(backfill(spark, lake, pages, hours, args.run_id))
        show(rows_per_symbol(spark, lake.compacted, lake.span(hours)).orderBy("symbol"))
    elif args.job == "missing":
        symbols = spark.createDataFrame([(s.upper(),) for s in args.symbols], "symbol string") if args.symbols else None
        show(find_missing_hours(spark, lake, hours, symbols).orderBy("symbol", "hour_start"))
    elif args.job == "rollup":
        print(rollup(spark, lake, hours, tuple(args.resolutions)))
    elif args.job == "check":
        results = check_hours(spark, lake, lake.span(hours))
        print(*results, sep="\n")
        for result in results:
            require(result)
    else:
        print(maintain(spark, lake, hours, pages, tuple(args.resolutions)))


def run_read(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    if args.job == "history":
        history = lake_history(spark, lake, args.symbol, args.resolution, limit=args.limit)
        show(history)
        show(history_summary(history))
    elif args.job == "lag":
        stats = lag_stats(lake.trades.read(spark, HourRange.of(*args.hours)), args.window, by=("symbol",))
        show(stats.orderBy(F.desc("window_start"), "symbol"))
    elif args.job == "skew":
        show(partition_skew(messages(args).batch(spark)).orderBy("partition"))
    else:
        since = args.since and int(args.since.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)
        newest = latest_messages(messages(args).batch(spark, since))
        show((keep_symbols(newest, args.symbols) if args.symbols else newest).orderBy("symbol"))


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    lake = Lake(args.lake, args.grain)
    spark = build_session(
        f"tickloom-{args.job}",
        store=StoreConfig.from_env() if args.lake.startswith("s3a://") else None,
        streaming=args.job in STREAMS,
        shuffle_partitions=getattr(args, "shuffle_partitions", None),
    )
    if args.job in STREAMS:
        run_stream(spark, lake, args)
    elif args.job == "expire":
        as_of = args.as_of or datetime.datetime.now(datetime.timezone.utc).date()
        folders = expired_folders(spark, lake, as_of, args.keep_days)
        show(expiry_report(spark, folders).orderBy("table", "dt", "symbol"))
        if args.drop:
            print(f"dropped {len(drop_folders(spark, folders))} folders")
    elif args.job in ("history", "lag", "latest", "skew"):
        run_read(spark, lake, args)
    else:
        run_batch(spark, lake, args)


if __name__ == "__main__":
    main()
