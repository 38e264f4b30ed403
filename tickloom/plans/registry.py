"""Every operator as a named query over the benchmark tables.

Times stay ``timestamp_ntz`` where the operator allows it. Results leave as
doubles and text dates, so that comparing two engines does not depend on how a
client renders decimals and dates; all arithmetic before that is decimal.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom import operators as op
from tickloom.functions import display_number, display_window, dt_hour
from tickloom.plans.amend import amended_candles
from tickloom.plans.checks import find_missing_hours
from tickloom.plans.compaction import backfill, compact
from tickloom.plans.history import lake_history
from tickloom.plans.lag import lag_report
from tickloom.plans.replay import replay_missing
from tickloom.plans.retention import drop_folders, expired_folders, expiry_report
from tickloom.plans.rollups import rollup
from tickloom.schemas import CANDLE_SCHEMA, MESSAGE_SCHEMA, TRADE_SCHEMA, conform
from tickloom.session import shared_dir
from tickloom.sources import HourRange, Lake, event_trades, lineitem_trades, read_table
from tickloom.streaming import (
    FileTopic,
    batch_writer,
    candle_writer,
    open_candles,
    start_bronze,
    start_ingest,
    start_live,
    start_parts,
    start_rejects,
    start_rollup,
    start_silver,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
CANDLE_WIDTH = "1 hour"
LISTED_SYMBOLS = " click, purchase,error,, "
ROUTED_SYMBOLS = "click,view,purchase,error,signup"
TOPIC_PARTITIONS = 3
HISTORY_SYMBOL = "purchase"
SLICE_KEYS = ("2024-01-10-06:00", "2024-01-12-05:00")
EXPIRY_DATE = "2024-01-20"
# the widest ids that share a long with the microseconds of a minute
TRADE_IDS_BELOW = 1 << 37
# a stream that was cut off part of the time sees only trades below this price
PARTIAL_BELOW = 20
# event time for which the keys of trades are kept: all of the table's
DISTINCT_WITHIN = "400 days"
# one trade in so many comes in after all others
HELD_BACK = 7


def report(df: DataFrame) -> DataFrame:
    """The edge form of a result: decimals as doubles, dates as text."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(columns)


# ---- inputs derived from the tables -------------------------------------------------


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_trades(read_table(spark, sf_dir, "events"))


def candles(spark: SparkSession, sf_dir: str, width: str = CANDLE_WIDTH) -> DataFrame:
    return op.build_candles(trades(spark, sf_dir), width)


def partial_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.build_candles(trades(spark, sf_dir).filter(F.col("price") < PARTIAL_BELOW), CANDLE_WIDTH)


def stored(df: DataFrame) -> DataFrame:
    """Candles as the lake holds them: instants, with partition columns."""
    zoned = df.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    return dt_hour(zoned, "window_start")


def message_fields(events: DataFrame) -> DataFrame:
    """``events`` under the field names of a trade message."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").cast("decimal(18,8)").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("quantity"),
        ms.alias("trade_time_ms"),
        (ms + 5).alias("event_time_ms"),
        (F.col("user_id") > 100).alias("is_buyer_maker"),
        F.lit("events").alias("source"),
        (ms + 50 + F.pmod(F.col("event_id") * 37, F.lit(900))).alias("ingested_at_ms"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trade_messages(message_fields(read_table(spark, sf_dir, "events")))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trade_messages(message_fields(event_stream(spark, sf_dir)))


# ---- decode and routing -------------------------------------------------------------


def envelopes(fields: DataFrame) -> DataFrame:
    """Trade message fields wrapped as the exchange sends them."""
    payload = F.create_map(
        *[
            item
            for key, name in op.decode.EVENT_KEYS.items()
            for item in (F.lit(key), F.col(name).cast("string"))
        ]
    )
    return fields.select(F.to_json(F.struct(payload.alias("data"))).alias("value"))


def event_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.normalize_events(envelopes(message_fields(read_table(spark, sf_dir, "events")))))


def trade_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.decode_trades(messages(spark, sf_dir)))


def damaged_messages(events: DataFrame) -> DataFrame:
    """Messages damaged in a different way for each event type."""
    fields = message_fields(events).withColumns(
        {
            "price": F.when(F.col("symbol") == "error", F.lit("n/a")).otherwise(F.col("price")),
            "trade_time_ms": F.when(F.col("symbol") != "signup", F.col("trade_time_ms")),
        }
    )
    cut = F.when(F.col("key") == "view", F.substring("value", 1, 12)).otherwise(F.col("value"))
    return op.trade_messages(fields).withColumn("value", cut)


def trade_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = op.decode_trades(damaged_messages(read_table(spark, sf_dir, "events")))
    tagged = decoded.select(F.coalesce(op.reject_reason(), F.lit("valid")).alias("reason"))
    return tagged.groupBy("reason").agg(F.count("*").alias("messages"))


def trade_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = dt_hour(trades(spark, sf_dir), "trade_time")
    return report(placed.groupBy("symbol", "dt", "hour").agg(F.count("*").alias("trades")))


def symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = trades(spark, sf_dir).withColumn("symbol", F.upper("symbol"))
    kept = op.keep_symbols(upper, op.parse_symbols(LISTED_SYMBOLS))
    return report(kept.select("symbol", "trade_id", "price"))


def partition_routing_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = op.route_symbols(trades(spark, sf_dir), op.parse_symbols(ROUTED_SYMBOLS), TOPIC_PARTITIONS)
    return op.partition_skew(routed)


def ingest_lag_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = message_fields(read_table(spark, sf_dir, "events"))
    timed = fields.withColumn("trade_time", F.timestamp_millis("trade_time_ms"))
    stats = op.lag_stats(timed, "1 day", by=("symbol",), exact=True)
    # interpolated quantiles differ in the last bit between engines
    return report(stats.withColumns({c: F.round(c, 6) for c in ("p50_lag_ms", "p95_lag_ms")}))


def kline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_of(candles(spark, sf_dir))


def pages_of(hourly: DataFrame) -> DataFrame:
    """Hourly candles as history pages, one page of at most 24 klines per symbol and day."""
    full = stored(hourly)
    kline = F.array(
        F.unix_millis("window_start").cast("string"),
        *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        (F.unix_millis("window_end") - 1).cast("string"),
        F.col("quote_volume").cast("string"),
        F.col("trade_count").cast("string"),
    )
    return full.groupBy("symbol", "dt").agg(F.to_json(F.collect_list(kline)).alias("page")).drop("dt")


def kline_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.decode_klines(kline_pages(spark, sf_dir)))


# ---- candles ------------------------------------------------------------------------


def ohlc_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(candles(spark, sf_dir))


def ohlc_candles_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(candles(spark, sf_dir, "1 minute"))


def ohlc_candles_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.build_candles(trades(spark, sf_dir), "1 minute", trade_ids_below=TRADE_IDS_BELOW))


def ohlc_candles_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = lineitem_trades(read_table(spark, sf_dir, "lineitem"))
    return report(op.build_candles(ticks, "1 day", tie_breakers=("trade_id", "line_number")))


def rolled(width: str, base: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(op.rollup_candles(candles(spark, sf_dir, base), width))

    return query


def dedupe_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial and full copies of every candle, and each full one twice."""
    full = candles(spark, sf_dir)
    copies = partial_candles(spark, sf_dir).unionByName(full).unionByName(full)
    return report(op.dedupe_candles(copies))


def backfill_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial stream completed by backfilled pages."""
    streamed = stored(partial_candles(spark, sf_dir)).select(CANDLE_SCHEMA.fieldNames())
    pages = op.decode_klines(kline_pages(spark, sf_dir))
    return report(op.merge_sources({"stream": streamed, "backfill": pages}))


# ---- serving ------------------------------------------------------------------------


def candle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = stored(candles(spark, sf_dir)).select(CANDLE_SCHEMA.fieldNames())
    return op.candle_messages(full)


def latest_message_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candle published twice, first partial and then full."""
    fields = CANDLE_SCHEMA.fieldNames()
    rounds = [partial_candles(spark, sf_dir), candles(spark, sf_dir)]
    first, second = (
        op.candle_messages(stored(df).select(fields)).withColumn("offset", F.lit(turn)) for turn, df in enumerate(rounds)
    )
    newest = op.latest_messages(first.unionByName(second))
    candle = F.from_json("value", CANDLE_SCHEMA)
    return report(newest.select(candle.alias("c")).select("c.*"))


def latest_candle_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.latest_candles(candles(spark, sf_dir)))


def history_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(op.candle_history(candles(spark, sf_dir, "1 minute"), HISTORY_SYMBOL))


def history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.history_summary(op.candle_history(candles(spark, sf_dir, "1 minute"), HISTORY_SYMBOL))


def history_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = op.latest_candles(candles(spark, sf_dir))
    return newest.select(
        "symbol",
        display_window(F.col("window_start")).alias("window_text"),
        *[display_number(F.col(c)).alias(f"{c}_text") for c in ("open", "high", "low", "close")],
        display_number(F.col("quote_volume")).alias("quote_volume_text"),
        display_number(F.col("trade_count"), 0).alias("trades_text"),
    )


def hour_range_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = HourRange.of(*SLICE_KEYS)
    placed = dt_hour(candles(spark, sf_dir), "window_start").filter(hours.partitions())
    return report(placed.select("symbol", "dt", "hour", "window_start", "close", "trade_count"))


# ---- quality ------------------------------------------------------------------------


def ohlc_invariant_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.invariant_report(candles(spark, sf_dir))


def ohlc_invariant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = op.invariant_violations(candles(spark, sf_dir))
    return broken.select("symbol", "window_start", F.array_join("broken_rules", ",").alias("broken_rules"))


def candle_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.candle_gaps(candles(spark, sf_dir), "1 hour")


def candle_gap_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gap_count(candles(spark, sf_dir, "1 minute"), "1 minute")


def missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.missing_hours(candles(spark, sf_dir))


def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = dt_hour(trades(spark, sf_dir), "trade_time")
    return report(op.expired_partitions(placed, EXPIRY_DATE))


# ---- lake jobs and streams ----------------------------------------------------------


def folder_hours(spark: SparkSession, sf_dir: str) -> HourRange:
    """The hours from the first to the last trade, without building candles."""
    bounds = read_table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return HourRange.of(*bounds.select(*[F.date_format(c, "yyyy-MM-dd-HH:00") for c in ("first", "last")]).first())


def compaction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream delivered partial candles in one batch and full ones in the next."""
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    write = candle_writer(lake.streamed, query_id="replay")
    for batch_id, batch in enumerate([partial_candles(spark, sf_dir), candles(spark, sf_dir)]):
        write(batch, batch_id)
    return compact(spark, lake)


def lake_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial stream in the lake, completed by backfill runs that share days.

    The first run lands the even hours of every day, the second the odd ones,
    and the third repeats a part of both.
    """
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    candle_writer(lake.streamed, query_id="replay")(partial_candles(spark, sf_dir), 0)
    full = candles(spark, sf_dir).withColumn("turn", F.hour("window_start") % 6)
    hours = folder_hours(spark, sf_dir)
    for turns in ((0, 2, 4), (1, 3, 5), (0, 1)):
        backfill(spark, lake, pages_of(full.filter(F.col("turn").isin(*turns))), hours)
    return report(lake.compacted.read(spark).select(CANDLE_SCHEMA.fieldNames()))


def gold_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted candles rolled up through the lake's tables, read back from gold."""
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    lake.compacted.replace_partitions(candles(spark, sf_dir), sort_by=("window_start",))
    rollup(spark, lake, folder_hours(spark, sf_dir), ("4h", "1d"))
    widths = [lake.gold(label).read(spark).withColumn("resolution", F.lit(label)) for label in ("4h", "1d")]
    return report(widths[0].unionByName(widths[1]))


def stream_closed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    start_silver(
        message_stream(spark, sf_dir),
        lake,
        shared_dir(spark, "checkpoint"),
        width=CANDLE_WIDTH,
        trigger={"availableNow": True},
    ).awaitTermination()
    return report(lake.streamed.read(spark).select(CANDLE_SCHEMA.fieldNames()))


def stream_live_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live topic's last word on each candle, open ones included."""
    topic = FileTopic(shared_dir(spark, "topic"))
    start_live(
        message_stream(spark, sf_dir),
        topic,
        shared_dir(spark, "checkpoint"),
        width=CANDLE_WIDTH,
        trigger={"availableNow": True},
    ).awaitTermination()
    published = spark.read.parquet(topic.path).select("offset", F.from_json("value", CANDLE_SCHEMA).alias("c"))
    values = [c for c in CANDLE_SCHEMA.fieldNames() if c not in ("symbol", "window_start")]
    return report(
        published.select("offset", "c.*")
        .groupBy("symbol", "window_start")
        .agg(*[F.max_by(c, "offset").alias(c) for c in values])
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange events of three listed symbols, routed and stamped on their way to the topic."""
    topic = FileTopic(shared_dir(spark, "topic"))
    fields = message_fields(event_stream(spark, sf_dir)).withColumn("symbol", F.upper("symbol"))
    start_ingest(
        envelopes(fields),
        topic,
        shared_dir(spark, "checkpoint"),
        op.parse_symbols(LISTED_SYMBOLS),
        TOPIC_PARTITIONS,
        trigger={"availableNow": True},
    ).awaitTermination()
    sent = spark.read.schema(MESSAGE_SCHEMA).parquet(topic.path)
    decoded = op.decode_trades(sent, keep=("key", "partition"))
    return report(
        decoded.select(
            "key",
            "partition",
            "trade_id",
            "price",
            "trade_time",
            (F.col("ingested_at_ms") > F.col("trade_time_ms")).alias("stamped"),
        )
    )


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(shared_dir(spark, "bronze"))
    start_rejects(
        damaged_messages(event_stream(spark, sf_dir)), lake, shared_dir(spark, "checkpoint"), trigger={"availableNow": True}
    ).awaitTermination()
    # the stored text still holds the trade ids, except where it was cut before them
    trade_id = F.regexp_extract("value", r'"trade_id":(\d+)', 1).try_cast("long")
    kept = lake.rejects().read(spark).withColumn("trade_id", F.coalesce(trade_id, F.lit(0)))
    return kept.groupBy("reason").agg(F.count("*").alias("messages"), F.sum("trade_id").alias("trade_ids"))


def stream_bronze_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake(shared_dir(spark, "bronze"), grain="day")
    start_bronze(
        message_stream(spark, sf_dir), lake, shared_dir(spark, "checkpoint"), trigger={"availableNow": True}
    ).awaitTermination()
    # through the root, through a range of days, and symbol by symbol: the same rows
    hours = folder_hours(spark, sf_dir)
    wide = HourRange(hours.start - timedelta(days=100), hours.end)
    columns = ("symbol", "dt", "trade_id", "price", "quantity", "trade_time")
    archived = lake.trades.read(spark).select(*columns)
    ranged = lake.trades.read(spark, wide).select(*columns)
    single = lake.trades.read(spark, wide, "click").select(*columns).unionByName(ranged.filter("symbol <> 'click'"))
    return report(archived.intersectAll(ranged).intersectAll(single))


def retention_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze filled by its streams; what expiry reports, what it drops, and what is left.

    Rejects are stamped with the current day, so they stay.
    """
    lake = Lake(shared_dir(spark, "bronze"), grain="day")
    now = {"availableNow": True}
    start_bronze(damaged_messages(event_stream(spark, sf_dir)), lake, shared_dir(spark, "checkpoint"), now).awaitTermination()
    start_rejects(damaged_messages(event_stream(spark, sf_dir)), lake, shared_dir(spark, "checkpoint"), now).awaitTermination()
    folders = expired_folders(spark, lake, date.fromisoformat(EXPIRY_DATE))
    reported = expiry_report(spark, folders).select("table", "symbol", "dt", "rows").collect()  # one row a folder
    dropped = set(drop_folders(spark, folders))
    gone = [(f.name, f.symbol, f.day, None) for f in folders if f.path in dropped]
    schema = "table string, symbol string, dt date, rows long"
    left = lake.trades.read(spark).groupBy("symbol", "dt").agg(F.count("*").alias("rows")).selectExpr("'trades' AS table", "*")
    rejected = lake.rejects().read(spark).groupBy("reason").agg(F.count("*").alias("rows"))
    sides = [
        spark.createDataFrame(reported, schema).withColumn("what", F.lit("reported")),
        spark.createDataFrame(gone, schema).withColumn("what", F.lit("dropped")),
        left.withColumn("what", F.lit("left")),
        rejected.selectExpr("'rejects_trades' AS table", "reason AS symbol", "cast(null AS date) AS dt", "rows", "'left' AS what"),
    ]
    return report(reduce(lambda a, b: a.unionByName(b), sides))


# ---- rejects ------------------------------------------------------------------------


def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged exchange events: each is either usable or rejected with a reason."""
    fields = message_fields(read_table(spark, sf_dir, "events")).withColumns(
        {
            "price": F.when(F.col("symbol") != "error", F.col("price")),
            "trade_id": F.when(F.col("symbol") != "signup", F.col("trade_id")),
        }
    )
    cut = F.when(F.get_json_object("value", "$.data.s") == "view", F.substring("value", 1, 12)).otherwise(F.col("value"))
    usable, rejects = op.split_events(envelopes(fields).withColumn("value", cut))
    sides = usable.selectExpr("'valid' AS reason").unionByName(rejects.select("reason"))
    return sides.groupBy("reason").agg(F.count("*").alias("events"))


def kline_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged history pages: each kline, or unreadable page, is either whole or rejected with a reason."""
    hurt = kline_pages(spark, sf_dir).withColumn(
        "page",
        F.when(F.col("symbol") == "view", F.substring("page", 1, 9))
        .when(F.col("symbol") == "error", F.regexp_replace("page", r'\["\d+"', '["9223372036854775807"'))
        .when(F.col("symbol") == "signup", F.regexp_replace("page", r'"\d+"\]', '"many"]'))
        .otherwise(F.col("page")),
    )
    whole, rejects = op.split_klines(op.decode_klines(hurt))
    sides = whole.selectExpr("'valid' AS reason").unionByName(rejects.select("reason"))
    return sides.groupBy("reason").agg(F.count("*").alias("klines"))


# ---- reads of a lake ------------------------------------------------------------------


def history_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest hours of a symbol, from 1-minute candles in the lake."""
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    lake.compacted.replace_partitions(candles(spark, sf_dir, "1 minute"), sort_by=("window_start",))
    return report(lake_history(spark, lake, HISTORY_SYMBOL))


def missing_hours_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without candles in a lake with planted holes: every fifth hour of the day is left out."""
    lake = Lake(shared_dir(spark, "lake"))
    holed = candles(spark, sf_dir).filter(F.hour("window_start") % 5 != 0)
    lake.compacted.replace_partitions(holed, sort_by=("window_start",))
    return report(find_missing_hours(spark, lake, folder_hours(spark, sf_dir)))


def ingest_lag_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate lag quantiles next to the exact ones: is each within a thousandth of the ranks?"""
    timed = message_fields(read_table(spark, sf_dir, "events")).withColumn("trade_time", F.timestamp_millis("trade_time_ms"))
    close = op.lag_stats(timed, "1 day", by=("symbol",))
    lags = timed.select("symbol", F.date_trunc("day", "trade_time").alias("window_start"), (F.col("ingested_at_ms") - F.col("trade_time_ms")).alias("lag_ms"))
    joined = lags.join(close.select("symbol", "window_start", "trades", "p50_lag_ms", "p95_lag_ms"), ["symbol", "window_start"])
    below = [F.count_if(F.col("lag_ms") < F.col(c)).alias(f"{c}_below") for c in ("p50_lag_ms", "p95_lag_ms")]
    upto = [F.count_if(F.col("lag_ms") <= F.col(c)).alias(f"{c}_upto") for c in ("p50_lag_ms", "p95_lag_ms")]
    ranks = joined.groupBy("symbol", "window_start", "trades").agg(*below, *upto)
    # the sketch's stated accuracy is 1 / 10,000 of the rows; a rank is off by one at least
    slack = 1 + F.col("trades") / 1000

    def fits(name: str, q: float) -> Column:
        want = F.col("trades") * q
        return ((F.col(f"{name}_below") <= want + slack) & (F.col(f"{name}_upto") >= want - slack)).alias(f"{name}_close")

    return report(ranks.select("symbol", "window_start", "trades", fits("p50_lag_ms", 0.5), fits("p95_lag_ms", 0.95)))


def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch that is run twice, and one whose hour has no rows, leave each candle once."""
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    write = candle_writer(lake.streamed, query_id="replay")
    full = candles(spark, sf_dir)
    write(full.filter(F.hour("window_start") < 12), 0)
    write(full.filter(F.hour("window_start") < 12), 0)
    write(full.filter("1 = 0"), 1)
    write(full.filter(F.hour("window_start") >= 12), 2)
    return report(lake.streamed.read(spark).select(CANDLE_SCHEMA.fieldNames()))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come in after the watermark has passed their window do not count.

    The table is sent in three parts: the first half by time, then the rest,
    then a copy of the first hour's events, which is far too late.
    """
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    events = read_table(spark, sf_dir, "events")
    bounds = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = bounds.first + (bounds.last - bounds.first) / 2
    parts = [events.filter(F.col("ts") < F.lit(middle)), events.filter(F.col("ts") >= F.lit(middle)), events.filter(F.col("ts") < F.lit(bounds.first + timedelta(hours=1)))]
    checkpoint = shared_dir(spark, "checkpoint")
    sent_in_parts(spark, parts, lambda messages: start_silver(messages, lake, checkpoint, width=CANDLE_WIDTH, trigger={"availableNow": True}))
    return report(lake.streamed.read(spark).select(CANDLE_SCHEMA.fieldNames()))


# ---- streams that lose nothing ---------------------------------------------------------


def sent_in_parts(spark: SparkSession, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Send each part of ``events`` as a folder of its own, with a restart of the stream after each.

    The tasks that read a part write its files, and the stream takes all new
    files as one batch: no task has a part as a whole.
    """
    landed = shared_dir(spark, "events")
    for number, part in enumerate(parts):
        part.write.parquet(f"{landed}/part={number}")
        stream = spark.readStream.schema(part.schema).parquet(f"{landed}/*")
        start(op.trade_messages(message_fields(stream))).awaitTermination()


def resent_events(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The first half by time, then the second; a third of each is sent twice, and a third of the first half again with the second."""
    events = read_table(spark, sf_dir, "events")
    bounds = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    middle = F.lit(bounds.first + (bounds.last - bounds.first) / 2)
    again = events.filter(F.col("event_id") % 3 == 0)
    early = again.filter(F.col("ts") < middle)
    return [
        events.filter(F.col("ts") < middle).unionByName(early),
        events.filter(F.col("ts") >= middle).unionByName(again.filter(F.col("ts") >= middle)).unionByName(early),
    ]


def stream_distinct_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of a topic that delivered many trades twice or three times, across batches and a restart."""
    lake = Lake(shared_dir(spark, "bronze"), grain="day")
    checkpoint = shared_dir(spark, "checkpoint")
    sent_in_parts(
        spark,
        resent_events(spark, sf_dir),
        lambda messages: start_bronze(messages, lake, checkpoint, {"availableNow": True}, distinct_within=DISTINCT_WITHIN),
    )
    return report(lake.trades.read(spark).select("symbol", "dt", "trade_id", "price", "quantity", "trade_time"))


def stream_distinct_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed candles of the same topic: each trade counts once."""
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    checkpoint = shared_dir(spark, "checkpoint")
    sent_in_parts(
        spark,
        resent_events(spark, sf_dir),
        lambda messages: start_silver(messages, lake, checkpoint, CANDLE_WIDTH, trigger={"availableNow": True}, distinct=True),
    )
    return report(lake.streamed.read(spark).select(CANDLE_SCHEMA.fieldNames()))


def parts_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Parts of candles from a topic where one symbol comes in after all others, and a seventh of the trades last of all."""
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    checkpoint = shared_dir(spark, "checkpoint")
    events = read_table(spark, sf_dir, "events")
    held = F.col("event_id") % HELD_BACK == 0
    behind = F.col("event_type") == HISTORY_SYMBOL
    sent_in_parts(
        spark,
        [events.filter(~held & ~behind), events.filter(~held & behind), events.filter(held)],
        lambda messages: start_parts(messages, lake, checkpoint, CANDLE_WIDTH, trigger={"availableNow": True}),
    )
    return lake


def stream_late_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades sent, counted in time and kept as late, by symbol."""
    lake = parts_lake(spark, sf_dir)
    sent = read_table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol")).agg(F.count("*").alias("sent"))
    counted = lake.parts.read(spark).filter("NOT late").groupBy("symbol").agg(F.sum("trade_count").alias("counted"))
    late = lake.late.read(spark).groupBy("symbol").agg(F.count("*").alias("late"), F.sum("trade_id").alias("late_ids"))
    return sent.join(counted, "symbol", "left").join(late, "symbol", "left").withColumn("whole", F.col("counted") + F.col("late") == F.col("sent"))


def stream_amended_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles that late trades have changed, next to what they were: no trade is read again."""
    lake = parts_lake(spark, sf_dir)
    before = amended_candles(spark, lake, late=False).select("symbol", "window_start", F.col("trade_count").alias("in_time"))
    amended = amended_candles(spark, lake).join(before, ["symbol", "window_start"], "left")
    return report(amended.select(*CANDLE_SCHEMA.fieldNames(), F.coalesce("in_time", F.lit(0)).alias("in_time")))


def partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a split of the trades by id, merged pair by pair, as candles."""
    parts = [op.partial_candles(trades(spark, sf_dir).filter(F.col("trade_id") % 4 == n), CANDLE_WIDTH) for n in range(4)]
    pairs = [op.merge_partials(a.unionByName(b)) for a, b in ((parts[3], parts[0]), (parts[1], parts[2]))]
    return report(op.finish_partials(pairs[0].unionByName(pairs[1])))


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1-minute candles rolled up to 5 minutes and to an hour inside one stream."""
    lake = Lake(shared_dir(spark, "gold"), grain="day")
    start_rollup(
        message_stream(spark, sf_dir),
        lake,
        shared_dir(spark, "checkpoint"),
        "1h",
        ("1 minute", "5 minutes", "1 hour"),
        trigger={"availableNow": True},
    ).awaitTermination()
    return report(lake.streamed_gold("1h").read(spark).select(CANDLE_SCHEMA.fieldNames()))


def stream_open_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candles of a finite stream: closed ones from the table, open ones from the state of its checkpoint."""
    lake = Lake(shared_dir(spark, "silver"), grain="day")
    checkpoint = shared_dir(spark, "checkpoint")
    now = {"availableNow": True}
    start_silver(message_stream(spark, sf_dir), lake, checkpoint, width=CANDLE_WIDTH, trigger=now).awaitTermination()
    closed = lake.streamed.read(spark).select(CANDLE_SCHEMA.fieldNames()).withColumn("closed", F.lit(True))
    return report(closed.unionByName(open_candles(spark, checkpoint).withColumn("closed", F.lit(False))))


# ---- lag, routing, holes and differences ------------------------------------------------


def lag_sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag by day from sketches stored by the minute: is each quantile within the sketch's stated error of its rank?"""
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    placed = op.decode_trades(messages(spark, sf_dir))
    lake.lag.replace_partitions(op.lag_sketches(placed), sort_by=("window_start",))
    days = lag_report(spark, lake, "1 day")
    lag = F.col("ingested_at_ms") - F.col("trade_time_ms")
    lags = placed.select("symbol", F.date_trunc("day", "trade_time").alias("window_start"), lag.alias("lag_ms"))
    joined = lags.join(days, ["symbol", "window_start"])
    slack = 1 + 2 * op.rank_error() * F.col("trades")
    by = ["symbol", "window_start", "trades", "min_lag_ms", "max_lag_ms"]

    def close(name: str, q: float) -> Column:
        below, upto = (F.count_if(c) for c in (F.col("lag_ms") < F.col(name), F.col("lag_ms") <= F.col(name)))
        want = F.first("trades") * q
        return ((below <= want + F.first(slack)) & (upto >= want - F.first(slack))).alias(f"{name}_close")

    return report(joined.groupBy(*by).agg(close("p50_lag_ms", 0.5), close("p95_lag_ms", 0.95)))


def partition_routing_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols dealt to partitions by their measured loads."""
    rows = trades(spark, sf_dir)
    routes = op.assign_by_load(op.measured_loads(rows, op.parse_symbols(ROUTED_SYMBOLS)), TOPIC_PARTITIONS)
    routed = op.route_by_load(rows, routes).filter("partition IS NOT NULL")
    return routed.groupBy(F.upper("symbol").alias("symbol"), "partition").agg(F.count("*").alias("load"))


def replayed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles with planted holes, filled from the archive; every fifth hour of the day was left out."""
    lake = Lake(shared_dir(spark, "lake"), grain="day")
    archived = conform(op.decode_trades(messages(spark, sf_dir)), TRADE_SCHEMA)
    batch_writer(lake.trades, "trade_time", query_id="replay")(archived, 0)
    whole = op.build_candles(archived, "1 minute")
    candle_writer(lake.streamed, query_id="replay")(whole.filter(F.hour("window_start") % 5 != 0), 0)
    compact(spark, lake)
    replay_missing(spark, lake, folder_hours(spark, sf_dir), archived.select("symbol").distinct())
    return report(lake.compacted.read(spark).select(CANDLE_SCHEMA.fieldNames()))


def source_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial stream against history pages that lack every fifth hour: what differs, and in which fields."""
    streamed = stored(partial_candles(spark, sf_dir)).select(CANDLE_SCHEMA.fieldNames())
    pages = op.decode_klines(pages_of(candles(spark, sf_dir).filter(F.hour("window_start") % 5 != 0)))
    found = op.compare_sources(streamed, pages)
    return report(
        found.select(
            "symbol",
            "window_start",
            "status",
            F.array_join("fields", ",").alias("fields"),
            F.col("stream.trade_count").alias("stream_trades"),
            F.col("backfill.trade_count").alias("backfill_trades"),
        )
    )


QUERIES: dict[str, Query] = {
    "ohlc_candles": ohlc_candles,
    "ohlc_candles_1m": ohlc_candles_1m,
    "ohlc_candles_packed": ohlc_candles_packed,
    "ohlc_candles_lineitem": ohlc_candles_lineitem,
    "event_normalize": event_normalize,
    "trade_decode": trade_decode,
    "trade_rejects": trade_rejects,
    "trade_partitions": trade_partitions,
    "symbol_filter": symbol_filter,
    "partition_routing_skew": partition_routing_skew,
    "ingest_lag_stats": ingest_lag_stats,
    "kline_decode": kline_decode,
    "ohlc_rollup_5m": rolled("5 minutes", "1 minute"),
    "ohlc_rollup_15m": rolled("15 minutes", "1 minute"),
    "ohlc_rollup_1h": rolled("1 hour", "1 minute"),
    "ohlc_rollup_4h": rolled("4 hours", CANDLE_WIDTH),
    "ohlc_rollup_12h": rolled("12 hours", CANDLE_WIDTH),
    "ohlc_rollup_1d": rolled("1 day", CANDLE_WIDTH),
    "dedupe_candles": dedupe_candles,
    "backfill_merge": backfill_merge,
    "candle_messages": candle_messages,
    "latest_message_per_symbol": latest_message_per_symbol,
    "latest_candle_per_symbol": latest_candle_per_symbol,
    "history_slice": history_slice,
    "history_summary": history_summary,
    "history_display": history_display,
    "hour_range_slice": hour_range_slice,
    "ohlc_invariant_violations": ohlc_invariant_violations,
    "ohlc_invariant_rows": ohlc_invariant_rows,
    "candle_gaps": candle_gaps,
    "candle_gap_count": candle_gap_count,
    "missing_hours": missing_hours,
    "expired_partitions": expired_partitions,
    "compaction_report": compaction_report,
    "lake_backfill": lake_backfill,
    "gold_candles": gold_candles,
    "stream_closed_candles": stream_closed_candles,
    "stream_live_candles": stream_live_candles,
    "stream_ingest": stream_ingest,
    "stream_rejects": stream_rejects,
    "stream_bronze_archive": stream_bronze_archive,
    "retention_drop": retention_drop,
    "event_rejects": event_rejects,
    "kline_rejects": kline_rejects,
    "history_lake": history_lake,
    "missing_hours_lake": missing_hours_lake,
    "ingest_lag_approx": ingest_lag_approx,
    "repeated_batch": repeated_batch,
    "stream_late_rows": stream_late_rows,
    "stream_distinct_trades": stream_distinct_trades,
    "stream_distinct_candles": stream_distinct_candles,
    "stream_late_trades": stream_late_trades,
    "stream_amended_candles": stream_amended_candles,
    "partial_merge": partial_merge,
    "stream_rollup": stream_rollup,
    "stream_open_candles": stream_open_candles,
    "lag_sketch_quantiles": lag_sketch_quantiles,
    "partition_routing_balanced": partition_routing_balanced,
    "replayed_hours": replayed_hours,
    "source_differences": source_differences,
}


def in_utc(query: Query) -> Query:
    """Plan with the UTC session the lake's dates and hours are defined in; the caller's zone comes back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            result = query(spark, sf_dir)
            result.schema  # analysed, so that its expressions have their zone
            return result
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    return run
