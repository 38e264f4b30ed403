"""The streaming jobs: ingest, raw archive, rejects, closed candles, live candles.

Each is an independent query with its own checkpoint, so one can fail, be
restarted or resized without the others. Each takes a stream of messages, from
whatever source, and a trigger as keyword arguments of ``trigger``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import (
    build_candles,
    candle_messages,
    chained_rollups,
    decode_trades,
    distinct_trades,
    keep_symbols,
    split_events,
    split_trades,
    trade_messages,
)
from tickloom.sources.lake import Lake, Table
from tickloom.streaming.sinks import FileTopic, KafkaTopic, batch_writer, parts_writer

# Default window, watermark and triggers.
WINDOW = "1 minute"
WATERMARK = "10 seconds"
STORE_TRIGGER = {"processingTime": "30 seconds"}
LIVE_TRIGGER = {"processingTime": "2 seconds"}


def start_ingest(
    events: DataFrame,
    topic: KafkaTopic | FileTopic,
    checkpoint: str,
    symbols: list[str],
    partitions: int,
    trigger: dict = LIVE_TRIGGER,
) -> StreamingQuery:
    """Turn exchange events (``value``) into trade messages of the listed symbols.

    Each message is stamped with its ingest time and routed by the position of
    its symbol in the list. Events without a field that a candle needs are what
    :func:`start_event_rejects` archives.
    """
    usable, _ = split_events(events)
    trades = keep_symbols(usable, symbols)
    stamped = trades.withColumn("ingested_at_ms", F.unix_millis(F.current_timestamp()))
    return (
        topic.attach(trade_messages(stamped, symbols, partitions))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_bronze(
    messages: DataFrame, lake: Lake, checkpoint: str, trigger: dict = STORE_TRIGGER, distinct_within: str | None = None
) -> StreamingQuery:
    """Archive every usable trade, partitioned by symbol and time.

    Delivery is at least once: with ``distinct_within`` a trade whose id was
    seen that long ago or less, in event time, is not archived again.
    """
    valid, _ = split_trades(decode_trades(messages))
    if distinct_within is not None:
        valid = distinct_trades(valid, distinct_within)
    return _landed(valid, lake.trades, "trade_time", checkpoint, trigger)


def start_rejects(messages: DataFrame, lake: Lake, checkpoint: str, trigger: dict = STORE_TRIGGER) -> StreamingQuery:
    """Archive the messages bronze leaves out, as received, with the reason."""
    _, rejects = split_trades(decode_trades(messages, keep=("value",)))
    return _landed(_stamped(rejects), lake.rejects("trades"), "rejected_at", checkpoint, trigger)


def start_event_rejects(events: DataFrame, lake: Lake, checkpoint: str, trigger: dict = STORE_TRIGGER) -> StreamingQuery:
    """Archive the exchange events ingest cannot turn into a trade message."""
    _, rejects = split_events(events)
    return _landed(_stamped(rejects), lake.rejects("events"), "rejected_at", checkpoint, trigger)


def _stamped(rejects: DataFrame) -> DataFrame:
    """In a stream the current time is the batch's, the same when the batch is run again."""
    return rejects.selectExpr("reason", "cast(value as string) AS value", "current_timestamp() AS rejected_at")


def _landed(rows: DataFrame, table: Table, time_column: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Append each batch to the table in folders of its own."""
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(batch_writer(table, time_column))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_silver(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    width: str = WINDOW,
    watermark: str = WATERMARK,
    trigger: dict = STORE_TRIGGER,
    trade_ids_below: int | None = None,
    distinct: bool = False,
) -> StreamingQuery:
    """Store each candle once, after the watermark has passed its end.

    With ``distinct`` each trade counts once, however often it was delivered:
    its id is kept for as long as its candle is open, and a copy that comes
    later still is late for the candle too.
    """
    valid, _ = split_trades(decode_trades(messages))
    if distinct:
        # the candles go by the same watermark
        candles = build_candles(distinct_trades(valid, watermark), width, trade_ids_below=trade_ids_below)
    else:
        candles = build_candles(valid, width, watermark, trade_ids_below=trade_ids_below)
    return _landed(candles, lake.streamed, "window_start", checkpoint, trigger)


def start_parts(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    width: str = WINDOW,
    delay: str = WATERMARK,
    trigger: dict = STORE_TRIGGER,
) -> StreamingQuery:
    """Store parts of candles batch by batch; trades behind their symbol's clock are kept apart and marked.

    Nothing is dropped: every usable trade is in one part, and late ones are
    rows of ``lake.late`` besides. ``amended_candles`` puts the parts together.
    """
    valid, _ = split_trades(decode_trades(messages))
    return (
        valid.writeStream.outputMode("append")
        .foreachBatch(parts_writer(lake, width, delay))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_rollup(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    label: str,
    widths: tuple[str, ...],
    watermark: str = WATERMARK,
    trigger: dict = STORE_TRIGGER,
) -> StreamingQuery:
    """Store candles of the last of ``widths``, rolled up through the others inside one stream."""
    valid, _ = split_trades(decode_trades(messages))
    return _landed(chained_rollups(valid, widths, watermark), lake.streamed_gold(label), "window_start", checkpoint, trigger)


def start_live(
    messages: DataFrame,
    topic: KafkaTopic | FileTopic,
    checkpoint: str,
    width: str = WINDOW,
    watermark: str = WATERMARK,
    trigger: dict = LIVE_TRIGGER,
    trade_ids_below: int | None = None,
) -> StreamingQuery:
    """Publish every candle again whenever a batch changed it."""
    valid, _ = split_trades(decode_trades(messages))
    return (
        topic.attach(candle_messages(build_candles(valid, width, watermark, trade_ids_below=trade_ids_below)))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
