"""Read side: newest candle, recent history and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import CANDLE_VALUES

HISTORY_COLUMNS = ("window_start", "symbol", "open", "high", "low", "close", "volume", "trade_count")


def latest_candles(candles: DataFrame) -> DataFrame:
    """The newest candle of each symbol, from candles unique per window.

    One fixed-size buffer per column keeps this a hash aggregation with one
    row per symbol and map task in the shuffle.
    """
    newest = [F.max_by(c, "window_start").alias(c) for c in ("window_end", *CANDLE_VALUES)]
    return candles.groupBy("symbol").agg(F.max("window_start").alias("window_start"), *newest)


def latest_messages(messages: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """The newest candle message of each symbol; a later offset wins a tie.

    Window starts are compared as the ISO text they arrive as. All messages of
    a symbol share its key and so a topic partition, which makes the offset a
    total order per symbol. Works on a batch read of the topic and, in update
    mode, on a stream of it.
    """
    head = F.from_json(F.col(value).cast("string"), "symbol string, window_start string")
    newest = F.max_by("value", F.struct("window_start", "offset"))
    return (
        messages.select(head.alias("m"), F.col(offset).alias("offset"), F.col(value).cast("string").alias("value"))
        .select("m.symbol", "m.window_start", "offset", "value")
        .filter("symbol IS NOT NULL AND window_start IS NOT NULL")
        .groupBy("symbol")
        .agg(F.max("window_start").alias("window_start"), newest.alias("value"))
    )


def candle_history(
    candles: DataFrame, symbol: str, within: str = "6 hours", limit: int = 120
) -> DataFrame:
    """The most recent ``limit`` candles of a symbol, oldest first.

    Only candles within ``within`` of the symbol's newest one count, so that
    leftovers of earlier sessions stay out. On a lake table the symbol filter
    prunes partitions, and a bound on ``dt`` derived from the newest candle
    prunes days.
    """
    own = candles.filter(F.col("symbol") == symbol)
    since = own.agg(F.max("window_start") - F.expr(f"INTERVAL {within}")).scalar()
    recent = own.filter(F.col("window_start") >= since)
    if "dt" in candles.columns:
        recent = recent.filter(F.col("dt") >= F.to_date(since))
    return recent.select(*HISTORY_COLUMNS).orderBy(F.desc("window_start")).limit(limit).orderBy("window_start")


def history_summary(history: DataFrame) -> DataFrame:
    """Candles loaded and the trades they hold."""
    return history.agg(
        F.count("*").alias("candles"), F.coalesce(F.sum("trade_count"), F.lit(0)).alias("trades")
    )
