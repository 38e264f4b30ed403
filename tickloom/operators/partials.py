"""Candles in parts that can be put together: what late or split trades add to a candle without its trades being read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import interval
from tickloom.schemas import AMOUNT_TYPE, CANDLE_SCHEMA

_SUMS = ("volume", "quote_volume")


def _merged(columns: dict[str, Column]) -> list[Column]:
    """One part out of several: the least and greatest tick, the bounds, the sums."""
    return [
        F.min(columns["first"]).alias("first"),
        F.max(columns["last"]).alias("last"),
        F.max(columns["high"]).alias("high"),
        F.min(columns["low"]).alias("low"),
        *[F.sum(columns[c]).cast(AMOUNT_TYPE).alias(c) for c in _SUMS],
        F.sum(columns["trade_count"]).alias("trade_count"),
    ]


def partial_candles(trades: DataFrame, width: str = "1 minute", by: tuple[str, ...] = ()) -> DataFrame:
    """A part of a candle for each window and symbol (and ``by``) of these trades.

    A part keeps the ticks that open and close it, (trade_time, trade_id,
    price), so that parts of any split of the trades, merged in any order, give
    the candle of all of them. One row is a part too: trades take the same
    aggregates as parts do.
    """
    tick = F.struct("trade_time", "trade_id", "price")
    one = {
        "first": tick,
        "last": tick,
        "high": F.col("price"),
        "low": F.col("price"),
        "volume": F.col("quantity"),
        "quote_volume": F.col("price") * F.col("quantity"),
        "trade_count": F.lit(1).cast("long"),
    }
    grouped = trades.withColumn("window_start", F.window("trade_time", width).start).groupBy("window_start", "symbol", *by)
    return grouped.agg(*_merged(one)).withColumn("window_end", F.col("window_start") + interval(width))


def merge_partials(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One part for each window and symbol (and ``by``); associative and commutative, combined on the map side."""
    names = ("first", "last", "high", "low", *_SUMS, "trade_count")
    return parts.groupBy("window_start", "window_end", "symbol", *by).agg(*_merged({c: F.col(c) for c in names}))


def finish_partials(parts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Candles from parts, those of one window merged first."""
    merged = merge_partials(parts, by).withColumns({"open": F.col("first.price"), "close": F.col("last.price")})
    return merged.select(*CANDLE_SCHEMA.fieldNames(), *by)


def distinct_trades(trades: DataFrame, within: str | None = None) -> DataFrame:
    """One row for each (symbol, trade_id), however often it was delivered.

    In a stream the first copy to arrive passes at once, and its key is kept for
    ``within`` of event time. A copy that comes even later is behind the
    watermark of the same delay: it is dropped as late, so no trade counts
    twice. In a batch all copies are met; of unequal ones the smallest stays, and
    no more than one row per group and map task is shuffled. Rows without a
    symbol or id have no identity: nulls are one key like any other.
    """
    keys = ["symbol", "trade_id"]
    if trades.isStreaming:
        if within is None:
            raise ValueError("a stream keeps the keys of trades for a stated time")
        return trades.withWatermark("trade_time", within).dropDuplicatesWithinWatermark(keys)
    order = [F.col(c).asc_nulls_last() for c in trades.columns if c not in keys]
    copies = Window.partitionBy(*keys).orderBy(*order)
    return trades.withColumn("rn", F.row_number().over(copies)).filter("rn = 1").drop("rn")
