"""OHLC candles from trades, and coarser candles from candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tickloom.functions import interval, width_seconds
from tickloom.schemas import AMOUNT_TYPE, CANDLE_VALUES


def build_candles(
    trades: DataFrame,
    width: str = "1 minute",
    watermark: str | None = None,
    tie_breakers: tuple[str, ...] = ("trade_id",),
    trade_ids_below: int | None = None,
) -> DataFrame:
    """One row per tumbling window and symbol; the same function for batch and stream.

    Open and close are the prices of the least and greatest tick, a tick being
    (trade_time, tie_breakers..., price), so they do not depend on arrival
    order. All aggregates combine on the map side: a window or symbol holding
    most of the input costs one row per map task in the shuffle.

    Struct extremes sort before they aggregate. Batch therefore groups by the
    window start, a plain long to sort on, and derives the end afterwards; a
    stream has to group by the window struct, which carries the watermark.

    ``trade_ids_below`` states that trade ids are from zero up to that bound
    and that equal ids of a symbol are copies of one trade. Ticks then fit one
    long and nothing is sorted. A row outside the bound fails the job rather
    than giving a wrong candle.
    """
    grouped, measures = _grouped_trades(trades, width, watermark, tie_breakers, trade_ids_below)
    start, end = ("w.start", F.col("w.end")) if trades.isStreaming else ("w", F.col("w") + interval(width))
    return grouped.agg(*measures).select(F.col(start).alias("window_start"), end.alias("window_end"), "symbol", *CANDLE_VALUES)


def _grouped_trades(trades: DataFrame, width: str, watermark: str | None, tie_breakers: tuple[str, ...], trade_ids_below: int | None) -> tuple[GroupedData, list[Column]]:
    """Trades by window ``w`` and symbol, and the measures of a candle."""
    streaming = trades.isStreaming
    if watermark is not None:
        trades = trades.withWatermark("trade_time", watermark)
    window = F.window("trade_time", width)
    if trade_ids_below is None:
        tick = F.struct("trade_time", *tie_breakers, "price")
        opening, closing = F.min(tick)["price"], F.max(tick)["price"]
    else:
        tick = _packed_tick(width, trade_ids_below)
        opening, closing = F.min_by("price", "tick"), F.max_by("price", "tick")
        trades = trades.withColumn("tick", tick)
    measures = {
        "open": opening,
        "high": F.max("price"),
        "low": F.min("price"),
        "close": closing,
        "volume": F.sum("quantity").cast(AMOUNT_TYPE),
        "quote_volume": F.sum(F.col("price") * F.col("quantity")).cast(AMOUNT_TYPE),
        "trade_count": F.count("*"),
    }
    grouped = trades.withColumn("w", window if streaming else window.start).groupBy("w", "symbol")
    return grouped, [column.alias(name) for name, column in measures.items()]


def _packed_tick(width: str, ids_below: int) -> Column:
    """Microseconds into the window, then the trade id, in one long."""
    id_bits = (ids_below - 1).bit_length()
    if (width_seconds(width) * 1_000_000 - 1).bit_length() + id_bits > 63:
        raise ValueError(f"ticks of a {width} window with ids below {ids_below} do not fit a long")
    micros = F.pmod(F.unix_micros(F.col("trade_time").cast("timestamp")), F.lit(width_seconds(width) * 1_000_000))
    known = F.col("trade_id").between(0, ids_below - 1)
    return F.when(known, micros * (1 << id_bits) + F.col("trade_id")).when(
        F.col("trade_time").isNotNull(), F.raise_error(F.lit(f"trade id missing or not in [0, {ids_below})"))
    )


def rollup_candles(candles: DataFrame, width: str) -> DataFrame:
    """Candles of ``width`` from narrower ones.

    ``window_start`` must be unique per symbol (see ``dedupe_candles``), which
    makes min_by/max_by exact; all buffers are fixed-size, so this is a plain
    hash aggregation. Windows are aligned to 1970-01-01T00:00Z, and ``width``
    must be a multiple of the input width.
    """
    return (
        candles.withColumn("bucket", F.window("window_start", width).start)
        .groupBy("bucket", "symbol")
        .agg(*_rolled("window_start"))
        .select(
            F.col("bucket").alias("window_start"),
            (F.col("bucket") + interval(width)).alias("window_end"),
            "symbol",
            *CANDLE_VALUES,
        )
    )


def _rolled(time: str) -> list[Column]:
    """The measures of a coarser candle; ``time`` tells the narrower ones apart."""
    return [
        F.min_by("open", time).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", time).alias("close"),
        F.sum("volume").cast(AMOUNT_TYPE).alias("volume"),
        F.sum("quote_volume").cast(AMOUNT_TYPE).alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    ]


def chained_rollups(
    trades: DataFrame, widths: tuple[str, ...], watermark: str, trade_ids_below: int | None = None
) -> DataFrame:
    """Candles of the last of ``widths`` from a stream of trades, each width rolled up from the one before.

    One append query with an aggregation for every width: the watermark closes
    a window of the first, whose end time carries it into the next, so the state
    of a coarse window is one row a symbol, never its trades. Each width must be
    a multiple of the one before. Batch input gives the same candles, those of
    windows that a stream would still hold open included.
    """
    for fine, coarse in zip(widths, widths[1:], strict=False):
        if width_seconds(coarse) % width_seconds(fine):
            raise ValueError(f"{coarse} is not a multiple of {fine}")
    if not trades.isStreaming:
        rolled = build_candles(trades, widths[0], trade_ids_below=trade_ids_below)
        for width in widths[1:]:
            rolled = rollup_candles(rolled, width)
        return rolled
    grouped, measures = _grouped_trades(trades, widths[0], watermark, ("trade_id",), trade_ids_below)
    rolled = grouped.agg(*measures)
    for width in widths[1:]:
        # the end of a window is the event time that the next aggregation's watermark is about
        timed = rolled.withColumn("at", F.window_time("w")).drop("w")
        rolled = timed.groupBy(F.window("at", width).alias("w"), "symbol").agg(*_rolled("at"))
    return rolled.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", *CANDLE_VALUES)
