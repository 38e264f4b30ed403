"""Historical candle pages of the exchange, decoded into candle rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.decode import MAX_MS
from tickloom.schemas import CANDLE_SCHEMA, CANDLE_VALUES

# Positions inside one kline array; later ones are not used.
KLINE_POSITIONS = {
    "window_start": 0,
    "open": 1,
    "high": 2,
    "low": 3,
    "close": 4,
    "volume": 5,
    "window_end": 6,
    "quote_volume": 7,
    "trade_count": 8,
}


def decode_klines(pages: DataFrame, page: str = "page", keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages (``symbol``, JSON array of kline arrays) to candles.

    A page is one request's answer (at most 1000 klines), so exploding it is
    bounded. Prices go from text to decimal directly, without a float between.
    The close time is the last millisecond of the window. A page that cannot be
    read, and a kline without usable times, come out with nulls rather than
    vanish or fail the job; :func:`split_klines` separates those. ``kline`` may
    be kept: the array as JSON, or the unreadable page.
    """
    types = {f.name: f.dataType for f in CANDLE_SCHEMA}

    def item(name: str) -> Column:
        return F.get("k", F.lit(KLINE_POSITIONS[name]))

    def moment(name: str, add: int) -> Column:
        ms = item(name).try_cast("long")
        return F.when(ms.between(-MAX_MS, MAX_MS), F.timestamp_millis(F.when(ms.between(-MAX_MS, MAX_MS), ms) + add))

    klines = F.from_json(F.col(page).cast("string"), "array<array<string>>")
    unreadable = F.array(F.lit(None).cast("array<string>"))
    return (
        pages.select("symbol", F.col(page).cast("string").alias("page"), F.explode(F.coalesce(klines, unreadable)).alias("k"))
        .withColumn("kline", F.coalesce(F.to_json("k"), "page"))
        .select(
            moment("window_start", 0).alias("window_start"),
            moment("window_end", 1).alias("window_end"),
            "symbol",
            *[item(name).try_cast(types[name]).alias(name) for name in CANDLE_VALUES],
            *keep,
        )
    )


def kline_reject_reason() -> Column:
    """What a decoded kline lacks, null for a usable one."""
    values = [name for name in CANDLE_SCHEMA.fieldNames() if name != "symbol"]
    nothing = F.coalesce(*[F.col(c).cast("string") for c in values]).isNull()
    reason = F.when(F.col("symbol").isNull(), "bad_symbol").when(nothing, "malformed_kline")
    for name in values:
        reason = reason.when(F.col(name).isNull(), f"bad_{name}")
    return reason


def split_klines(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole candles, and rejects with a ``reason``; every decoded row is in one of them."""
    tagged = decoded.withColumn("reason", kline_reject_reason())
    return tagged.filter("reason IS NULL").drop("reason"), tagged.filter("reason IS NOT NULL")
