"""Candle checks: broken invariants, gaps in time, hours without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import boundaries_between, unit_index, width_seconds
from tickloom.schemas import CANDLE_VALUES

# What a sound candle must not show.
INVARIANT_RULES = {
    "high_below_open": "high < open",
    "high_below_close": "high < close",
    "high_below_low": "high < low",
    "low_above_open": "low > open",
    "low_above_close": "low > close",
    "volume_not_positive": "volume <= 0",
    "no_trades": "trade_count <= 0",
}

# Units per gap bucket: a day of minutes. With unique candles a bucket holds
# at most this many rows of one symbol.
_BUCKET_UNITS = 1440


def _broken() -> Column:
    return F.expr(" OR ".join(INVARIANT_RULES.values()))


def invariant_violations(candles: DataFrame) -> DataFrame:
    """Offending candles with the names of the rules they break."""
    names = F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in INVARIANT_RULES.items()])
    return candles.filter(_broken()).withColumn("broken_rules", F.array_compact(names))


def invariant_report(candles: DataFrame) -> DataFrame:
    """One row: violating candles, one count per rule, and candles with a null value.

    Comparisons with null are unknown and therefore not violations;
    ``null_values`` reports those candles separately.
    """
    missing = F.lit(False)
    for name in ("symbol", "window_start", *CANDLE_VALUES):
        missing = missing | F.col(name).isNull()
    return candles.agg(
        F.count("*").alias("candles"),
        F.count_if(_broken()).alias("violations"),
        *[F.count_if(F.expr(rule)).alias(name) for name, rule in INVARIANT_RULES.items()],
        F.count_if(missing).alias("null_values"),
    )


def candle_gaps(candles: DataFrame, unit: str = "1 minute") -> DataFrame:
    """Consecutive candles of a symbol more than one ``unit`` boundary apart.

    Equivalent to ``lag`` over each whole symbol, without putting a symbol
    into one task. Time is cut into buckets of 1440 units; a bucket's different
    starts are one array, and only one row per (symbol, bucket) meets in the
    window that looks back across buckets. The input is read once.
    """
    seconds = width_seconds(unit)
    buckets = (
        candles.filter("window_start IS NOT NULL")
        .groupBy("symbol", unit_index(F.col("window_start"), seconds * _BUCKET_UNITS).alias("bucket"))
        .agg(F.sort_array(F.collect_set("window_start")).alias("starts"))
    )
    in_order = Window.partitionBy("symbol").orderBy("bucket")
    before = F.lag(F.element_at("starts", -1)).over(in_order)
    pairs = F.arrays_zip(F.concat(F.array("before"), F.slice("starts", 1, F.size("starts") - 1)).alias("previous_start"), F.col("starts").alias("window_start"))
    crossed = boundaries_between(F.col("previous_start"), F.col("window_start"), seconds)
    return (
        buckets.withColumn("before", before)
        .select("symbol", F.inline(pairs))
        .withColumn("missing", crossed - 1)
        .filter("previous_start IS NOT NULL AND missing > 0")
    )


def summarize_gaps(gaps: DataFrame) -> DataFrame:
    """One row: number of gaps and of absent candles inside them."""
    return gaps.agg(F.count("*").alias("gaps"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"))


def gap_count(candles: DataFrame, unit: str = "1 minute") -> DataFrame:
    """:func:`candle_gaps`, summarized."""
    return summarize_gaps(candle_gaps(candles, unit))


def missing_hours(
    candles: DataFrame,
    symbols: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """(symbol, hour_start) without any candle, the worklist of a backfill.

    Hours run from ``start`` up to and including ``end`` for every row of
    ``symbols``; without bounds, over each symbol's own first to last hour.
    The grid is generated per symbol row, not by a cross join.
    """
    present = candles.select("symbol", F.date_trunc("hour", "window_start").alias("hour_start")).distinct()
    first, last = F.min("hour_start"), F.max("hour_start")
    if symbols is None:
        bounds = present.groupBy("symbol").agg(first.alias("first"), last.alias("last"))
    else:
        seen = present.groupBy("symbol").agg(first.alias("first"), last.alias("last"))
        bounds = symbols.select("symbol").distinct().join(seen, "symbol", "left")
    kind = present.schema["hour_start"].dataType
    if start is not None:
        bounds = bounds.withColumn("first", F.date_trunc("hour", F.lit(start).cast(kind)).cast(kind))
    if end is not None:
        bounds = bounds.withColumn("last", F.date_trunc("hour", F.lit(end).cast(kind)).cast(kind))
    grid = bounds.filter("first <= last").select(
        "symbol", F.explode(F.expr("sequence(first, last, INTERVAL 1 HOUR)")).alias("hour_start")
    )
    return grid.join(present, ["symbol", "hour_start"], "left_anti")
