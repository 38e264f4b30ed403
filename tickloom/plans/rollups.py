"""Gold: coarser candles from compacted ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tickloom.functions import width_seconds
from tickloom.operators import rollup_candles
from tickloom.sources.lake import HourRange, Lake

# Resolutions kept in gold by default.
RESOLUTIONS = ("5m", "15m", "1h")
SILVER_RESOLUTION = "1m"


def finest_first(resolutions: tuple[str, ...]) -> dict[str, str]:
    """Each resolution with the coarsest one before it that divides it evenly."""
    sources = {}
    done = [SILVER_RESOLUTION]
    for label in sorted(resolutions, key=width_seconds):
        width = width_seconds(label)
        sources[label] = max((d for d in done if width % width_seconds(d) == 0), key=width_seconds)
        done.append(label)
    return sources


def rollup(
    spark: SparkSession,
    lake: Lake,
    hours: HourRange,
    resolutions: tuple[str, ...] = RESOLUTIONS,
) -> dict[str, int]:
    """Write the hours' candles in every resolution; returns the rows each now has there.

    Resolutions cascade: 15m is built from the 5m rows just written and 1h
    from 15m, so the 1m table is scanned once. Windows longer than an hour
    widen the range to whole windows.
    """
    written = {}
    longest = max(width_seconds(label) for label in resolutions)
    # one range for all, so every cascade source covers its consumer's windows
    span = lake.span(hours.aligned(longest))
    for label, source in finest_first(resolutions).items():
        candles = lake.candles(source).read(spark, span)
        rolled = rollup_candles(candles, f"{width_seconds(label)} seconds")
        gold = lake.gold(label)
        gold.replace_partitions(rolled, sort_by=("symbol", "window_start"))
        # counted from the files' footers: exact even if tasks were retried
        written[label] = gold.read(spark, span).count()
    return written
