"""Ingest lag over any span, from sketches kept by the minute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import lag_quantiles, lag_sketches, merge_lag_sketches
from tickloom.schemas import LAG_SCHEMA, conform
from tickloom.sources.lake import HourRange, Lake


def store_lag(spark: SparkSession, lake: Lake, hours: HourRange) -> None:
    """Sketch the archived trades of the hours' folders; a repeated run replaces its own."""
    sketches = lag_sketches(lake.trades.read(spark, lake.span(hours)))
    lake.lag.replace_partitions(sketches, sort_by=("window_start",))


def lag_report(
    spark: SparkSession, lake: Lake, width: str, hours: HourRange | None = None, by: tuple[str, ...] = ("symbol",), quantiles: dict[str, float] | None = None
) -> DataFrame:
    """Lag quantiles of wider windows: as many rows are read as there were minutes with trades."""
    kept = conform(lake.lag.read(spark, hours), LAG_SCHEMA)
    return lag_quantiles(merge_lag_sketches(kept, width, by), quantiles)
