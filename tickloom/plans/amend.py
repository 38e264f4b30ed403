"""Candles put together from stored parts, late trades included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import finish_partials, merge_sources
from tickloom.schemas import PART_SCHEMA, conform
from tickloom.sources.lake import HourRange, Lake


def amended_candles(spark: SparkSession, lake: Lake, hours: HourRange | None = None, late: bool = True) -> DataFrame:
    """Candles of the stored parts: a late part changes its candle, and no trade is read again.

    Without ``late`` they are the candles as they were when their symbol's clock
    passed them. The parts of a candle are as many as batches had trades of it,
    and they are merged on the map side.
    """
    parts = conform(lake.parts.read(spark, hours and lake.span(hours)), PART_SCHEMA)
    return finish_partials(parts if late else parts.filter(~F.col("late")))


def amend(spark: SparkSession, lake: Lake, hours: HourRange) -> None:
    """Rewrite the compacted folders of ``hours`` that late parts fall into.

    Only folders that hold a late part are touched. Their candles are those of
    all parts, met with streamed and backfilled ones as in compaction, so a
    repeated run writes the same.
    """
    span = lake.span(hours)
    folder = list(lake.compacted.partition_by)
    parts = lake.parts.read(spark, span)
    touched = parts.filter("late").select(*folder).distinct()
    sources = {
        "parts": finish_partials(conform(parts.join(touched, folder, "left_semi"), PART_SCHEMA)),
        "stream": conform(lake.streamed.read(spark, span).join(touched, folder, "left_semi")),
        "backfill": conform(lake.backfilled.read(spark, span).join(touched, folder, "left_semi")),
    }
    lake.compacted.replace_partitions(merge_sources(sources), sort_by=("window_start",))
