"""Holes in the candles, filled from archived trades."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import dt_hour
from tickloom.operators import build_candles, distinct_trades
from tickloom.plans.checks import find_missing_hours
from tickloom.plans.compaction import merge_tables
from tickloom.schemas import TRADE_SCHEMA, conform
from tickloom.session import shared_dir
from tickloom.sources.lake import HourRange, Lake


def archived_trades(spark: SparkSession, lake: Lake, worklist: DataFrame, hours: HourRange) -> DataFrame:
    """Archived trades of the (symbol, hour_start) rows of a worklist.

    The worklist is written first. Its rows meet the archive on the archive's
    own folder columns, so they prune the scan at run time: folders of hours
    that are not on the list are not read.
    """
    path = shared_dir(spark, "worklist")
    dt_hour(worklist, "hour_start").write.parquet(path)
    # a condition that holds for all rows, but that the planner takes for a choice of some, as it is
    wanted = spark.read.parquet(path).filter("hour >= 0")
    trades = lake.trades.read(spark, lake.span(hours)).withColumn("hour_start", F.date_trunc("hour", "trade_time"))
    folder = [c for c in ("symbol", "dt", "hour") if c in lake.trades.partition_by]
    return trades.join(wanted.select("hour_start", *folder), [*folder, "hour_start"], "left_semi")


def replay_missing(
    spark: SparkSession, lake: Lake, hours: HourRange, symbols: DataFrame | None = None, width: str = "1 minute", run_id: str | None = None
) -> DataFrame:
    """Build the candles of hours that have none from the archive, and merge them; gives the hours that stay empty.

    ``symbols``: as for :func:`find_missing_hours`. A trade that was archived
    twice counts once. The candles land like those of a backfill run, so a
    repeated run adds nothing that compaction would not settle. Hours without
    archived trades stay on the returned list, the worklist for the exchange's pages.
    """
    run_id = run_id or uuid.uuid4().hex
    worklist = find_missing_hours(spark, lake, hours, symbols)
    trades = conform(archived_trades(spark, lake, worklist, hours), TRADE_SCHEMA)
    candles = build_candles(distinct_trades(trades), width)
    lake.backfilled.replace_partitions(candles.withColumn("run_id", F.lit(run_id)), sort_by=("window_start",))
    landed = dt_hour(lake.backfilled.run(spark, run_id, lake.span(hours)), "window_start").select(*lake.compacted.partition_by).distinct()
    merge_tables(spark, {"stream": lake.streamed, "backfill": lake.backfilled}, lake.compacted, lake.span(hours), landed)
    return find_missing_hours(spark, lake, hours, symbols)
