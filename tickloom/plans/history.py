"""Reading the recent candles of one symbol from the lake."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import width_seconds
from tickloom.operators import candle_history
from tickloom.sources.lake import HourRange, Lake, Table


def newest_day(spark: SparkSession, table: Table, symbol: str) -> datetime | None:
    """The last day with rows of the symbol, from folder names where they carry the symbol.

    Other tables are searched backwards, each step over twice the days of the
    one before, until one has a row.
    """
    days = sorted(day for day, _ in table.day_folders(spark, symbol))
    if not days:
        return None
    if "symbol" in table.partition_by:
        return datetime.combine(days[-1], time())
    last, step = len(days), 1
    while last > 0:
        some = days[max(0, last - step) : last]
        hours = HourRange(datetime.combine(some[0], time()), datetime.combine(some[-1], time()) + timedelta(days=1))
        found = table.read(spark, hours, symbol).agg(F.max("dt")).first()[0]
        if found is not None:
            return datetime.combine(found, time())
        last, step = last - len(some), step * 2
    return None


def lake_history(spark: SparkSession, lake: Lake, symbol: str, label: str = "1m", within: str = "6 hours", limit: int = 120) -> DataFrame:
    """:func:`candle_history` over the last days of the symbol only; every scan is bounded by day."""
    table = lake.candles(label)
    day = newest_day(spark, table, symbol)
    if day is None:
        return candle_history(table.read(spark).limit(0), symbol, within, limit)
    hours = HourRange(day - timedelta(seconds=width_seconds(within)), day + timedelta(days=1))
    return candle_history(table.read(spark, hours, symbol), symbol, within, limit)
