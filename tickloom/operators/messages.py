"""Rows as keyed JSON messages, ready for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.routing import route_symbols
from tickloom.schemas import TRADE_MESSAGE_SCHEMA


def candle_messages(candles: DataFrame) -> DataFrame:
    """``key`` = symbol, ``value`` = the whole row as JSON."""
    return candles.select(F.col("symbol").alias("key"), F.to_json(F.struct("*")).alias("value"))


def trade_messages(
    events: DataFrame, symbols: list[str] | None = None, partitions: int | None = None
) -> DataFrame:
    """Normalized events as trade messages, with an explicit ``partition`` when routed."""
    fields = [name for name in TRADE_MESSAGE_SCHEMA.fieldNames() if name in events.columns]
    columns = [F.col("symbol").alias("key"), F.to_json(F.struct(*fields)).alias("value")]
    if symbols is not None and partitions is not None:
        events = route_symbols(events, symbols, partitions)
        columns.append(F.col("partition"))
    return events.select(*columns)
