"""The benchmark tables viewed as trades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import PRICE_TYPE


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trades(events: DataFrame) -> DataFrame:
    """``events``: event type as symbol, value as price, ``props.k`` as quantity."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("ts").alias("trade_time"),
        F.col("value").cast(PRICE_TYPE).alias("price"),
        F.get_json_object("props", "$.k").cast(PRICE_TYPE).alias("quantity"),
    )


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """``lineitem``: return flag as symbol, ship date as time.

    Order key and line number together are not unique, so ticks are ordered by
    both and then by price.
    """
    return lineitem.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_orderkey").alias("trade_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("trade_time"),
        F.col("l_extendedprice").cast(PRICE_TYPE).alias("price"),
        F.col("l_quantity").cast(PRICE_TYPE).alias("quantity"),
    )
