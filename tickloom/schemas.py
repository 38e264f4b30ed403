"""Row shapes of the lake, and the one cast every writer goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and types of the trade message on the wire.
TRADE_MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("trade_time_ms", T.LongType()),
        T.StructField("event_time_ms", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at_ms", T.LongType()),
    ]
)

PRICE_TYPE = T.DecimalType(18, 8)
AMOUNT_TYPE = T.DecimalType(38, 8)

# Columns of a Kafka record as Spark's Kafka source presents them; file
# stand-ins for a topic are stored in this shape.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

TRADE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", PRICE_TYPE),
        T.StructField("quantity", PRICE_TYPE),
        T.StructField("trade_time_ms", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at_ms", T.LongType()),
        T.StructField("trade_time", T.TimestampType()),
    ]
)

CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open", PRICE_TYPE),
        T.StructField("high", PRICE_TYPE),
        T.StructField("low", PRICE_TYPE),
        T.StructField("close", PRICE_TYPE),
        T.StructField("volume", AMOUNT_TYPE),
        T.StructField("quote_volume", AMOUNT_TYPE),
        T.StructField("trade_count", T.LongType()),
    ]
)

TICK_TYPE = T.StructType(
    [
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("trade_id", T.LongType()),
        T.StructField("price", PRICE_TYPE),
    ]
)

# a part of a candle; ``late``: from trades that came in behind their symbol's clock
PART_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("first", TICK_TYPE),
        T.StructField("last", TICK_TYPE),
        T.StructField("high", PRICE_TYPE),
        T.StructField("low", PRICE_TYPE),
        T.StructField("volume", AMOUNT_TYPE),
        T.StructField("quote_volume", AMOUNT_TYPE),
        T.StructField("trade_count", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)

# the newest trade time of each symbol that a stream has seen
CLOCK_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("newest", T.TimestampType()),
    ]
)

LAG_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trades", T.LongType()),
        T.StructField("min_lag_ms", T.LongType()),
        T.StructField("max_lag_ms", T.LongType()),
        T.StructField("sum_lag_ms", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
    ]
)

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
    ]
)

CANDLE_VALUES = ("open", "high", "low", "close", "volume", "quote_volume", "trade_count")

PARTITION_FIELDS = {
    "dt": T.StructField("dt", T.DateType()),
    "hour": T.StructField("hour", T.IntegerType()),
    "query_id": T.StructField("query_id", T.StringType()),
    "batch_id": T.StructField("batch_id", T.LongType()),
    "run_id": T.StructField("run_id", T.StringType()),
}


def conform(df: DataFrame, schema: T.StructType = CANDLE_SCHEMA, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select and cast to ``schema`` so all writers of a table agree on types.

    Parquet files with different decimal scales in one folder cannot be read
    together, so every write goes through this.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], *keep)


def with_partitions(schema: T.StructType, partition_by: tuple[str, ...]) -> T.StructType:
    """``schema`` extended by the partition columns it does not hold yet."""
    extra = [PARTITION_FIELDS[c] for c in partition_by if c not in schema.fieldNames()]
    return T.StructType(list(schema.fields) + extra)
