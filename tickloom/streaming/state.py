"""What a stream still holds: open candles, read from the state of a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import AMOUNT_TYPE, CANDLE_SCHEMA, PRICE_TYPE, TICK_TYPE

# Buffers of the candle aggregates in their order: a sum has a flag, an extreme by another column has both columns.
_PRICE = PRICE_TYPE.simpleString()
_SUMS = "volume decimal(38,8), no_volume boolean, quote_volume decimal(38,16), no_quote_volume boolean, trade_count bigint"
_TICK = f"{TICK_TYPE.simpleString()}"
_BY_TICK = f"first {_TICK}, high {_PRICE}, low {_PRICE}, last {_TICK}, {_SUMS}"
_BY_PACKED = f"open {_PRICE}, first_tick bigint, high {_PRICE}, low {_PRICE}, close {_PRICE}, last_tick bigint, {_SUMS}"


def open_candles(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Candles that the query of a checkpoint has not closed yet, as of its last finished batch.

    Reads the state store, not the trades: as many rows as there are open
    windows. Works for a query of :func:`start_silver` or :func:`start_live`,
    running or stopped, with or without distinct trades. An open candle may
    still change.
    """
    held = spark.read.format("state-metadata").load(checkpoint)
    # one aggregation; a query of distinct trades has the trade keys as another operator
    operator = held.filter("operatorName = 'stateStoreSave'").select("operatorId").first()
    if operator is None:
        raise ValueError(f"no candles are kept in {checkpoint}")
    state = spark.read.format("statestore").option("operatorId", operator.operatorId).load(checkpoint)
    fields = state.schema["value"].dataType.fields
    packed = len(fields) == _BY_PACKED.count(", ") + 1
    # buffers have no names of their own: a cast of a struct goes by position
    buffers = F.col("value").cast(f"struct<{_BY_PACKED if packed else _BY_TICK}>")
    rows = state.select("key.*", buffers.alias("b")).select("w.*", "symbol", "b.*")
    if not packed:
        rows = rows.withColumns({"open": F.col("first.price"), "close": F.col("last.price")})
    amounts = {c: F.when(F.col(f"no_{c}"), F.lit(None)).otherwise(F.col(c)).cast(AMOUNT_TYPE) for c in ("volume", "quote_volume")}
    return rows.withColumnsRenamed({"start": "window_start", "end": "window_end"}).withColumns(amounts).select(CANDLE_SCHEMA.fieldNames())
