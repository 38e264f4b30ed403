"""Stream outputs: partitioned candles that survive a retried batch, and topics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions import interval
from tickloom.operators import partial_candles
from tickloom.schemas import MESSAGE_SCHEMA, conform
from tickloom.sources.lake import Lake, Table


def running_query_id(batch: DataFrame) -> str:
    """Id of the query a ``foreachBatch`` frame belongs to, kept in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_writer(
    table: Table, time_column: str = "window_start", query_id: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each batch to folders of its own.

    The folders carry the query's id and the batch id, and only they are
    overwritten, so a batch run twice leaves one copy. The query id belongs to
    the checkpoint: batch ids start over with a new one. Rows of one folder
    meet in one task first, so a batch adds one file per folder, not one per
    shuffle partition. An empty batch writes no folder; probing for emptiness
    first would compute the batch twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _land(table, batch, time_column, query_id or running_query_id(batch), batch_id)

    return write


def _land(table: Table, rows: DataFrame, time_column: str, query_id: str, batch_id: int) -> None:
    owned = rows.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id)})
    table.write_gathered(table.gathered(table.placed(owned, time_column)), sort_by=(time_column,))


def parts_writer(lake: Lake, width: str, delay: str, query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for trades: parts of candles, late trades, and the clock of each symbol.

    A symbol's clock is the newest trade time that earlier batches had of it. A
    trade is late if its window ended ``delay`` or more before that; late trades
    are kept as they are, and their parts are marked. Clocks are the only state:
    one row a symbol, written for each batch and read for the next, so a batch
    that is run again finds the clocks it found before and writes the same. A
    symbol that lags behind others loses nothing to their clocks. Batch ids
    count from 0 without a hole, as Spark numbers the batches of a checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id or running_query_id(batch)
        before = lake.clocks.batch(spark, query, batch_id - 1)
        closed = F.col("newest") - interval(delay)
        ends = F.window("trade_time", width).end
        trades = batch.join(before, "symbol", "left").withColumn("late", F.coalesce(ends <= closed, F.lit(False))).drop("newest").persist()
        try:
            _land(lake.late, trades.filter("late"), "trade_time", query, batch_id)
            _land(lake.parts, partial_candles(trades, width, by=("late",)), "window_start", query, batch_id)
            now = trades.select("symbol", F.col("trade_time").alias("newest")).unionByName(before)
            _land(lake.clocks, now.groupBy("symbol").agg(F.max("newest").alias("newest")), "newest", query, batch_id)
        finally:
            trades.unpersist()
        lake.clocks.drop_batch(spark, query, batch_id - 2)

    return write


def candle_writer(table: Table, query_id: str | None = None) -> Callable[[DataFrame, int], None]:
    """:func:`batch_writer` for candles."""
    return batch_writer(table, "window_start", query_id)


@dataclass(frozen=True)
class KafkaTopic:
    """Messages to a topic."""

    servers: str
    topic: str
    options: dict[str, str] = field(default_factory=dict)

    def attach(self, messages: DataFrame) -> DataStreamWriter:
        return (
            messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("topic", self.topic)
            .options(**self.options)
        )


@dataclass(frozen=True)
class FileTopic:
    """Messages to Parquet files shaped like a topic, for setups without a broker.

    Each batch replaces a folder of its own. A key appears at most once per
    window and batch, so the batch id serves as the offset.
    """

    path: str

    def attach(self, messages: DataFrame) -> DataStreamWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            partition = F.col("partition") if "partition" in batch.columns else F.lit(0)
            rows = batch.withColumns({"partition": partition, "offset": F.lit(batch_id)})
            (
                conform(rows, MESSAGE_SCHEMA)
                .withColumns({"query_id": F.lit(running_query_id(batch)), "batch_id": F.lit(batch_id)})
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("query_id", "batch_id")
                .parquet(self.path)
            )

        return messages.writeStream.foreachBatch(write)
