"""Streams over files shaped like a topic: closed and open candles, late rows, restarts."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import message, texts
from tickloom.operators import build_candles, decode_trades, latest_messages, split_trades
from tickloom.plans import registry
from tickloom.schemas import CANDLE_SCHEMA, MESSAGE_SCHEMA
from tickloom.sources import Lake, file_messages, kafka_messages
from tickloom.streaming import (
    LIVE_TRIGGER,
    STORE_TRIGGER,
    FileTopic,
    KafkaTopic,
    start_bronze,
    start_live,
    start_rejects,
    start_silver,
)

NOW = {"availableNow": True}


class Topic:
    """A folder of single-file batches, read one file per micro-batch in order."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, path, 0
        path.mkdir()

    def send(self, *lines):
        rows = [(None, line, 0, self.sent * 1000 + i) for i, line in enumerate(lines)]
        frame = self.spark.createDataFrame(rows, MESSAGE_SCHEMA).toPandas()
        frame.to_parquet(self.path / f"{self.sent:05}.parquet")
        self.sent += 1

    def source(self):
        return file_messages(str(self.path), maxFilesPerTrigger="1")

    def stream(self):
        return self.source().stream(self.spark)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def trade(time, trade_id=1, price="10", symbol="A"):
    return message(symbol, trade_id, price, time=f"2026-01-01 {time}")


def test_bronze_and_rejects_split_the_topic(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05"), "junk", trade("01:00:05", symbol="B"))
    topic.send(trade("00:00:06", price="x"))
    run(start_bronze(topic.stream(), lake, str(tmp_path / "c1"), trigger=NOW))
    run(start_rejects(topic.stream(), lake, str(tmp_path / "c2"), trigger=NOW))
    assert texts(lake.trades.read(spark), "symbol", "dt", "hour", "price") == [
        ("A", "2026-01-01", "0", "10.00000000"),
        ("B", "2026-01-01", "1", "10.00000000"),
    ]
    rejected = lake.rejects().read(spark)
    assert texts(rejected, "reason") == [("bad_price",), ("malformed_message",)]
    assert "junk" in {r.value for r in rejected.collect()}
    # nothing new arrived: a restart from the checkpoint adds nothing
    run(start_bronze(topic.stream(), lake, str(tmp_path / "c1"), trigger=NOW))
    assert lake.trades.read(spark).count() == 2


def test_silver_writes_each_candle_once_when_closed(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:45", 3, "60300"), trade("00:00:05", 1, "60000"))
    topic.send(trade("00:00:55", 4, "60100"), trade("00:00:20", 2, "59900"))
    topic.send(trade("00:01:30", 5, "61000"))
    run(start_silver(topic.stream(), lake, str(tmp_path / "c"), trigger=NOW))
    stored = lake.streamed.read(spark)
    assert texts(stored, "window_start", "open", "close", "high", "low", "trade_count") == [
        ("2026-01-01 00:00:00", "60000.00000000", "60100.00000000", "60300.00000000", "59900.00000000", "4")
    ]
    # the query id comes from the checkpoint and survives a restart
    (first,) = {r.query_id for r in stored.collect()}
    topic.send(trade("00:02:30", 6))
    run(start_silver(topic.stream(), lake, str(tmp_path / "c"), trigger=NOW))
    stored = lake.streamed.read(spark)
    assert {r.query_id for r in stored.collect()} == {first}
    assert texts(stored, "window_start") == [("2026-01-01 00:00:00",), ("2026-01-01 00:01:00",)]


@pytest.mark.parametrize("bound", [None, 1000])
def test_closed_stream_candles_equal_batch(spark, topic, lake, tmp_path, bound):
    lines = [trade(f"0{h}:{m:02}:{(7 * m) % 60:02}", h * 60 + m, str(10 + (m * 13) % 29), s) for h in (0, 1) for m in range(0, 60, 6) for s in "AB"]
    for i in range(0, len(lines), 14):
        topic.send(*lines[i : i + 14])
    run(start_silver(topic.stream(), lake, str(tmp_path / "c"), "10 minutes", trigger=NOW, trade_ids_below=bound))
    valid, _ = split_trades(decode_trades(topic.source().batch(spark)))
    batch = build_candles(valid, "10 minutes")
    newest = valid.agg(F.max("trade_time") - F.expr("INTERVAL 10 SECONDS")).first()[0]
    columns = CANDLE_SCHEMA.fieldNames()
    expected = texts(batch.filter(F.col("window_end") <= F.lit(newest)), *columns)
    assert texts(lake.streamed.read(spark), *columns) == expected
    assert len(expected) == 22


def test_late_rows_are_dropped_once_the_watermark_has_passed(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05", 1))
    topic.send(trade("02:10:00", 2))
    topic.send(trade("02:20:00", 3))
    topic.send(trade("00:30:00", 4), trade("02:30:00", 5))
    query = run(start_silver(topic.stream(), lake, str(tmp_path / "c"), "1 hour", trigger=NOW))
    assert texts(lake.streamed.read(spark), "window_start", "trade_count") == [("2026-01-01 00:00:00", "1")]
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1


def test_live_republishes_open_candles(spark, topic, tmp_path):
    out = FileTopic(str(tmp_path / "out"))
    topic.send(trade("00:00:05", 1, "10"), trade("00:00:07", 1, "20", "B"))
    topic.send(trade("00:00:15", 2, "12"))
    topic.send(trade("00:01:00", 3, "13"))
    run(start_live(topic.stream(), out, str(tmp_path / "c"), trigger=NOW))
    published = file_messages(out.path).batch(spark)
    seen = [(r.key, json.loads(r.value)["trade_count"], r.offset) for r in published.collect()]
    assert sorted(seen) == [("A", 1, 0), ("A", 1, 2), ("A", 2, 1), ("B", 1, 0)]
    newest = {r.symbol: json.loads(r.value) for r in latest_messages(published).collect()}
    assert newest["A"]["window_start"] == "2026-01-01T00:01:00.000Z" and newest["A"]["close"] == 13
    assert newest["B"]["close"] == 20


def test_latest_message_as_a_stream(spark, topic, tmp_path):
    for close, start in ((1, "00:00"), (2, "00:01"), (3, "00:00")):
        topic.send(json.dumps({"symbol": "A", "window_start": f"2026-01-01T{start}:00.000Z", "close": close}))
    query = (
        latest_messages(topic.stream())
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("newest")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(**NOW)
        .start()
    )
    run(query)
    (row,) = spark.table("newest").collect()
    assert json.loads(row.value)["close"] == 2


def test_topic_defaults():
    source = kafka_messages("host:9092", "trades.raw")
    assert source.options["startingOffsets"] == "latest"
    assert source.options["failOnDataLoss"] == "false"
    assert source.batch_options["startingOffsets"] == "earliest"
    assert source.start_option == "startingTimestamp"
    assert STORE_TRIGGER == {"processingTime": "30 seconds"}
    assert LIVE_TRIGGER == {"processingTime": "2 seconds"}
    assert KafkaTopic("host:9092", "ohlc.1m").topic == "ohlc.1m"


def test_no_task_writes_or_reads_a_sent_part_as_a_whole(spark, tmp_path, monkeypatch):
    """The tasks of a part write its files, and the stream takes them as one batch."""
    monkeypatch.setattr(registry, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    rows = [(n, datetime(2024, 1, 1, n % 24), n, "view", 1.0, '{"k": 2}') for n in range(120)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").repartition(3)
    counts = []

    def start(messages):
        count = messages.writeStream.foreachBatch(lambda batch, number: counts.append((number, batch.count())))
        return count.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()

    registry.sent_in_parts(spark, [events.filter("event_id < 80"), events.filter("event_id >= 80")], start)
    assert counts == [(0, 80), (1, 40)]
    assert [len(list((tmp_path / "events" / f"part={n}").glob("*.parquet"))) for n in (0, 1)] == [3, 3]
