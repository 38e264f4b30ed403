"""Distinct trades, late trades, parts of candles, rollups and open candles of streams."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import message, texts, trades
from test_streaming import NOW, Topic, run, trade
from tickloom.operators import build_candles, chained_rollups, decode_trades, distinct_trades, finish_partials, merge_partials, partial_candles, split_trades
from tickloom.plans.amend import amend, amended_candles
from tickloom.schemas import CANDLE_SCHEMA, PART_SCHEMA, TRADE_SCHEMA, conform
from tickloom.sources import HourRange, Lake
from tickloom.streaming import FileTopic, open_candles, parts_writer, start_bronze, start_live, start_parts, start_rollup, start_silver

COLUMNS = CANDLE_SCHEMA.fieldNames()


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def random_trades(spark, seed, count=120):
    draw = random.Random(seed)
    rows = [
        (draw.choice("AB"), draw.randint(1, 60), str(draw.choice([10, 10.5, 11, 12])), str(draw.randint(0, 3)), f"2026-01-01 00:0{draw.randint(0, 3)}:{draw.choice([0, 0, 7, 59]):02}")
        for _ in range(count)
    ]
    return trades(spark, rows)


@pytest.mark.parametrize("seed", range(4))
def test_merging_any_split_gives_the_candles_of_all_trades(spark, seed):
    """Merged in any order and grouping, with equal ticks, prices and times among the trades."""
    draw = random.Random(seed)
    whole = random_trades(spark, seed).withColumn("split", F.pmod(F.hash("trade_id", "price", F.lit(seed)), F.lit(5))).cache()
    parts = [partial_candles(whole.filter(F.col("split") == n)) for n in range(5)]
    draw.shuffle(parts)
    while len(parts) > 1:
        a, b = parts.pop(), parts.pop(draw.randrange(len(parts)))
        parts.insert(draw.randint(0, len(parts)), merge_partials(a.unionByName(b)))
    assert texts(finish_partials(parts[0]), *COLUMNS) == texts(build_candles(whole), *COLUMNS)


def test_a_part_of_nothing_changes_nothing(spark):
    whole = random_trades(spark, 9)
    part = partial_candles(whole)
    both = merge_partials(part.unionByName(part.filter("1 = 0")))
    assert texts(finish_partials(both), *COLUMNS) == texts(finish_partials(part), *COLUMNS)
    assert finish_partials(part.filter("1 = 0")).count() == 0


def test_distinct_trades_of_a_batch(spark):
    rows = [("A", 1, "10", "1", "2026-01-01 00:00:01"), ("A", 1, "10", "1", "2026-01-01 00:00:01"), ("B", 1, "10", "1", "2026-01-01 00:00:01")]
    rows += [("A", 2, "11", "1", "2026-01-01 00:00:03"), ("A", 2, "12", "1", "2026-01-01 00:00:02"), ("A", None, "5", "1", "2026-01-01 00:00:02"), ("A", None, "5", "1", "2026-01-01 00:00:02")]
    kept = distinct_trades(trades(spark, rows))
    assert texts(kept.fillna({"trade_id": 0}), "symbol", "trade_id", "price") == [
        ("A", "0", "5.00000000"),
        ("A", "1", "10.00000000"),
        ("A", "2", "11.00000000"),
        ("B", "1", "10.00000000"),
    ]


def test_a_stream_needs_to_know_how_long_to_keep_ids(topic):
    topic.send(trade("00:00:01"))
    with pytest.raises(ValueError):
        distinct_trades(split_trades(decode_trades(topic.stream()))[0])


def test_trades_sent_twice_are_archived_once_across_batches_and_restarts(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05", 1), trade("00:00:06", 2), trade("00:00:05", 1))
    topic.send(trade("00:00:06", 2), trade("00:00:07", 3), trade("00:00:07", 3, symbol="B"))
    run(start_bronze(topic.stream(), lake, str(tmp_path / "c"), NOW, distinct_within="1 hour"))
    topic.send(trade("00:00:05", 1), trade("00:00:08", 4))
    run(start_bronze(topic.stream(), lake, str(tmp_path / "c"), NOW, distinct_within="1 hour"))
    assert texts(lake.trades.read(spark), "symbol", "trade_id") == [("A", "1"), ("A", "2"), ("A", "3"), ("A", "4"), ("B", "3")]


def test_trades_sent_twice_count_once_in_their_candle(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05", 1), trade("00:00:20", 2), trade("00:00:05", 1))
    topic.send(trade("00:00:20", 2), trade("00:00:55", 3))
    topic.send(trade("00:03:00", 9))
    run(start_silver(topic.stream(), lake, str(tmp_path / "c"), trigger=NOW, distinct=True))
    # far behind the watermark: late for the candle, whether its id is still known or not
    topic.send(trade("00:00:05", 1), trade("00:05:00", 10))
    run(start_silver(topic.stream(), lake, str(tmp_path / "c"), trigger=NOW, distinct=True))
    assert texts(lake.streamed.read(spark), "window_start", "trade_count", "volume") == [
        ("2026-01-01 00:00:00", "3", "3.00000000"),
        ("2026-01-01 00:03:00", "1", "1.00000000"),
    ]


def test_late_trades_are_kept_and_a_symbol_behind_others_is_not_late(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05", 1), trade("00:05:00", 2))
    topic.send(trade("00:00:30", 3), trade("00:00:10", 4, symbol="B"), trade("00:04:59", 5))
    topic.send(trade("00:00:40", 6, symbol="B"), trade("00:00:50", 7, "99"))
    run(start_parts(topic.stream(), lake, str(tmp_path / "c"), delay="10 seconds", trigger=NOW))
    # the window of 00:04:59 ended just as the clock stood at 00:05:00: less than the delay ago
    assert texts(lake.late.read(spark), "symbol", "trade_id") == [("A", "3"), ("A", "7")]
    counts = lake.parts.read(spark).groupBy("symbol", "late").agg(F.sum("trade_count").alias("n"))
    assert texts(counts, "symbol", "late", "n") == [("A", "false", "3"), ("A", "true", "2"), ("B", "false", "2")]
    valid, _ = split_trades(decode_trades(topic.source().batch(spark)))
    assert texts(amended_candles(spark, lake), *COLUMNS) == texts(build_candles(valid), *COLUMNS)
    first = amended_candles(spark, lake, late=False).filter("symbol = 'A' AND minute(window_start) = 0")
    assert texts(first, "trade_count", "close") == [("1", "10.00000000")]


def test_a_batch_of_parts_run_twice_leaves_the_same(spark, lake):
    def batch(*rows):
        return conform(split_trades(decode_trades(spark.createDataFrame([(r,) for r in rows], "value string")))[0], TRADE_SCHEMA)

    write = parts_writer(lake, "1 minute", "10 seconds", query_id="q")
    first, second, third = batch(message(time="2026-01-01 00:05:00")), batch(message(trade_id=2, time="2026-01-01 00:00:01")), batch(message(trade_id=3, time="2026-01-01 00:09:00"))
    for number, rows in enumerate((first, second, second)):
        write(rows, min(number, 1))
    for _ in range(2):
        write(third, 2)
    assert texts(lake.late.read(spark), "trade_id") == [("2",)]
    assert texts(lake.parts.read(spark), "trade_count", "late") == [("1", "false"), ("1", "false"), ("1", "true")]
    # clocks of the last two batches are kept, and an empty batch hands them on
    write(third.filter("1 = 0"), 3)
    assert texts(lake.clocks.read(spark), "batch_id", "newest") == [("2", "2026-01-01 00:09:00"), ("3", "2026-01-01 00:09:00")]


def test_amending_touches_folders_with_late_parts_only(spark, lake):
    def parts(late, *rows):
        return conform(partial_candles(trades(spark, rows)).withColumn("late", F.lit(late)), PART_SCHEMA)

    in_time = [("A", 1, "10", "1", "2026-01-01 00:00:05"), ("A", 2, "11", "1", "2026-01-01 05:00:05")]
    late = [("A", 3, "12", "1", "2026-01-01 00:00:50")]
    for number, (flag, rows) in enumerate(((False, in_time), (True, late))):
        owned = parts(flag, *rows).withColumns({"query_id": F.lit("q"), "batch_id": F.lit(number)})
        lake.parts.write_gathered(lake.parts.gathered(lake.parts.placed(owned)), sort_by=("window_start",))
    lake.compacted.replace_partitions(build_candles(trades(spark, in_time)), sort_by=("window_start",))
    backfilled = build_candles(trades(spark, [("A", 8, "7", "2", "2026-01-01 00:30:05"), ("A", 9, "7", "2", "2026-01-01 05:30:05")]))
    lake.backfilled.replace_partitions(backfilled.withColumn("run_id", F.lit("r")), sort_by=("window_start",))
    for _ in range(2):
        amend(spark, lake, HourRange.of("2026-01-01-00:00", "2026-01-01-23:00"))
        assert texts(lake.compacted.read(spark), "window_start", "close", "trade_count") == [
            ("2026-01-01 00:00:00", "12.00000000", "2"),
            ("2026-01-01 00:30:00", "7.00000000", "1"),
            ("2026-01-01 05:00:00", "11.00000000", "1"),  # its hour has no late part: the backfilled candle waits for compaction
        ]


def many(spark, topic, batches):
    lines = [trade(f"0{h}:{m:02}:{(7 * m) % 60:02}", h * 60 + m, str(10 + (m * 13) % 29), s) for h in (0, 1, 2) for m in range(0, 60, 4) for s in "AB"]
    for i in range(0, len(lines), -(-len(lines) // batches)):
        topic.send(*lines[i : i + -(-len(lines) // batches)])
    return split_trades(decode_trades(topic.source().batch(spark)))[0]


@pytest.mark.parametrize("widths", [("1 minute", "5 minutes", "1 hour"), ("10 minutes",), ("5 minutes", "20 minutes")])
def test_rollups_inside_a_stream_equal_those_of_a_batch(spark, topic, lake, tmp_path, widths):
    valid = many(spark, topic, 5)
    run(start_rollup(topic.stream(), lake, str(tmp_path / "c"), "x", widths, trigger=NOW))
    newest = valid.agg(F.max("trade_time") - F.expr("INTERVAL 10 SECONDS")).first()[0]
    expected = texts(chained_rollups(valid, widths, "10 seconds").filter(F.col("window_end") <= F.lit(newest)), *COLUMNS)
    assert texts(lake.streamed_gold("x").read(spark), *COLUMNS) == expected
    assert expected == texts(build_candles(valid, widths[-1]).filter(F.col("window_end") <= F.lit(newest)), *COLUMNS)


def test_rollup_widths_that_do_not_nest(spark, topic):
    with pytest.raises(ValueError):
        chained_rollups(random_trades(spark, 1), ("2 minutes", "5 minutes"), "10 seconds")


@pytest.mark.parametrize("options", [{}, {"trade_ids_below": 1000}, {"distinct": True}])
def test_closed_and_open_candles_are_all_candles(spark, topic, lake, tmp_path, options):
    valid = many(spark, topic, 3)
    checkpoint = str(tmp_path / "c")
    run(start_silver(topic.stream(), lake, checkpoint, "10 minutes", trigger=NOW, **options))
    still = open_candles(spark, checkpoint)
    both = lake.streamed.read(spark).select(COLUMNS).unionByName(still)
    assert still.count() > 0 and still.columns == COLUMNS
    assert texts(both, *COLUMNS) == texts(build_candles(valid, "10 minutes"), *COLUMNS)


def test_open_candles_of_the_live_query(spark, topic, tmp_path):
    topic.send(trade("00:00:05", 1, "10"), trade("00:00:07", 2, "20"))
    run(start_live(topic.stream(), FileTopic(str(tmp_path / "out")), str(tmp_path / "c"), trigger=NOW))
    assert texts(open_candles(spark, str(tmp_path / "c")), "open", "close", "trade_count") == [("10.00000000", "20.00000000", "2")]


def test_a_checkpoint_without_candles(spark, topic, lake, tmp_path):
    topic.send(trade("00:00:05", 1))
    run(start_bronze(topic.stream(), lake, str(tmp_path / "c"), NOW, distinct_within="1 hour"))
    with pytest.raises(ValueError):
        open_candles(spark, str(tmp_path / "c"))
