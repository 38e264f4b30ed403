"""Lag sketches, routing by load, differences of sources, replayed holes, folders of busy symbols."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import START, at, candle, candles, message, texts, trades
from tickloom.operators import assign_by_load, build_candles, compare_sources, decode_trades, lag_quantiles, lag_sketches, measured_loads, merge_lag_sketches, rank_error, route_by_load
from tickloom.plans.compaction import backfill, compact
from tickloom.plans.lag import lag_report, store_lag
from tickloom.plans.replay import archived_trades, replay_missing
from tickloom.schemas import TRADE_SCHEMA, conform
from tickloom.sources import HourRange, Lake
from tickloom.streaming import batch_writer, candle_writer


def lagged(spark, rows):
    """(symbol, minute, lag) rows as decoded trades."""
    base = int(START.timestamp() * 1000)
    frame = spark.createDataFrame(rows, "symbol string, minute int, lag long")
    return frame.selectExpr("symbol", f"{base}L + minute * 60000L AS trade_time_ms", f"{base}L + minute * 60000L + lag AS ingested_at_ms").withColumn("trade_time", F.timestamp_millis("trade_time_ms"))


def test_merged_sketches_keep_ranks(spark):
    draw = random.Random(3)
    rows = [("A", draw.randrange(600), int(draw.paretovariate(1.2) * 20)) for _ in range(40_000)]
    merged = merge_lag_sketches(merge_lag_sketches(lag_sketches(lagged(spark, rows)), "1 hour"), "1 day")
    quantiles = {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    (got,) = lag_quantiles(merged, quantiles).collect()
    lags = sorted(r[2] for r in rows)
    assert (got.trades, got.min_lag_ms, got.max_lag_ms) == (len(lags), lags[0], lags[-1])
    assert got.avg_lag_ms == pytest.approx(sum(lags) / len(lags))
    for name, q in quantiles.items():
        value = got[f"{name}_lag_ms"]
        below, upto = sum(x < value for x in lags), sum(x <= value for x in lags)
        assert below - 2 * rank_error() * len(lags) <= q * len(lags) <= upto + 2 * rank_error() * len(lags)


def test_small_sketches_are_exact_and_lags_without_a_time_do_not_count(spark):
    rows = lagged(spark, [("A", 0, k) for k in range(1, 101)] + [("B", 0, None)])
    (got,) = lag_quantiles(lag_sketches(rows, "1 hour")).collect()
    assert (got.symbol, got.trades, got.p50_lag_ms, got.p95_lag_ms) == ("A", 100, 50, 95)
    assert lag_sketches(rows.filter("1 = 0")).count() == 0


def test_stored_lag_over_all_symbols(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = [(message(s, n, time=f"2026-01-01 0{n % 3}:00:05"),) for s in "AB" for n in range(30)]
    archived = conform(decode_trades(spark.createDataFrame(rows, "value string")), TRADE_SCHEMA)
    batch_writer(lake.trades, "trade_time", query_id="q")(archived, 0)
    hours = HourRange.of("2026-01-01-00:00", "2026-01-01-02:00")
    for _ in range(2):
        store_lag(spark, lake, hours)
    assert texts(lag_report(spark, lake, "1 day", hours, by=()), "trades", "p50_lag_ms", "max_lag_ms") == [("60", "40", "40")]
    assert texts(lag_report(spark, lake, "1 hour", HourRange.of("2026-01-01-01:00")), "symbol", "trades") == [("A", "10"), ("B", "10")]


def test_loads_are_never_worse_dealt_than_by_position():
    draw = random.Random(1)
    for _ in range(300):
        loads = {f"S{k}": int(draw.paretovariate(0.7)) for k in range(draw.randint(1, 12))}
        partitions = draw.randint(1, 5)
        routes = assign_by_load(loads, partitions)
        assert set(routes) == set(loads) and set(routes.values()) <= set(range(partitions))

        def fullest(of):
            return max(sum(n for s, n in loads.items() if of[s] == p) for p in range(partitions))

        assert fullest(routes) <= fullest({s: k % partitions for k, s in enumerate(loads)})
        # the known bound of longest-first: 4/3 of the best, and the best is at least these
        best = max(max(loads.values()), -(-sum(loads.values()) // partitions))
        assert fullest(routes) <= 4 / 3 * best + max(loads.values())
    assert assign_by_load({}, 3) == {}
    assert assign_by_load({"A": 5, "B": 5, "C": 5, "D": 15}, 2) == {"D": 0, "A": 1, "B": 1, "C": 1}


def test_routes_of_measured_loads(spark):
    rows = trades(spark, [(s, n, "1", "1", "2026-01-01 00:00:00") for s, count in (("big", 6), ("Big", 3), ("b", 4), ("c", 4), ("other", 9)) for n in range(count)])
    loads = measured_loads(rows, ["b", "big", "c", "none"])
    assert loads == {"B": 4, "BIG": 9, "C": 4, "NONE": 0}
    routed = route_by_load(rows, assign_by_load(loads, 2))
    counts = routed.groupBy("partition").agg(F.count("*").alias("n")).fillna({"partition": -1})
    assert texts(counts, "partition", "n") == [("-1", "9"), ("0", "9"), ("1", "8")]
    assert route_by_load(rows, {}).filter("partition IS NOT NULL").count() == 0


def test_differences_name_the_fields(spark):
    left = candles(spark, [candle(minute=0), candle(minute=1, close=10), candle(minute=2), candle(minute=3, volume=None), candle(minute=5, count=9), candle(minute=5, count=2)])
    right = candles(spark, [candle(minute=0), candle(minute=1, high=13), candle(minute=3), candle(minute=4), candle(minute=5, count=9)])
    got = compare_sources(left, right)
    rows = [(r.symbol, r.window_start.minute, r.status, tuple(r.fields), r.stream is None, r.backfill is None) for r in got.orderBy("window_start").collect()]
    assert rows == [
        ("A", 1, "differs", ("high", "close"), False, False),
        ("A", 2, "only_stream", (), False, True),
        ("A", 3, "differs", ("volume",), False, False),
        ("A", 4, "only_backfill", (), True, False),
    ]
    assert compare_sources(left.filter("1 = 0"), right.filter("1 = 0")).count() == 0
    assert {c for c in compare_sources(left, right, ("a", "b")).columns} == {"symbol", "window_start", "status", "fields", "a", "b"}


@pytest.fixture(params=["hour", "day"])
def holed(spark, tmp_path, request):
    """A lake with an archive of five hours of two symbols, and candles of the even hours only."""
    lake = Lake(str(tmp_path / "lake"), grain=request.param)
    rows = [(message(s, 60 * h + m, price=str(10 + m), time=f"2026-01-01 0{h}:{m:02}:05"),) for s in "AB" for h in range(5) for m in range(0, 60, 20)]
    archived = conform(decode_trades(spark.createDataFrame(rows, "value string")), TRADE_SCHEMA)
    batch_writer(lake.trades, "trade_time", query_id="q")(archived.unionByName(archived.limit(7)), 0)
    whole = build_candles(archived)
    candle_writer(lake.streamed, query_id="q")(whole.filter(F.hour("window_start") % 2 == 0), 0)
    compact(spark, lake)
    return lake, whole


HOURS = HourRange.of("2026-01-01-00:00", "2026-01-01-06:00")


def test_holes_are_filled_from_the_archive(spark, holed):
    lake, whole = holed
    columns = whole.columns
    for _ in range(2):
        left = replay_missing(spark, lake, HOURS)
        assert texts(lake.compacted.read(spark), *columns) == texts(whole, *columns)
        assert texts(left, "symbol", "hour_start") == [(s, f"2026-01-01 0{h}:00:00") for s in "AB" for h in (5, 6)]


def test_a_replay_reads_the_listed_folders_only(spark, holed):
    lake, _ = holed
    worklist = spark.createDataFrame([("A", at("2026-01-01 03:00"))], "symbol string, hour_start timestamp")
    found = archived_trades(spark, lake, worklist, HOURS)
    assert texts(found.select("symbol", F.hour("trade_time").alias("h")).distinct(), "symbol", "h") == [("A", "3")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_busy_symbol_is_written_by_several_tasks(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = spark.range(0, 3200, numPartitions=32).selectExpr("concat('{\"symbol\":\"A\",\"trade_id\":', id, ',\"price\":\"1\",\"quantity\":\"1\",\"trade_time_ms\":', 1767225600000 + id, '}') AS value")
    batch_writer(lake.trades, "trade_time", query_id="q")(conform(decode_trades(rows), TRADE_SCHEMA), 0)
    files = lake.trades.read(spark).select(F.input_file_name().alias("f")).distinct().count()
    assert 1 < files <= 4
    assert lake.trades.read(spark).select("trade_id").distinct().count() == 3200
    # candles of a folder stay one file
    candle_writer(lake.streamed, query_id="q")(build_candles(lake.trades.read(spark), "1 second").repartition(32), 0)
    lake.compacted.replace_partitions(build_candles(lake.trades.read(spark), "1 second").repartition(32), sort_by=("window_start",))
    assert lake.compacted.read(spark).select(F.input_file_name().alias("f")).distinct().count() == 1


def test_a_backfill_run_merges_the_folders_it_landed_in_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), grain="day")
    day = 24 * 60
    candle_writer(lake.streamed, query_id="q")(candles(spark, [candle(minute=0), candle(minute=day)]), 0)
    compact(spark, lake)
    before = {r.f for r in lake.compacted.read(spark).select(F.input_file_name().alias("f")).collect()}
    ms = int(at("2026-01-02 00:05").timestamp() * 1000)
    pages = spark.createDataFrame([("A", f'[[{ms},"1","2","1","2","3",{ms + 59_999},"4",5]]')], "symbol string, page string")
    counts = backfill(spark, lake, pages, HourRange.of("2026-01-01-00:00", "2026-01-03-23:00"))
    assert counts == {"klines": 1, "landed": 1, "outside": 0, "malformed": 0}
    after = {r.f for r in lake.compacted.read(spark).select(F.input_file_name().alias("f")).collect()}
    assert {f for f in before if "dt=2026-01-01" in f} <= after
    assert lake.compacted.read(spark).count() == 3


def test_day_folders_are_listed_one_at_a_time(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"), grain="day")
    rows = [candle(s, minute=24 * 60 * d) for s in ("A", "B/C") for d in range(3)]
    lake.compacted.replace_partitions(candles(spark, rows), sort_by=("window_start",))
    days = [str(d) for d, _ in sorted(lake.compacted.day_folders(spark))]
    assert days == [f"2026-01-0{d}" for d in (1, 1, 2, 2, 3, 3)]
    assert sorted(str(d) for d, _ in lake.compacted.day_folders(spark, "B/C", before=at("2026-01-03").date())) == ["2026-01-01", "2026-01-02"]
    assert list(lake.gold("1h").day_folders(spark)) == [] and list(lake.compacted.day_folders(spark, "none")) == []
