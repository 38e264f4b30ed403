"""Candle building, rollup and dedupe."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import candle, candles, texts, trades
from tickloom.operators import build_candles, dedupe_candles, merge_sources, rollup_candles

def test_open_and_close_follow_trade_order(spark):
    """Arrival order is the reverse of time; the expected values come from the ticks themselves."""
    ticks = [(f"2026-03-04 10:2{second // 60}:{second % 60:02}", trade_id, price, quantity) for trade_id, (second, price, quantity) in enumerate([(2, 8, 3), (17, 6, 1), (31, 9, 4), (58, 7, 2)], 70)]
    (row,) = build_candles(trades(spark, [("ETHEUR", i, str(p), str(q), t) for t, i, p, q in reversed(ticks)]), "1 minute", "10 seconds").collect()
    in_time = sorted(ticks)
    prices = [p for _, _, p, _ in ticks]
    assert (row.open, row.close, row.high, row.low) == (in_time[0][2], in_time[-1][2], max(prices), min(prices))
    assert (row.volume, row.quote_volume, row.trade_count) == (sum(q for *_, q in ticks), sum(p * q for _, _, p, q in ticks), len(ticks))
    assert str(row.window_start) == "2026-03-04 10:20:00"
    assert str(row.window_end) == "2026-03-04 10:21:00"


def test_equal_times_are_ordered_by_trade_id_then_price(spark):
    t = "2026-01-01 00:00:05"
    rows = [("A", 2, "7", "1", t), ("A", 1, "5", "1", t), ("A", 1, "6", "1", t), ("A", 2, "8", "1", t)]
    (row,) = build_candles(trades(spark, rows)).collect()
    assert (row.open, row.close) == (5, 8)


def test_window_edges_belong_to_the_later_window(spark):
    rows = [("A", 1, "1", "1", "2026-01-01 00:00:59.999999"), ("A", 2, "2", "1", "2026-01-01 00:01:00")]
    got = texts(build_candles(trades(spark, rows)), "window_start", "open")
    assert got == [("2026-01-01 00:00:00", "1.00000000"), ("2026-01-01 00:01:00", "2.00000000")]


def test_rows_without_time_are_not_counted(spark):
    rows = [("A", 1, "1", "1", None), ("A", 2, "2", "1", "2026-01-01 00:01:00")]
    (row,) = build_candles(trades(spark, rows)).collect()
    assert row.trade_count == 1


TICKS = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.integers(0, 5),
        st.integers(1, 400),
        st.integers(1, 50),
        st.integers(0, 4 * 3600 - 1),
    ),
    min_size=1,
    max_size=40,
)


def as_trades(spark, ticks):
    rows = [
        (s, i, str(Decimal(p) / 4), str(q), f"2026-01-01 {t // 3600:02}:{t // 60 % 60:02}:{t % 60:02}")
        for s, i, p, q, t in ticks
    ]
    return trades(spark, rows)


def brute_candles(ticks, width):
    groups = {}
    for s, i, p, q, t in ticks:
        groups.setdefault((t // width, s), []).append((t, i, Decimal(p) / 4, q))
    return sorted(
        (w, s, min(g)[2], max(x[2] for x in g), min(x[2] for x in g), max(g)[2], sum(x[3] for x in g),
         sum(x[2] * x[3] for x in g), len(g))
        for (w, s), g in groups.items()
    )


def plain(df, width):
    start = 1767225600
    return sorted(
        (int(r.e - start) // width, r.symbol, r.open, r.high, r.low, r.close, r.volume, r.quote_volume, r.trade_count)
        for r in df.selectExpr("unix_seconds(window_start) AS e", "*").collect()
    )


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ticks=TICKS)
def test_candles_equal_brute_force_in_any_order(spark, ticks):
    shuffled = random.Random(1).sample(ticks, len(ticks))
    got = plain(build_candles(as_trades(spark, shuffled).repartition(3), "1 minute"), 60)
    assert got == brute_candles(ticks, 60)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(ticks=TICKS)
def test_rollup_of_minutes_equals_direct_hours(spark, ticks):
    minutes = build_candles(as_trades(spark, ticks), "1 minute")
    rolled = rollup_candles(rollup_candles(minutes, "15 minutes"), "1 hour")
    assert rolled.schema["volume"].dataType.simpleString() == "decimal(38,8)"
    assert plain(rolled, 3600) == brute_candles(ticks, 3600)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(ticks=TICKS)
def test_packed_ticks_equal_struct_ticks(spark, ticks):
    # one price per (symbol, time, id), as copies of a trade have
    ticks = list({(s, i, t): (s, i, p, q, t) for s, i, p, q, t in ticks}.values())
    df = as_trades(spark, ticks).repartition(3)
    for width, seconds in (("1 minute", 60), ("1 hour", 3600)):
        assert plain(build_candles(df, width, trade_ids_below=6), seconds) == brute_candles(ticks, seconds)


def test_packed_ticks_are_hashed_and_refuse_ids_out_of_bounds(spark):
    rows = [("A", i, "1", "1", "2026-01-01 00:00:05") for i in (0, 7)]
    df = trades(spark, rows)
    ok = build_candles(df, trade_ids_below=8)
    assert "SortAggregate" not in ok._jdf.queryExecution().executedPlan().toString()
    assert ok.first().trade_count == 2
    for bad in (build_candles(df, trade_ids_below=7), build_candles(df.withColumn("trade_id", df.trade_id - 1), trade_ids_below=8)):
        with pytest.raises(Exception, match="trade id missing or not in"):
            bad.collect()
    with pytest.raises(ValueError, match="do not fit"):
        build_candles(df, "1 hour", trade_ids_below=1 << 40)


def test_dedupe_keeps_most_trades_and_is_stable_on_ties(spark):
    rows = [candle(count=3, close=11), candle(count=5, close=10), candle(count=5, close=12), candle(minute=1)]
    for order in (rows, rows[::-1]):
        got = dedupe_candles(candles(spark, order).repartition(3))
        assert texts(got, "close", "trade_count") == [("11.00000000", "1"), ("12.00000000", "5")]


def test_dedupe_limits_groups_before_the_shuffle(spark, capsys):
    dedupe_candles(candles(spark, [candle()] * 3).repartition(3)).explain()
    plan = capsys.readouterr().out
    below = plan.split("WindowGroupLimit", 1)[1]
    assert "Final" in below.split("\n", 1)[0]
    assert plan.count("WindowGroupLimit") == 2
    assert below.index("Exchange hashpartitioning(symbol") < below.index("Partial")


def test_merge_prefers_first_source_on_equal_counts(spark):
    streamed = candles(spark, [candle(count=4), candle(minute=1, count=1)])
    filled = candles(spark, [candle(count=4), candle(minute=1, count=6), candle(minute=2)])
    got = merge_sources({"stream": streamed, "backfill": filled})
    assert texts(got, "window_start", "source") == [
        ("2026-01-01 00:00:00", "stream"),
        ("2026-01-01 00:01:00", "backfill"),
        ("2026-01-01 00:02:00", "backfill"),
    ]


def test_hot_group_leaves_one_row_per_map_task(spark):
    """One (symbol, window) with nearly all rows is combined before the shuffle."""
    hot = spark.range(200_000, numPartitions=4).selectExpr(
        "'A' AS symbol",
        "id AS trade_id",
        "cast(id % 97 + 1 AS decimal(18,8)) AS price",
        "cast(1 AS decimal(18,8)) AS quantity",
        "timestamp_micros(1767225600000000 + id) AS trade_time",
    )
    df = build_candles(hot)
    (row,) = df.collect()
    assert (row.trade_count, row.open, row.high) == (200_000, 1, 97)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("width", ["5 minutes", "4 hours", "1 day"])
def test_rollup_end_is_start_plus_width(spark, width):
    (row,) = rollup_candles(candles(spark, [candle()]), width).selectExpr(
        f"window_end = window_start + INTERVAL '{width}' AS ok"
    ).collect()
    assert row.ok
