"""Invariants, gaps, missing hours, retention selection and the read side."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import START, candle, candles, texts
from tickloom.functions import boundaries_between, display_number, display_window
from tickloom.functions.timeparts import hour_floor, hour_key, parse_hour_key, width_seconds
from tickloom.operators import (
    candle_gaps,
    candle_history,
    expired_partitions,
    gap_count,
    history_summary,
    invariant_report,
    invariant_violations,
    latest_candles,
    missing_hours,
)
from pyspark.sql import functions as F

BREAKS = {
    "high_below_open": {"open": 13},
    "high_below_close": {"close": 13},
    "high_below_low": {"high": 8},
    "low_above_open": {"open": 8},
    "low_above_close": {"close": 8},
    "volume_not_positive": {"volume": 0},
    "no_trades": {"count": 0},
}


@pytest.mark.parametrize("rule", BREAKS)
def test_each_rule_finds_its_violation(spark, rule):
    df = candles(spark, [candle(), candle(minute=1, **BREAKS[rule])])
    report = invariant_report(df).first()
    assert (report.candles, report.violations, report[rule]) == (2, 1, 1)
    (row,) = invariant_violations(df).collect()
    assert rule in row.broken_rules


def test_nulls_are_reported_apart_from_violations(spark):
    report = invariant_report(candles(spark, [candle(high=None)])).first()
    assert (report.violations, report.null_values) == (0, 1)


def test_gap_inside_an_hour_and_across_hours(spark):
    df = candles(spark, [candle(minute=m) for m in (0, 1, 4, 59, 61)] + [candle("B", 0), candle("B", 3000)])
    got = {(r.symbol, r.missing) for r in candle_gaps(df).collect()}
    assert got == {("A", 2), ("A", 54), ("A", 1), ("B", 2999)}
    assert gap_count(df).first().asDict() == {"gaps": 4, "missing": 3056}


def test_no_candles_no_gaps(spark):
    assert gap_count(candles(spark, [])).first().asDict() == {"gaps": 0, "missing": 0}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(minutes=st.lists(st.tuples(st.sampled_from("AB"), st.integers(-4000, 9000)), min_size=1, max_size=40))
def test_gaps_equal_lag_over_whole_symbols(spark, minutes):
    """Repeated, unordered and far-apart starts, some before a bucket edge."""
    df = candles(spark, [candle(s, m) for s, m in minutes])
    expected = []
    for s in "AB":
        own = sorted({m for name, m in minutes if name == s})
        expected += [(s, b - a - 1) for a, b in zip(own, own[1:]) if b - a > 1]
    assert sorted((r.symbol, r.missing) for r in candle_gaps(df).collect()) == sorted(expected)


def test_boundaries_are_counted_not_elapsed_units(spark):
    df = spark.sql("SELECT timestamp'2026-01-01 00:00:59' a, timestamp'2026-01-01 00:01:01' b, timestamp'1969-12-31 23:59:59' c, timestamp'1970-01-01 00:00:00' d")
    row = df.select(boundaries_between(F.col("a"), F.col("b"), 60), boundaries_between(F.col("c"), F.col("d"), 60)).first()
    assert tuple(row) == (1, 1)


def test_missing_hours_over_own_range_and_over_bounds(spark):
    df = candles(spark, [candle("A", 0), candle("A", 180), candle("B", 60)])
    assert texts(missing_hours(df), "symbol", "hour_start") == [
        ("A", "2026-01-01 01:00:00"),
        ("A", "2026-01-01 02:00:00"),
    ]
    symbols = spark.createDataFrame([("A",), ("C",)], "symbol string")
    bounded = missing_hours(df, symbols, "2026-01-01 00:00:00", "2026-01-01 02:30:00")
    assert texts(bounded, "symbol", "hour_start") == [
        ("A", "2026-01-01 01:00:00"),
        ("A", "2026-01-01 02:00:00"),
        ("C", "2026-01-01 00:00:00"),
        ("C", "2026-01-01 01:00:00"),
        ("C", "2026-01-01 02:00:00"),
    ]


def test_expired_partitions_start_after_the_keep_time(spark):
    days = [("A", datetime.date(2026, 1, d)) for d in (1, 1, 2, 3)]
    df = spark.createDataFrame(days, "symbol string, dt date")
    assert texts(expired_partitions(df, "2026-01-09"), "symbol", "dt", "rows") == [("A", "2026-01-01", "2")]


def test_history_takes_the_newest_hours_and_limit(spark):
    rows = [candle("A", m) for m in range(0, 30)] + [candle("A", 600 + m) for m in range(0, 200)] + [candle("B", 5000)]
    df = candles(spark, rows)
    got = [r.window_start for r in candle_history(df, "A").collect()]
    assert len(got) == 120 and got == sorted(got)
    last = START.replace(tzinfo=None) + datetime.timedelta(minutes=799)
    assert got[-1] == last
    assert history_summary(candle_history(df, "A")).first().asDict() == {"candles": 120, "trades": 120}
    assert candle_history(df, "A", within="6 hours", limit=10_000).count() == 200
    assert history_summary(candle_history(df, "missing")).first().asDict() == {"candles": 0, "trades": 0}


def test_latest_candle_per_symbol(spark):
    df = candles(spark, [candle("A", 0), candle("A", 2, close=10), candle("A", 1), candle("B", 0)])
    got = {r.symbol: (r.window_start.minute, int(r.close)) for r in latest_candles(df).collect()}
    assert got == {"A": (2, 10), "B": (0, 11)}


def test_display_forms(spark):
    row = spark.range(1).select(
        display_window(F.lit("2026-01-01 00:00:05.123").cast("timestamp")), display_number(F.lit(1234567.891))
    ).first()
    assert tuple(row) == ("2026-01-01 00:00:05", "1,234,567.89")


def test_hour_keys():
    moment = parse_hour_key("2026-08-05-17:00")
    assert moment == datetime.datetime(2026, 8, 5, 17)
    assert hour_key(moment) == "2026-08-05-17:00"
    assert hour_floor(moment, 4 * 3600) == datetime.datetime(2026, 8, 5, 16)
    with pytest.raises(ValueError):
        parse_hour_key("2026-08-05")


@pytest.mark.parametrize("text, seconds", [("5m", 300), ("1h", 3600), ("15 minutes", 900), ("1 day", 86400), ("10 seconds", 10), ("30s", 30)])
def test_widths(text, seconds):
    assert width_seconds(text) == seconds


@pytest.mark.parametrize("text", ["", "m", "5", "1 month", "5 parsecs"])
def test_bad_widths(text):
    with pytest.raises(ValueError):
        width_seconds(text)
