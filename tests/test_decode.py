"""Message decoding, rejects, normalization, klines, routing and lag."""

import json

from helpers import at, message, texts, trades
from tickloom.operators import (
    build_candles,
    candle_messages,
    decode_klines,
    decode_trades,
    keep_symbols,
    lag_stats,
    latest_messages,
    normalize_events,
    parse_symbols,
    partition_skew,
    reject_reason,
    route_symbols,
    split_trades,
    trade_messages,
)


def values(spark, *lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_decode_types_and_columns(spark):
    got = decode_trades(values(spark, message(price="60300.12345678")).selectExpr("cast(value AS binary) AS value"))
    assert dict(got.dtypes)["price"] == dict(got.dtypes)["quantity"] == "decimal(18,8)"
    assert "event_time_ms" not in got.columns
    (row,) = got.collect()
    assert str(row.price) == "60300.12345678"
    assert str(row.trade_time) == "2026-01-01 00:00:05"


BAD = {
    "not json": "malformed_message",
    "{}": "malformed_message",
    message(price="abc"): "bad_price",
    message(price="1e30"): "bad_price",
    message(quantity=...): "bad_quantity",
    message(trade_id="x"): "bad_trade_id",
    message(symbol=None): "bad_symbol",
    message(trade_time_ms=...): "bad_trade_time_ms",
    message(trade_time_ms=9_000_000_000_000_000_000): "bad_trade_time_ms",
}


def test_bad_messages_are_rejected_with_a_reason(spark):
    good = [message(), message(extra=1), message(price=10.5), message(is_buyer_maker=None)]
    decoded = decode_trades(values(spark, *BAD, *good), keep=("value",))
    valid, rejects = split_trades(decoded)
    assert valid.count() == len(good)
    assert {r.value: r.reason for r in rejects.collect()} == BAD
    assert decoded.filter(reject_reason().isNull()).count() == len(good)


def test_null_value_is_a_reject(spark):
    _, rejects = split_trades(decode_trades(values(spark, None)))
    assert texts(rejects, "reason") == [("malformed_message",)]


def test_filtering_parses_each_message_once(spark):
    valid, _ = split_trades(decode_trades(values(spark, message())))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_normalize_reads_keys_that_differ_in_case(spark):
    event = {"stream": "x", "data": {"e": "trade", "E": 7, "s": "BTCUSDT", "t": 1, "p": "2.5", "q": "3", "T": 6, "m": True}}
    (row,) = normalize_events(values(spark, json.dumps(event))).collect()
    assert row.asDict() == {
        "symbol": "BTCUSDT",
        "trade_id": 1,
        "price": "2.5",
        "quantity": "3",
        "trade_time_ms": 6,
        "event_time_ms": 7,
        "is_buyer_maker": True,
        "source": "binance",
    }


def test_normalized_events_survive_the_topic(spark):
    ms = int(at("2026-01-01 00:00:05").timestamp() * 1000)
    event = {"data": {"E": ms, "s": "ETHUSDT", "t": 1, "p": "2.5", "q": "3", "T": ms, "m": True}}
    sent = trade_messages(normalize_events(values(spark, json.dumps(event))), ["btcusdt", "ethusdt"], 3)
    assert texts(sent, "key", "partition") == [("ETHUSDT", "1")]
    valid, _ = split_trades(decode_trades(sent))
    assert texts(valid, "symbol", "price", "trade_time") == [("ETHUSDT", "2.50000000", "2026-01-01 00:00:05")]


def test_symbol_settings_and_filter(spark):
    assert parse_symbols(" btcusdt, ETHUSDT ,,solusdt ") == ["btcusdt", "ethusdt", "solusdt"]
    rows = [("BTCUSDT", 1, "1", "1", None), ("XRPUSDT", 2, "1", "1", None)]
    assert texts(keep_symbols(trades(spark, rows), ["btcusdt"]), "symbol") == [("BTCUSDT",)]


def test_routing_maps_list_positions_onto_partitions(spark):
    listed = ["btcusdt", "ethusdt", "solusdt", "xrpusdt"]
    rows = [(s.upper(), 1, "1", "1", None) for s in [*listed, "other"]]
    routed = route_symbols(trades(spark, rows), listed, 3)
    assert {r.symbol: r.partition for r in routed.collect()} == {
        "BTCUSDT": 0, "ETHUSDT": 1, "SOLUSDT": 2, "XRPUSDT": 0, "OTHER": None,
    }
    assert {r.partition: (r.messages, r.share) for r in partition_skew(routed).collect()} == {
        0: (2, 0.4), 1: (1, 0.2), 2: (1, 0.2), None: (1, 0.2),
    }


def test_lag_statistics(spark):
    lines = [message(trade_id=i, ingested_at_ms=int(at("2026-01-01 00:00:05").timestamp() * 1000) + i) for i in range(1, 101)]
    for exact in (True, False):
        (row,) = lag_stats(decode_trades(values(spark, *lines)), exact=exact).collect()
        assert (row.trades, row.min_lag_ms, row.max_lag_ms, row.avg_lag_ms) == (100, 1, 100, 50.5)
        assert abs(row.p50_lag_ms - 50.5) <= 0.5 and abs(row.p95_lag_ms - 95) <= 0.5
        assert round(row.trades_per_second, 3) == 1.667


def test_kline_page(spark):
    ms = int(at("2026-01-01 00:00:00").timestamp() * 1000)
    page = [
        [ms, "60000.1", "60010", "59990", "60005", "12.5", ms + 59_999, "750000.25", 42, "5.1", "300000.5", "0"],
        [ms + 60_000, "60005", "60006", "60004", "60004.5", "1", ms + 119_999, "60005", 3, "0", "0", "0"],
    ]
    pages = spark.createDataFrame([("BTCUSDT", json.dumps(page)), ("ETHUSDT", "[]")], "symbol string, page string")
    got = decode_klines(pages)
    assert dict(got.dtypes)["volume"] == "decimal(38,8)"
    assert texts(got, "window_start", "window_end", "open", "quote_volume", "trade_count") == [
        ("2026-01-01 00:00:00", "2026-01-01 00:01:00", "60000.10000000", "750000.25000000", "42"),
        ("2026-01-01 00:01:00", "2026-01-01 00:02:00", "60005.00000000", "60005.00000000", "3"),
    ]


def test_damaged_klines_become_nulls(spark):
    pages = spark.createDataFrame([("A", '[["x", "1"], []]'), ("B", "oops")], "symbol string, page string")
    assert texts(decode_klines(pages), "symbol", "window_start") == [("A", None), ("A", None), ("B", None)]


def test_latest_message_ignores_older_windows_and_prefers_later_offsets(spark):
    def update(start, offset, close):
        return (json.dumps({"symbol": "A", "window_start": start, "close": close}), offset)

    rows = [
        update("2026-01-01T00:01:00.000Z", 1, 1),
        update("2026-01-01T00:01:00.000Z", 2, 2),
        update("2026-01-01T00:00:00.000Z", 3, 3),
        ("junk", 4),
    ]
    df = spark.createDataFrame(rows, "value string, offset long").repartition(3)
    (row,) = latest_messages(df).collect()
    assert json.loads(row.value)["close"] == 2


def test_candle_message_text(spark):
    rows = [("A", 1, "10", "2", "2026-01-01 00:00:05")]
    (row,) = candle_messages(build_candles(trades(spark, rows))).collect()
    assert row.key == "A"
    body = json.loads(row.value)
    assert body["window_start"] == "2026-01-01T00:00:00.000Z"
    assert (body["open"], body["volume"], body["trade_count"]) == (10, 2, 1)
