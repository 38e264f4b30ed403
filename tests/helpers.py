"""Small trades and candles for tests."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from tickloom.schemas import CANDLE_SCHEMA, conform

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def trades(spark, rows):
    """(symbol, trade_id, price, quantity, time text) rows as typed trades."""
    schema = "symbol string, trade_id long, price string, quantity string, ts string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "symbol",
        "trade_id",
        "cast(price AS decimal(18,8)) AS price",
        "cast(quantity AS decimal(18,8)) AS quantity",
        "cast(ts AS timestamp) AS trade_time",
    )


def candle(symbol="A", minute=0, count=1, open=10, high=12, low=9, close=11, volume=5, start=START, **changes):
    begin = start + timedelta(minutes=minute)
    row = {
        "window_start": begin,
        "window_end": begin + timedelta(minutes=1),
        "symbol": symbol,
        "open": open,
        "high": high,
        "low": low,
        "close": close,
        "volume": volume,
        "quote_volume": 50,
        "trade_count": count,
        **changes,
    }
    for name in ("open", "high", "low", "close", "volume", "quote_volume"):
        row[name] = None if row[name] is None else Decimal(row[name])
    return tuple(row[f.name] for f in CANDLE_SCHEMA)


def candles(spark, rows):
    return conform(spark.createDataFrame(rows, CANDLE_SCHEMA))


def message(symbol="A", trade_id=1, price="10", quantity="1", time="2026-01-01 00:00:05", **changes):
    import json

    ms = int(at(time).timestamp() * 1000)
    fields = {
        "symbol": symbol,
        "trade_id": trade_id,
        "price": price,
        "quantity": quantity,
        "trade_time_ms": ms,
        "event_time_ms": ms + 3,
        "is_buyer_maker": False,
        "source": "test",
        "ingested_at_ms": ms + 40,
        **changes,
    }
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def texts(df, *columns):
    """Rows as tuples of text, sorted."""
    picked = df.selectExpr(*[f"cast({c} AS string) AS {c}" for c in columns]) if columns else df
    return sorted(tuple(r) for r in picked.collect())
