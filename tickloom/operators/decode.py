"""From message text to typed trades, with a reject path for bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import PRICE_TYPE, TRADE_MESSAGE_SCHEMA

# One-letter keys of the exchange's trade event and their names.
EVENT_KEYS = {
    "s": "symbol",
    "t": "trade_id",
    "p": "price",
    "q": "quantity",
    "T": "trade_time_ms",
    "E": "event_time_ms",
    "m": "is_buyer_maker",
}
EVENT_SOURCE = "binance"

# timestamp_millis fails on values past the calendar; 9999-12-31 is the last
# date every reader agrees on.
MAX_MS = 253_402_300_799_999

REQUIRED = ("symbol", "trade_id", "price", "quantity", "trade_time_ms")


def normalize_events(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Exchange envelopes ``{"data": {...}}`` to the trade message columns.

    The payload is read as a map because its keys differ only in case
    (``t``/``T``), which struct field access would call ambiguous.
    """
    types = {f.name: f.dataType for f in TRADE_MESSAGE_SCHEMA}
    payload = F.from_json(F.col(value).cast("string"), "data map<string,string>")["data"]
    return raw.select(payload.alias("payload"), *keep).select(
        *[F.col("payload")[key].try_cast(types[name]).alias(name) for key, name in EVENT_KEYS.items()],
        F.lit(EVENT_SOURCE).alias("source"),
        *keep,
    )


def split_events(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Exchange events that make a trade message, and rejects (``value``, ``reason``); every event is in one of them.

    An event is usable when every field a candle needs is there; its values are
    judged later, where messages are decoded.
    """
    text = raw.withColumn("text", F.col(value).cast("string"))
    decoded = normalize_events(text, "text", keep=("text",))
    fields = list(EVENT_KEYS.values())
    nothing = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
    reason = F.when(nothing, "malformed_event")
    for name in REQUIRED:
        reason = reason.when(F.col(name).isNull(), f"bad_{name}")
    tagged = decoded.withColumn("reason", reason)
    usable = tagged.filter("reason IS NULL").drop("reason", "text")
    return usable, tagged.filter("reason IS NOT NULL").select(F.col("text").alias("value"), "reason")


def decode_trades(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON trade messages (bytes or text) to typed trades.

    A row that does not parse comes out with nulls rather than failing the
    job; :func:`split_trades` separates those. ``keep`` carries input columns
    through.

    The parsed struct is unpacked by a generator, not by field access: filters
    on its fields then stay above the parse. Pushed below it, each mention of
    a field would parse the message again.
    """
    ms = F.col("trade_time_ms")
    parsed = F.from_json(F.col(value).cast("string"), TRADE_MESSAGE_SCHEMA)
    return (
        raw.select(*keep, F.inline_outer(F.array(parsed)))
        .select(*TRADE_MESSAGE_SCHEMA.fieldNames(), *keep)
        .withColumns(
            {
                "price": F.col("price").try_cast(PRICE_TYPE),
                "quantity": F.col("quantity").try_cast(PRICE_TYPE),
                "trade_time": F.when(ms.between(-MAX_MS, MAX_MS), F.timestamp_millis(ms)),
            }
        )
        .drop("event_time_ms")
    )


def is_usable() -> Column:
    """Whether a decoded row has everything a candle needs."""
    usable = F.col("trade_time").isNotNull()
    for name in REQUIRED:
        usable = usable & F.col(name).isNotNull()
    return usable


def reject_reason() -> Column:
    """What a decoded row lacks, null for a usable row."""
    nothing = F.coalesce(*[F.col(c).cast("string") for c in REQUIRED]).isNull()
    reason = F.when(is_usable(), F.lit(None).cast("string")).when(nothing, "malformed_message")
    for name in REQUIRED:
        reason = reason.when(F.col(name).isNull(), f"bad_{name}")
    return reason.otherwise("bad_trade_time_ms")


def split_trades(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable trades, and rejects with a ``reason`` column; every row is in one of them."""
    return decoded.filter(is_usable()), decoded.filter(~is_usable()).withColumn("reason", reject_reason())
