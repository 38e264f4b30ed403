from tickloom.streaming.jobs import (
    LIVE_TRIGGER,
    STORE_TRIGGER,
    start_bronze,
    start_event_rejects,
    start_ingest,
    start_live,
    start_parts,
    start_rejects,
    start_rollup,
    start_silver,
)
from tickloom.streaming.sinks import FileTopic, KafkaTopic, batch_writer, candle_writer, parts_writer
from tickloom.streaming.state import open_candles

__all__ = [
    "FileTopic",
    "KafkaTopic",
    "LIVE_TRIGGER",
    "STORE_TRIGGER",
    "batch_writer",
    "candle_writer",
    "open_candles",
    "parts_writer",
    "start_bronze",
    "start_event_rejects",
    "start_ingest",
    "start_live",
    "start_parts",
    "start_rejects",
    "start_rollup",
    "start_silver",
]
