from tickloom.sources.lake import HourRange, Lake, Table
from tickloom.sources.messages import MessageSource, file_messages, kafka_messages
from tickloom.sources.tables import event_trades, lineitem_trades, read_table

__all__ = [
    "HourRange",
    "Lake",
    "MessageSource",
    "Table",
    "event_trades",
    "file_messages",
    "kafka_messages",
    "lineitem_trades",
    "read_table",
]
