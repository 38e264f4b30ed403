from tickloom.operators.backfill import decode_klines, kline_reject_reason, split_klines
from tickloom.operators.candles import build_candles, chained_rollups, rollup_candles
from tickloom.operators.decode import decode_trades, normalize_events, reject_reason, split_events, split_trades
from tickloom.operators.dedupe import compare_sources, dedupe_candles, merge_sources, tag_sources
from tickloom.operators.messages import candle_messages, trade_messages
from tickloom.operators.partials import distinct_trades, finish_partials, merge_partials, partial_candles
from tickloom.operators.quality import (
    candle_gaps,
    gap_count,
    invariant_report,
    invariant_violations,
    missing_hours,
    summarize_gaps,
)
from tickloom.operators.retention import expired_partitions
from tickloom.operators.routing import (
    assign_by_load,
    keep_symbols,
    lag_stats,
    measured_loads,
    parse_symbols,
    partition_skew,
    route_by_load,
    route_symbols,
)
from tickloom.operators.serve import candle_history, history_summary, latest_candles, latest_messages
from tickloom.operators.sketches import lag_quantiles, lag_sketches, merge_lag_sketches, rank_error

__all__ = [
    "assign_by_load",
    "build_candles",
    "candle_gaps",
    "candle_history",
    "candle_messages",
    "chained_rollups",
    "compare_sources",
    "decode_klines",
    "decode_trades",
    "dedupe_candles",
    "distinct_trades",
    "expired_partitions",
    "finish_partials",
    "gap_count",
    "history_summary",
    "invariant_report",
    "invariant_violations",
    "keep_symbols",
    "kline_reject_reason",
    "lag_quantiles",
    "lag_sketches",
    "lag_stats",
    "latest_candles",
    "latest_messages",
    "measured_loads",
    "merge_lag_sketches",
    "merge_partials",
    "merge_sources",
    "missing_hours",
    "normalize_events",
    "parse_symbols",
    "partial_candles",
    "partition_skew",
    "rank_error",
    "reject_reason",
    "rollup_candles",
    "route_by_load",
    "route_symbols",
    "split_events",
    "split_klines",
    "split_trades",
    "summarize_gaps",
    "tag_sources",
    "trade_messages",
]
