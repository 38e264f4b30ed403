"""The registered queries in plain SQL, for a second engine to check against."""

from __future__ import annotations

from tickloom.plans.registry import (
    EXPIRY_DATE,
    HELD_BACK,
    HISTORY_SYMBOL,
    PARTIAL_BELOW,
    ROUTED_SYMBOLS,
    SLICE_KEYS,
    TOPIC_PARTITIONS,
)
from tickloom.schemas import CANDLE_VALUES

TRADES = """
trades AS (
    SELECT event_type AS symbol, event_id AS trade_id, ts AS trade_time, user_id,
           CAST(value AS DECIMAL(18,8)) AS price,
           CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity,
           json_extract_string(props, '$.k') AS quantity_text,
           epoch_us(ts) // 1000 AS ms
    FROM events
)"""


def candle_cte(name: str, width: str, source: str = "trades", ties: str = "trade_id", where: str = "TRUE") -> str:
    return f"""
{name} AS (
    SELECT time_bucket(INTERVAL '{width}', trade_time) AS window_start,
           time_bucket(INTERVAL '{width}', trade_time) + INTERVAL '{width}' AS window_end,
           symbol,
           arg_min(price, (trade_time, {ties}, price)) AS open,
           max(price) AS high,
           min(price) AS low,
           arg_max(price, (trade_time, {ties}, price)) AS close,
           CAST(sum(quantity) AS DECIMAL(38,8)) AS volume,
           CAST(sum(CAST(price AS DECIMAL(38,8)) * quantity) AS DECIMAL(38,8)) AS quote_volume,
           count(*) AS trade_count
    FROM {source}
    WHERE {where}
    GROUP BY 1, 2, 3
)"""


def rollup_cte(name: str, width: str, source: str) -> str:
    return f"""
{name} AS (
    SELECT time_bucket(INTERVAL '{width}', window_start) AS bucket,
           time_bucket(INTERVAL '{width}', window_start) + INTERVAL '{width}' AS bucket_end,
           symbol,
           arg_min(open, window_start) AS open, max(high) AS high, min(low) AS low,
           arg_max(close, window_start) AS close,
           sum(volume) AS volume, sum(quote_volume) AS quote_volume,
           CAST(sum(trade_count) AS BIGINT) AS trade_count
    FROM {source}
    GROUP BY 1, 2, 3
)"""


VALUES = """CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low,
       CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume,
       CAST(quote_volume AS DOUBLE) AS quote_volume, trade_count"""
CANDLE = f"window_start, window_end, symbol, {VALUES}"
ROLLED = f"bucket AS window_start, bucket_end AS window_end, symbol, {VALUES}"

HOURLY = f"WITH {TRADES}, {candle_cte('candles', '1 hour')}"
MINUTELY = f"WITH {TRADES}, {candle_cte('candles', '1 minute')}"
PARTIAL = candle_cte("partial", "1 hour", where=f"price < {PARTIAL_BELOW}")


def rolled(base: str, width: str) -> str:
    return f"{base}, {rollup_cte('rolled', width, 'candles')} SELECT {ROLLED} FROM rolled"


def json_amount(column: str) -> str:
    """A zero amount prints with its scale, as ``0E-8``."""
    return f"CASE WHEN {column} = 0 THEN '0E-8' ELSE CAST({column} AS VARCHAR) END"


CUT = "cut AS (SELECT * REPLACE (date_trunc('milliseconds', trade_time) AS trade_time) FROM trades)"
CUT_HOURLY = f"WITH {TRADES}, {CUT}, {candle_cte('candles', '1 hour', 'cut')}"
CLOCKS = f"""
clocks AS (SELECT symbol, max(trade_time) AS newest FROM cut WHERE trade_id % {HELD_BACK} <> 0 GROUP BY symbol),
told AS (
    SELECT cut.*, trade_id % {HELD_BACK} = 0 AND time_bucket(INTERVAL '1 hour', trade_time) + INTERVAL '1 hour' <= newest - INTERVAL 10 SECOND AS late
    FROM cut JOIN clocks USING (symbol)
)"""

HISTORY = f"""{MINUTELY}, history AS (
    SELECT * FROM candles
    WHERE symbol = '{HISTORY_SYMBOL}'
      AND window_start >= (SELECT max(window_start) - INTERVAL 6 HOUR FROM candles WHERE symbol = '{HISTORY_SYMBOL}')
    ORDER BY window_start DESC LIMIT 120
)"""

GAPS = """, ordered AS (
    SELECT symbol, window_start,
           lag(window_start) OVER (PARTITION BY symbol ORDER BY window_start) AS previous_start
    FROM candles
)"""

BROKEN = "high < open OR high < close OR high < low OR low > open OR low > close OR volume <= 0 OR trade_count <= 0"

SQL: dict[str, str] = {
    "ohlc_candles": f"{HOURLY} SELECT {CANDLE} FROM candles",
    "ohlc_candles_1m": f"{MINUTELY} SELECT {CANDLE} FROM candles",
    "ohlc_candles_packed": f"{MINUTELY} SELECT {CANDLE} FROM candles",
    "ohlc_candles_lineitem": f"""
        WITH ticks AS (
            SELECT l_returnflag AS symbol, l_orderkey AS trade_id, l_linenumber AS line_number,
                   l_shipdate AS trade_time, CAST(l_extendedprice AS DECIMAL(18,8)) AS price,
                   CAST(l_quantity AS DECIMAL(18,8)) AS quantity
            FROM lineitem
        ), {candle_cte('candles', '1 day', 'ticks', 'trade_id, line_number')}
        SELECT {CANDLE} FROM candles""",
    "event_normalize": f"""
        WITH {TRADES}
        SELECT symbol, trade_id, CAST(price AS VARCHAR) AS price, quantity_text AS quantity,
               ms AS trade_time_ms, ms + 5 AS event_time_ms, user_id > 100 AS is_buyer_maker,
               'binance' AS source
        FROM trades""",
    "trade_decode": f"""
        WITH {TRADES}
        SELECT symbol, trade_id, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
               ms AS trade_time_ms, user_id > 100 AS is_buyer_maker, 'events' AS source,
               ms + 50 + (trade_id * 37) % 900 AS ingested_at_ms,
               date_trunc('milliseconds', trade_time) AS trade_time
        FROM trades""",
    "trade_rejects": """
        SELECT CASE event_type WHEN 'view' THEN 'malformed_message' WHEN 'error' THEN 'bad_price'
                               WHEN 'signup' THEN 'bad_trade_time_ms' ELSE 'valid' END AS reason,
               count(*) AS messages
        FROM events GROUP BY 1""",
    "trade_partitions": """
        SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS dt, CAST(hour(ts) AS INTEGER) AS hour,
               count(*) AS trades
        FROM events GROUP BY 1, 2, 3""",
    "symbol_filter": f"""
        WITH {TRADES}
        SELECT upper(symbol) AS symbol, trade_id, CAST(price AS DOUBLE) AS price
        FROM trades WHERE symbol IN ('click', 'purchase', 'error')""",
    "partition_routing_skew": f"""
        WITH routed AS (
            SELECT CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                                        WHEN 'error' THEN 3 WHEN 'signup' THEN 4 END % {TOPIC_PARTITIONS}
                        AS INTEGER) AS partition
            FROM events
        )
        SELECT partition, count(*) AS messages,
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM routed) AS share
        FROM routed GROUP BY partition""",
    "ingest_lag_stats": f"""
        WITH {TRADES}, lags AS (
            SELECT symbol, date_trunc('day', trade_time) AS window_start, 50 + (trade_id * 37) % 900 AS lag_ms
            FROM trades
        )
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, symbol, count(*) AS trades,
               min(lag_ms) AS min_lag_ms, avg(lag_ms) AS avg_lag_ms,
               round(quantile_cont(lag_ms, 0.5), 6) AS p50_lag_ms,
               round(quantile_cont(lag_ms, 0.95), 6) AS p95_lag_ms,
               max(lag_ms) AS max_lag_ms, count(*) / 86400.0::DOUBLE AS trades_per_second
        FROM lags GROUP BY 1, 2""",
    "kline_decode": f"{HOURLY} SELECT {CANDLE} FROM candles",
    "ohlc_rollup_5m": rolled(MINUTELY, "5 minutes"),
    "ohlc_rollup_15m": rolled(MINUTELY, "15 minutes"),
    "ohlc_rollup_1h": rolled(MINUTELY, "1 hour"),
    "ohlc_rollup_4h": rolled(HOURLY, "4 hours"),
    "ohlc_rollup_12h": rolled(HOURLY, "12 hours"),
    "ohlc_rollup_1d": rolled(HOURLY, "1 day"),
    "dedupe_candles": f"""{HOURLY}, {PARTIAL}, copies AS (
            SELECT * FROM partial UNION ALL SELECT * FROM candles UNION ALL SELECT * FROM candles
        )
        SELECT {CANDLE} FROM copies
        QUALIFY row_number() OVER (
            PARTITION BY symbol, window_start
            ORDER BY trade_count DESC, open DESC, high DESC, low DESC, close DESC, volume DESC, quote_volume DESC
        ) = 1""",
    "backfill_merge": f"""{HOURLY}, {PARTIAL}, copies AS (
            SELECT *, 'stream' AS source, 0 AS rank FROM partial
            UNION ALL SELECT *, 'backfill' AS source, 1 AS rank FROM candles
        )
        SELECT {CANDLE}, source FROM copies
        QUALIFY row_number() OVER (PARTITION BY symbol, window_start ORDER BY trade_count DESC, rank) = 1""",
    "candle_messages": f"""{HOURLY}
        SELECT symbol AS key,
               '{{"window_start":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z')
               || '","window_end":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S.000Z')
               || '","symbol":"' || symbol
               || '","open":' || {json_amount('open')} || ',"high":' || {json_amount('high')}
               || ',"low":' || {json_amount('low')} || ',"close":' || {json_amount('close')}
               || ',"volume":' || {json_amount('volume')} || ',"quote_volume":' || {json_amount('quote_volume')}
               || ',"trade_count":' || CAST(trade_count AS VARCHAR) || '}}' AS value
        FROM candles""",
    "latest_message_per_symbol": f"""{HOURLY}
        SELECT {CANDLE} FROM candles
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""",
    "latest_candle_per_symbol": f"""{HOURLY}
        SELECT {CANDLE} FROM candles
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""",
    "history_slice": f"""{HISTORY}
        SELECT window_start, symbol, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
               CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume,
               trade_count
        FROM history ORDER BY window_start""",
    "history_summary": f"""{HISTORY}
        SELECT count(*) AS candles, CAST(coalesce(sum(trade_count), 0) AS BIGINT) AS trades FROM history""",
    "history_display": f"""{HOURLY}
        SELECT symbol, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_text,
               format('{{:,.2f}}', CAST(open AS DOUBLE)) AS open_text,
               format('{{:,.2f}}', CAST(high AS DOUBLE)) AS high_text,
               format('{{:,.2f}}', CAST(low AS DOUBLE)) AS low_text,
               format('{{:,.2f}}', CAST(close AS DOUBLE)) AS close_text,
               format('{{:,.2f}}', CAST(quote_volume AS DOUBLE)) AS quote_volume_text,
               format('{{:,}}', trade_count) AS trades_text
        FROM candles
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) = 1""",
    "hour_range_slice": f"""{HOURLY}
        SELECT symbol, strftime(window_start, '%Y-%m-%d') AS dt, CAST(hour(window_start) AS INTEGER) AS hour,
               window_start, CAST(close AS DOUBLE) AS close, trade_count
        FROM candles
        WHERE window_start >= strptime('{SLICE_KEYS[0]}', '%Y-%m-%d-%H:%M')
          AND window_start < strptime('{SLICE_KEYS[1]}', '%Y-%m-%d-%H:%M') + INTERVAL 1 HOUR""",
    "ohlc_invariant_violations": f"""{HOURLY}
        SELECT count(*) AS candles,
               count(*) FILTER ({BROKEN}) AS violations,
               count(*) FILTER (high < open) AS high_below_open,
               count(*) FILTER (high < close) AS high_below_close,
               count(*) FILTER (high < low) AS high_below_low,
               count(*) FILTER (low > open) AS low_above_open,
               count(*) FILTER (low > close) AS low_above_close,
               count(*) FILTER (volume <= 0) AS volume_not_positive,
               count(*) FILTER (trade_count <= 0) AS no_trades,
               count(*) FILTER (symbol IS NULL OR window_start IS NULL OR open IS NULL OR high IS NULL
                                OR low IS NULL OR close IS NULL OR volume IS NULL OR quote_volume IS NULL
                                OR trade_count IS NULL) AS null_values
        FROM candles""",
    "ohlc_invariant_rows": f"""{HOURLY}
        SELECT symbol, window_start,
               concat_ws(',', CASE WHEN high < open THEN 'high_below_open' END,
                              CASE WHEN high < close THEN 'high_below_close' END,
                              CASE WHEN high < low THEN 'high_below_low' END,
                              CASE WHEN low > open THEN 'low_above_open' END,
                              CASE WHEN low > close THEN 'low_above_close' END,
                              CASE WHEN volume <= 0 THEN 'volume_not_positive' END,
                              CASE WHEN trade_count <= 0 THEN 'no_trades' END) AS broken_rules
        FROM candles WHERE {BROKEN}""",
    "candle_gaps": f"""{HOURLY} {GAPS}
        SELECT symbol, previous_start, window_start,
               date_diff('hour', previous_start, window_start) - 1 AS missing
        FROM ordered
        WHERE previous_start IS NOT NULL AND date_diff('hour', previous_start, window_start) > 1""",
    "candle_gap_count": f"""{MINUTELY} {GAPS}
        SELECT count(*) AS gaps,
               CAST(coalesce(sum(date_diff('minute', previous_start, window_start) - 1), 0) AS BIGINT) AS missing
        FROM ordered
        WHERE previous_start IS NOT NULL AND date_diff('minute', previous_start, window_start) > 1""",
    "missing_hours": f"""{HOURLY}, bounds AS (
            SELECT symbol, min(window_start) AS lo, max(window_start) AS hi FROM candles GROUP BY symbol
        ), grid AS (
            SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_start FROM bounds
        )
        SELECT symbol, hour_start FROM grid
        ANTI JOIN candles ON grid.symbol = candles.symbol AND grid.hour_start = candles.window_start""",
    "expired_partitions": f"""
        SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS rows
        FROM events WHERE CAST(ts AS DATE) < DATE '{EXPIRY_DATE}' - 7
        GROUP BY 1, 2""",
    "compaction_report": f"""{HOURLY}, {PARTIAL}
        SELECT (SELECT count(DISTINCT CAST(window_start AS DATE)) FROM partial)
               + (SELECT count(DISTINCT CAST(window_start AS DATE)) FROM candles) AS files_before,
               (SELECT count(DISTINCT (symbol, CAST(window_start AS DATE))) FROM candles) AS files_after,
               (SELECT count(*) FROM partial) + (SELECT count(*) FROM candles) AS rows_before,
               (SELECT count(*) FROM candles) AS rows_after,
               'all' AS hours""",
    "gold_candles": f"""{HOURLY}, {rollup_cte('rolled_4h', '4 hours', 'candles')},
        {rollup_cte('rolled_1d', '1 day', 'candles')}
        SELECT {ROLLED}, strftime(bucket, '%Y-%m-%d') AS dt, '4h' AS resolution FROM rolled_4h
        UNION ALL
        SELECT {ROLLED}, strftime(bucket, '%Y-%m-%d') AS dt, '1d' AS resolution FROM rolled_1d""",
    "stream_closed_candles": f"""
        WITH {TRADES}, cut AS (
            SELECT * REPLACE (date_trunc('milliseconds', trade_time) AS trade_time) FROM trades
        ), {candle_cte('candles', '1 hour', 'cut')}
        SELECT {CANDLE} FROM candles
        WHERE window_end <= (SELECT max(trade_time) - INTERVAL 10 SECOND FROM cut)""",
    "stream_live_candles": f"""
        WITH {TRADES}, cut AS (
            SELECT * REPLACE (date_trunc('milliseconds', trade_time) AS trade_time) FROM trades
        ), {candle_cte('candles', '1 hour', 'cut')}
        SELECT {CANDLE} FROM candles""",
    "lake_backfill": f"{HOURLY} SELECT {CANDLE} FROM candles",
    "stream_ingest": f"""
        WITH {TRADES}
        SELECT upper(symbol) AS key,
               CAST(CASE symbol WHEN 'click' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS INTEGER) AS partition,
               trade_id, CAST(price AS DOUBLE) AS price,
               date_trunc('milliseconds', trade_time) AS trade_time, TRUE AS stamped
        FROM trades WHERE symbol IN ('click', 'purchase', 'error')""",
    "stream_rejects": """
        SELECT CASE event_type WHEN 'view' THEN 'malformed_message' WHEN 'error' THEN 'bad_price'
                               ELSE 'bad_trade_time_ms' END AS reason,
               count(*) AS messages,
               CAST(sum(CASE WHEN event_type = 'view' THEN 0 ELSE event_id END) AS BIGINT) AS trade_ids
        FROM events WHERE event_type IN ('view', 'error', 'signup')
        GROUP BY 1""",
    "retention_drop": f"""
        WITH {TRADES}, days AS (
            SELECT symbol, CAST(trade_time AS DATE) AS day, count(*) AS rows FROM trades
            WHERE symbol NOT IN ('view', 'error', 'signup') GROUP BY 1, 2
        ), sides AS (
            SELECT 'reported' AS what, symbol, day, rows FROM days WHERE day < DATE '{EXPIRY_DATE}' - 7
            UNION ALL SELECT 'dropped', symbol, day, NULL FROM days WHERE day < DATE '{EXPIRY_DATE}' - 7
            UNION ALL SELECT 'left', symbol, day, rows FROM days WHERE day >= DATE '{EXPIRY_DATE}' - 7
        )
        SELECT what, 'trades' AS "table", symbol, strftime(day, '%Y-%m-%d') AS dt, rows FROM sides
        UNION ALL
        SELECT 'left', 'rejects_trades', CASE event_type WHEN 'view' THEN 'malformed_message' WHEN 'error' THEN 'bad_price'
                                                         ELSE 'bad_trade_time_ms' END, NULL, count(*)
        FROM events WHERE event_type IN ('view', 'error', 'signup') GROUP BY 3""",
    "event_rejects": """
        SELECT CASE event_type WHEN 'view' THEN 'malformed_event' WHEN 'error' THEN 'bad_price'
                               WHEN 'signup' THEN 'bad_trade_id' ELSE 'valid' END AS reason,
               count(*) AS events
        FROM events GROUP BY 1""",
    "kline_rejects": f"""{HOURLY}
        SELECT CASE symbol WHEN 'error' THEN 'bad_window_start' WHEN 'signup' THEN 'bad_trade_count' ELSE 'valid' END AS reason,
               count(*) AS klines
        FROM candles WHERE symbol <> 'view' GROUP BY 1
        UNION ALL
        SELECT 'malformed_kline', count(DISTINCT CAST(window_start AS DATE)) FROM candles WHERE symbol = 'view'
        HAVING count(*) > 0""",
    "history_lake": f"""{HISTORY}
        SELECT window_start, symbol, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high,
               CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume,
               trade_count
        FROM history""",
    "missing_hours_lake": f"""{HOURLY}, bounds AS (
            SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events
        ), kept AS (SELECT * FROM candles WHERE hour(window_start) % 5 <> 0),
        grid AS (
            SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_start
            FROM (SELECT DISTINCT symbol FROM kept), bounds
        )
        SELECT symbol, CAST(hour_start AS TIMESTAMP) AS hour_start FROM grid
        ANTI JOIN kept ON grid.symbol = kept.symbol AND grid.hour_start = kept.window_start""",
    "ingest_lag_approx": f"""
        WITH {TRADES}
        SELECT symbol, CAST(date_trunc('day', trade_time) AS TIMESTAMP) AS window_start, count(*) AS trades,
               TRUE AS p50_lag_ms_close, TRUE AS p95_lag_ms_close
        FROM trades GROUP BY 1, 2""",
    "repeated_batch": f"{HOURLY} SELECT {CANDLE} FROM candles",
    "stream_late_rows": f"""
        WITH {TRADES}, cut AS (
            SELECT * REPLACE (date_trunc('milliseconds', trade_time) AS trade_time) FROM trades
        ), {candle_cte('candles', '1 hour', 'cut')}
        SELECT {CANDLE} FROM candles
        WHERE window_end <= (SELECT max(trade_time) - INTERVAL 10 SECOND FROM cut)""",
    "stream_bronze_archive": f"""
        WITH {TRADES}
        SELECT symbol, strftime(trade_time, '%Y-%m-%d') AS dt, trade_id, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
               date_trunc('milliseconds', trade_time) AS trade_time
        FROM trades""",
    "stream_distinct_trades": f"""
        WITH {TRADES}
        SELECT symbol, strftime(trade_time, '%Y-%m-%d') AS dt, trade_id, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
               date_trunc('milliseconds', trade_time) AS trade_time
        FROM trades""",
    "stream_distinct_candles": f"""{CUT_HOURLY}
        SELECT {CANDLE} FROM candles
        WHERE window_end <= (SELECT max(trade_time) - INTERVAL 10 SECOND FROM cut)""",
    "stream_late_trades": f"""{CUT_HOURLY}, {CLOCKS}
        SELECT symbol, count(*) AS sent, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late,
               CAST(sum(trade_id) FILTER (late) AS BIGINT) AS late_ids, TRUE AS whole
        FROM told GROUP BY symbol""",
    "stream_amended_candles": f"""{CUT_HOURLY}, {CLOCKS}, in_time AS (
            SELECT symbol, time_bucket(INTERVAL '1 hour', trade_time) AS window_start, count(*) FILTER (NOT late) AS in_time FROM told GROUP BY ALL
        )
        SELECT {CANDLE}, in_time FROM candles JOIN in_time USING (symbol, window_start)""",
    "partial_merge": f"{HOURLY} SELECT {CANDLE} FROM candles",
    "stream_rollup": f"""
        WITH {TRADES}, {CUT}, {candle_cte('fine', '1 minute', 'cut')}, {rollup_cte('middle_rows', '5 minutes', 'fine')},
        middle AS (SELECT * RENAME (bucket AS window_start, bucket_end AS window_end) FROM middle_rows),
        {rollup_cte('rolled', '1 hour', 'middle')}
        SELECT {ROLLED} FROM rolled WHERE bucket_end <= (SELECT max(trade_time) - INTERVAL 10 SECOND FROM cut)""",
    "stream_open_candles": f"""{CUT_HOURLY}
        SELECT {CANDLE}, window_end <= (SELECT max(trade_time) - INTERVAL 10 SECOND FROM cut) AS closed FROM candles""",
    "lag_sketch_quantiles": f"""
        WITH {TRADES}
        SELECT symbol, date_trunc('day', trade_time) AS window_start, count(*) AS trades,
               min(50 + trade_id * 37 % 900) AS min_lag_ms, max(50 + trade_id * 37 % 900) AS max_lag_ms, TRUE AS p50_lag_ms_close, TRUE AS p95_lag_ms_close
        FROM trades GROUP BY 1, 2""",
    "partition_routing_balanced": f"""
        WITH RECURSIVE {TRADES}, loads AS (
            SELECT symbol, load, place, row_number() OVER (ORDER BY load DESC, symbol) AS turn
            FROM (SELECT upper(symbol) AS symbol, count(*) AS load FROM trades GROUP BY 1) JOIN
                 (SELECT upper(unnest(string_split('{ROUTED_SYMBOLS}', ','))) AS symbol, generate_subscripts(string_split('{ROUTED_SYMBOLS}', ','), 1) - 1 AS place) USING (symbol)
        ),
        dealt AS (
            SELECT CAST(0 AS BIGINT) AS turn, list_transform(range({TOPIC_PARTITIONS}), lambda x: CAST(0 AS BIGINT)) AS filled, CAST(NULL AS VARCHAR) AS symbol, CAST(NULL AS BIGINT) AS partition, CAST(0 AS BIGINT) AS load
            UNION ALL
            SELECT l.turn, list_transform(filled, lambda x, i: CASE WHEN i = list_position(filled, list_min(filled)) THEN x + l.load ELSE x END), l.symbol, list_position(filled, list_min(filled)) - 1, l.load
            FROM dealt JOIN loads l ON l.turn = dealt.turn + 1
        ),
        listed AS (SELECT symbol, place % {TOPIC_PARTITIONS} AS partition, load FROM loads),
        better AS (
            SELECT (SELECT max(s) FROM (SELECT sum(load) AS s FROM listed GROUP BY partition)) < (SELECT list_max(filled) FROM dealt ORDER BY turn DESC LIMIT 1) AS keep_list
        )
        SELECT symbol, CAST(partition AS INTEGER) AS partition, load FROM listed WHERE (SELECT keep_list FROM better)
        UNION ALL
        SELECT symbol, CAST(partition AS INTEGER), load FROM dealt WHERE turn > 0 AND NOT (SELECT keep_list FROM better)""",
    "replayed_hours": f"""
        WITH {TRADES}, {CUT}, {candle_cte('candles', '1 minute', 'cut')}
        SELECT {CANDLE} FROM candles""",
    "source_differences": f"""{HOURLY}, {PARTIAL}, pages AS (SELECT * FROM candles WHERE hour(window_start) % 5 <> 0)
        SELECT * FROM (
            SELECT coalesce(p.symbol, s.symbol) AS symbol, coalesce(p.window_start, s.window_start) AS window_start,
                   CASE WHEN p.symbol IS NULL THEN 'only_stream' WHEN s.symbol IS NULL THEN 'only_backfill' ELSE 'differs' END AS status,
                   CASE WHEN p.symbol IS NULL OR s.symbol IS NULL THEN '' ELSE concat_ws(',',
                       {", ".join(f"CASE WHEN s.{c} IS DISTINCT FROM p.{c} THEN '{c}' END" for c in ("window_end", *CANDLE_VALUES))}) END AS fields,
                   s.trade_count AS stream_trades, p.trade_count AS backfill_trades
            FROM partial s FULL JOIN pages p ON s.symbol = p.symbol AND s.window_start = p.window_start
        ) WHERE status <> 'differs' OR fields <> ''""",
}
