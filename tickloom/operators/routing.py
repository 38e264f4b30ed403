"""Symbol lists, topic partition routing and ingest lag."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import width_seconds


def parse_symbols(text: str) -> list[str]:
    """A comma-separated setting as clean lower-case symbols."""
    return [part.strip().lower() for part in text.split(",") if part.strip()]


def keep_symbols(trades: DataFrame, symbols: list[str]) -> DataFrame:
    """Restrict to listed symbols, however they are spelled."""
    return trades.filter(F.upper("symbol").isin([s.upper() for s in symbols]))


def route_symbols(rows: DataFrame, symbols: list[str], partitions: int) -> DataFrame:
    """Add ``partition``: position in the symbol list modulo the partition count.

    Hashing a handful of keys onto a handful of partitions collides; a fixed
    mapping does not. A symbol outside the list gets null, which leaves the
    choice to the sink's own partitioner.
    """
    listed = F.array(*[F.lit(s.upper()) for s in symbols])
    position = F.nullif(F.array_position(listed, F.upper("symbol")), F.lit(0)) - 1
    return rows.withColumn("partition", F.pmod(position, F.lit(partitions)).cast("int"))


def assign_by_load(loads: dict[str, int], partitions: int) -> dict[str, int]:
    """A partition for each symbol: the heaviest first, each to the partition with the least so far.

    Ties go to the smaller symbol and the smaller partition. Where the position
    in the list modulo the partitions would leave the fullest partition less,
    that assignment is taken: ``loads`` is in list order.
    """
    filled = [(0, p) for p in range(partitions)]
    greedy = {}
    for symbol, load in sorted(loads.items(), key=lambda item: (-item[1], item[0])):
        total, partition = heapq.heappop(filled)
        greedy[symbol] = partition
        heapq.heappush(filled, (total + load, partition))
    listed = {symbol: k % partitions for k, symbol in enumerate(loads)}

    def fullest(routes: dict[str, int]) -> int:
        return max((sum(loads[s] for s in routes if routes[s] == p) for p in range(partitions)), default=0)

    return listed if fullest(listed) < fullest(greedy) else greedy


def measured_loads(rows: DataFrame, symbols: list[str]) -> dict[str, int]:
    """Rows of each listed symbol (upper case), in list order; as many numbers as there are symbols in the list."""
    listed = list(dict.fromkeys(s.upper() for s in symbols))
    counts = keep_symbols(rows, symbols).groupBy(F.upper("symbol").alias("symbol")).agg(F.count("*").alias("n"))
    found = {r.symbol: r.n for r in counts.collect()}
    return {s: found.get(s, 0) for s in listed}


def route_by_load(rows: DataFrame, routes: dict[str, int]) -> DataFrame:
    """Add ``partition`` by a table of :func:`assign_by_load`; a symbol outside it gets null, as in :func:`route_symbols`."""
    if not routes:
        return rows.withColumn("partition", F.lit(None).cast("int"))
    table = F.create_map(*[F.lit(x) for item in routes.items() for x in item])
    return rows.withColumn("partition", F.try_element_at(table, F.upper("symbol")).cast("int"))


def partition_skew(routed: DataFrame) -> DataFrame:
    """Messages and share of all messages per topic partition."""
    counts = routed.groupBy("partition").agg(F.count("*").alias("messages"))
    # one row per topic partition is left, so the total fits a single task
    return counts.withColumn("share", F.col("messages") / F.sum("messages").over(Window.partitionBy()))


def lag_stats(
    trades: DataFrame,
    width: str = "1 minute",
    by: tuple[str, ...] = (),
    quantiles: dict[str, float] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Ingest lag (ms) and trades per second, per window of trade time.

    Approximate quantiles keep a fixed-size sketch per group. Exact ones hold
    one counter per distinct millisecond value, so they suit bounded lags.
    """
    quantiles = {"p50": 0.5, "p95": 0.95} if quantiles is None else quantiles
    quantile = F.percentile if exact else F.percentile_approx
    measures = {
        "trades": F.count("*"),
        "min_lag_ms": F.min("lag_ms"),
        "avg_lag_ms": F.avg("lag_ms"),
        **{f"{name}_lag_ms": quantile("lag_ms", q).cast("double") for name, q in quantiles.items()},
        "max_lag_ms": F.max("lag_ms"),
        "trades_per_second": F.count("*") / F.lit(width_seconds(width)),
    }
    return (
        trades.withColumn("lag_ms", F.col("ingested_at_ms") - F.col("trade_time_ms"))
        .groupBy(F.window("trade_time", width).alias("w"), *by)
        .agg(*[column.alias(name) for name, column in measures.items()])
        .select(F.col("w.start").alias("window_start"), *by, *measures)
    )
