"""Ingest lag as quantile sketches that are kept and merged to any span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Accuracy of a sketch: its ranks are off by about 2.3 / k^0.9 of the rows, a third of a percent here.
SKETCH_K = 1600


def rank_error(k: int = SKETCH_K) -> float:
    """The share of the rows that a rank is off by at most, with 99 percent confidence."""
    return 2.296 / k**0.9021


def lag_sketches(trades: DataFrame, width: str = "1 minute", k: int = SKETCH_K) -> DataFrame:
    """For each window of trade time and symbol: ``trades``, least, greatest and summed lag, and a ``sketch`` of the lags.

    Trades without an ingest time have no lag and are not counted. A sketch has
    a fixed size and is built on the map side; below ``k`` lags it is exact.
    """
    lag = F.col("ingested_at_ms") - F.col("trade_time_ms")
    return (
        trades.withColumn("lag_ms", lag)
        .filter("lag_ms IS NOT NULL AND trade_time IS NOT NULL")
        .groupBy(F.window("trade_time", width).start.alias("window_start"), "symbol")
        .agg(
            F.count("*").alias("trades"),
            F.min("lag_ms").alias("min_lag_ms"),
            F.max("lag_ms").alias("max_lag_ms"),
            F.sum("lag_ms").alias("sum_lag_ms"),
            F.kll_sketch_agg_bigint("lag_ms", F.lit(k)).alias("sketch"),
        )
    )


def merge_lag_sketches(sketches: DataFrame, width: str, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The same columns for wider windows, or over all symbols with ``by=()``; the trades are not read again."""
    return sketches.groupBy(F.window("window_start", width).start.alias("window_start"), *by).agg(
        F.sum("trades").alias("trades"),
        F.min("min_lag_ms").alias("min_lag_ms"),
        F.max("max_lag_ms").alias("max_lag_ms"),
        F.sum("sum_lag_ms").alias("sum_lag_ms"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )


def lag_quantiles(sketches: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Quantiles and mean of the lags behind each sketch."""
    quantiles = {"p50": 0.5, "p95": 0.95} if quantiles is None else quantiles
    found = {f"{name}_lag_ms": F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)) for name, q in quantiles.items()}
    return sketches.withColumns(found).withColumn("avg_lag_ms", F.col("sum_lag_ms") / F.col("trades")).drop("sketch", "sum_lag_ms")
