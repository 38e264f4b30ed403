"""Data checks over compacted candles."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import candle_gaps, invariant_report, missing_hours, summarize_gaps
from tickloom.schemas import conform
from tickloom.session import shared_dir
from tickloom.sources.lake import HourRange, Lake, Table


@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    blocking: bool
    metrics: dict[str, int] = field(default_factory=dict)


class CheckFailed(Exception):
    """A blocking check found violations; downstream steps must not run."""

    def __init__(self, result: CheckResult) -> None:
        super().__init__(f"{result.name}: {result.metrics}")
        self.result = result


def check_invariants(candles: DataFrame) -> CheckResult:
    """Blocking: high and low bound open and close, volume and count are positive."""
    metrics = invariant_report(candles).first().asDict()
    passed = metrics["violations"] == 0 and metrics["null_values"] == 0
    return CheckResult("ohlc_invariants", passed, True, metrics)


def check_gaps(
    candles: DataFrame, unit: str = "1 minute", hours: HourRange | None = None
) -> CheckResult:
    """Not blocking: candles of a symbol follow each other without a missing unit.

    With ``hours`` only gaps that end inside them count; ``candles`` should
    then reach back further, or the gap before the first candle goes unseen.
    """
    gaps = candle_gaps(candles, unit)
    if hours is not None:
        gaps = gaps.filter(hours.covers("window_start"))
    metrics = summarize_gaps(gaps).first().asDict()
    return CheckResult("no_gaps", metrics["gaps"] == 0, False, metrics)


def check_hours(spark: SparkSession, lake: Lake, hours: HourRange) -> list[CheckResult]:
    """Both checks over the compacted candles of some hours.

    A gap may have begun at any time before them: each symbol's last candle
    before the hours is read along.
    """
    own = lake.compacted.read(spark, hours)
    starts = own.select("symbol", "window_start").unionByName(last_before(spark, lake.compacted, hours.start, own.select("symbol").distinct()))
    return [check_invariants(own), check_gaps(starts, hours=hours)]


def last_before(spark: SparkSession, table: Table, start: datetime, symbols: DataFrame) -> DataFrame:
    """(symbol, window_start) of each symbol's last candle before ``start``, if it has one.

    The day of the start is searched first, then spans of 1, 2, 4, ... days
    before it, each for the symbols not found yet, down to the table's first day.
    """
    oldest = min((day for day, _ in table.day_folders(spark)), default=None)
    found = spark.createDataFrame([], "symbol string, window_start timestamp")
    if oldest is None:
        return found
    first = datetime.combine(oldest, time())
    end, step = start, start - datetime.combine(start.date(), time())
    if not step:
        step = timedelta(days=1)
    folder = shared_dir(spark, "last-before")
    missing, turn = _kept(symbols, f"{folder}/missing-0"), 0
    while end > first and not missing.isEmpty():
        span, turn = HourRange(max(first, end - step), end), turn + 1
        last = conform(table.read(spark, span)).join(missing, "symbol", "left_semi").groupBy("symbol").agg(F.max("window_start").alias("window_start"))
        # each turn is written: the next must not compute the earlier ones again
        last = _kept(last, f"{folder}/found-{turn}")
        found = found.unionByName(last)
        missing = _kept(missing.join(last, "symbol", "left_anti"), f"{folder}/missing-{turn}")
        end, step = span.start, max(timedelta(days=1), step * 2 if step >= timedelta(days=1) else timedelta(days=1))
    return found


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_missing_hours(spark: SparkSession, lake: Lake, hours: HourRange, symbols: DataFrame | None = None) -> DataFrame:
    """(symbol, hour_start) of the hours without a compacted candle: the worklist of a backfill.

    ``symbols`` defaults to all that the compacted table has folders of in these
    hours. Hour-grained tables are answered from folder names and footers.
    """
    candles = lake.compacted.read(spark, hours)
    if "hour" in lake.compacted.partition_by:
        moment = F.to_timestamp(F.concat_ws(" ", F.col("dt").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0")), "yyyy-MM-dd HH")
        candles = candles.select("symbol", moment.alias("window_start"))
    wanted = candles.select("symbol").distinct() if symbols is None else symbols
    last = hours.end - timedelta(hours=1)
    return missing_hours(candles.filter(hours.covers("window_start")), wanted, f"{hours.start:%Y-%m-%d %H:%M:%S}", f"{last:%Y-%m-%d %H:%M:%S}")


def require(result: CheckResult) -> CheckResult:
    if result.blocking and not result.passed:
        raise CheckFailed(result)
    return result
