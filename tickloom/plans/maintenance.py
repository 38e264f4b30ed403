"""The hourly run: compact, check, roll up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans.checks import CheckResult, check_hours, require
from tickloom.plans.compaction import backfill, compact
from tickloom.plans.rollups import RESOLUTIONS, rollup
from tickloom.sources.lake import HourRange, Lake


@dataclass(frozen=True)
class MaintenanceReport:
    compaction: dict
    checks: list[CheckResult]
    rollups: dict[str, int]


def maintain(
    spark: SparkSession,
    lake: Lake,
    hours: HourRange,
    pages: DataFrame | None = None,
    resolutions: tuple[str, ...] = RESOLUTIONS,
) -> MaintenanceReport:
    """Bring the given hours from streamed (and optionally backfilled) candles to gold.

    Raises ``CheckFailed`` before anything reaches gold when an invariant is
    broken. Rerunning the same hours is safe.
    """
    if pages is not None:
        backfill(spark, lake, pages, hours)
    compaction = compact(spark, lake, hours).first().asDict()
    checks = [require(result) for result in check_hours(spark, lake, lake.span(hours))]
    return MaintenanceReport(compaction, checks, rollup(spark, lake, hours, resolutions))
