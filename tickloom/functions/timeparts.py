"""Time arithmetic shared by operators and jobs."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: format of an hour partition key, in UTC.
HOUR_KEY_FORMAT = "%Y-%m-%d-%H:%M"

_UNIT_SECONDS = {"s": 1, "second": 1, "m": 60, "minute": 60, "h": 3600, "hour": 3600, "d": 86400, "day": 86400}


def width_seconds(width: str) -> int:
    """Seconds of a width such as ``5m``, ``1h``, ``15 minutes`` or ``1 day``."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", width.lower())
    unit = match[2] if match else ""
    if unit not in _UNIT_SECONDS:
        unit = unit.removesuffix("s")
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"not a fixed time width: {width!r}")
    return int(match[1]) * _UNIT_SECONDS[unit]


def interval(width: str) -> Column:
    """``width`` as elapsed time, so a day is 24 hours in every session zone."""
    return F.expr(f"INTERVAL {width_seconds(width)} SECOND")


def parse_hour_key(key: str) -> datetime:
    """``2026-08-05-17:00`` as the naive UTC start of that hour."""
    return datetime.strptime(key, HOUR_KEY_FORMAT).replace(minute=0)


def hour_key(start: datetime) -> str:
    return start.replace(minute=0).strftime(HOUR_KEY_FORMAT)


def hour_floor(moment: datetime, width: int = 3600) -> datetime:
    """``moment`` rounded down to a multiple of ``width`` seconds since 1970."""
    epoch = datetime(1970, 1, 1)
    return epoch + timedelta(seconds=int((moment - epoch).total_seconds()) // width * width)


def dt_hour(df: DataFrame, time_column: str) -> DataFrame:
    """Add the ``dt`` and ``hour`` partition columns of ``time_column``."""
    return df.withColumns({"dt": F.to_date(time_column), "hour": F.hour(time_column)})


def unit_index(moment: Column, seconds: int) -> Column:
    """Number of whole units since 1970 (floor, also before 1970).

    Needs a UTC session for ``timestamp_ntz`` input, as the whole lake does.
    """
    return F.floor(F.unix_seconds(moment.cast("timestamp")) / F.lit(seconds)).cast("long")


def boundaries_between(earlier: Column, later: Column, seconds: int) -> Column:
    """Unit boundaries crossed: 00:00:59 to 00:01:01 is one minute boundary."""
    return unit_index(later, seconds) - unit_index(earlier, seconds)
