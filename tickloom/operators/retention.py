"""Which partitions of the raw archive have outlived their keep time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: days raw trades are kept by default.
DEFAULT_KEEP_DAYS = 7


def expired_partitions(archive: DataFrame, as_of: date | str, keep_days: int = DEFAULT_KEEP_DAYS) -> DataFrame:
    """(symbol, dt) with its row count for days more than ``keep_days`` before ``as_of``.

    ``dt`` and ``symbol`` are partition columns of the archive, so only the
    footers of expired files are read.
    """
    cutoff = F.date_sub(F.to_date(F.lit(str(as_of))), keep_days)
    return archive.filter(F.col("dt") < cutoff).groupBy("symbol", "dt").agg(F.count("*").alias("rows"))
