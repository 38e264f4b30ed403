"""Dropping raw data past its keep time."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.retention import DEFAULT_KEEP_DAYS
from tickloom.sources.lake import HourRange, Lake, Table

# Fixed value: the folder name of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# folders deleted at once
_DELETES = 16


@dataclass(frozen=True)
class Expired:
    """A day folder of a raw table that has outlived its keep time."""

    name: str
    table: Table
    day: date
    path: str

    @property
    def symbol(self) -> str | None:
        if "symbol" not in self.table.partition_by:
            return None
        value = unquote(self.path.rsplit("/", 2)[1].partition("=")[2])
        return None if value == NULL_FOLDER else value


def expired_folders(spark: SparkSession, lake: Lake, as_of: date, keep_days: int = DEFAULT_KEEP_DAYS) -> list[Expired]:
    """Day folders of everything in bronze that are more than ``keep_days`` before ``as_of``.

    Folder names only, listed folder by folder, and only expired ones are held;
    both the report and the deletion go by this list.
    """
    cutoff = as_of - timedelta(days=keep_days)
    return [
        Expired(name, table, day, path)
        for name, table in lake.raw.items()
        for day, path in sorted(table.day_folders(spark, before=cutoff))
    ]


def expiry_report(spark: SparkSession, folders: list[Expired]) -> DataFrame:
    """(table, symbol, dt, rows) of the folders that :func:`drop_folders` would delete; changes nothing.

    Rows are counted from the footers of the listed days.
    """
    report = spark.createDataFrame([], "table string, symbol string, dt date, rows long")
    for name, table in {f.name: f.table for f in folders}.items():
        own = [f for f in folders if f.name == name]
        listed = spark.createDataFrame([(name, f.symbol, f.day) for f in own], "table string, symbol string, dt date")
        first, last = min(f.day for f in own), max(f.day for f in own)
        hours = HourRange(datetime.combine(first, time()), datetime.combine(last, time()) + timedelta(days=1))
        symbol = F.col("symbol") if "symbol" in table.partition_by else F.lit(None).cast("string")
        counts = table.read(spark, hours).groupBy(symbol.alias("s"), F.col("dt").alias("d")).agg(F.count("*").alias("rows"))
        joined = listed.join(counts, F.col("symbol").eqNullSafe(F.col("s")) & (F.col("dt") == F.col("d")), "left")
        report = report.unionByName(joined.select("table", "symbol", "dt", F.coalesce("rows", F.lit(0)).alias("rows")))
    return report


def drop_folders(spark: SparkSession, folders: list[Expired]) -> list[str]:
    """Delete the folders and name them; several at a time."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def drop(folder: Expired) -> str:
        path = paths(folder.path)
        path.getFileSystem(hadoop).delete(path, True)
        return folder.path

    with ThreadPoolExecutor(_DELETES) as pool:
        return list(pool.map(drop, folders))
