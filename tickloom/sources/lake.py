"""Lake layout: tables by layer, hour ranges as partition filters, table writes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timeparts import dt_hour, hour_floor, hour_key, parse_hour_key
from tickloom.schemas import CANDLE_SCHEMA, CLOCK_SCHEMA, LAG_SCHEMA, PART_SCHEMA, REJECT_SCHEMA, TRADE_SCHEMA, conform, with_partitions

# Characters that Spark writes as %XX in the name of a partition folder.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | set(map(chr, range(1, 32)))

#: A folder of raw trades is written by one task for so many input partitions.
FAN_IN = 8

TIME_PARTITIONS = {"hour": ("dt", "hour"), "day": ("dt",)}


@dataclass(frozen=True)
class HourRange:
    """Whole hours from ``start`` up to but excluding ``end``, naive UTC."""

    start: datetime
    end: datetime

    @staticmethod
    def of(first: str, last: str | None = None) -> HourRange:
        """From one hour key, or an inclusive pair of them."""
        return HourRange(parse_hour_key(first), parse_hour_key(last or first) + timedelta(hours=1))

    def aligned(self, seconds: int) -> HourRange:
        """Widened outwards so that windows of ``seconds`` are whole."""
        if seconds <= 3600:
            return self
        end = hour_floor(self.end, seconds)
        if end < self.end:
            end += timedelta(seconds=seconds)
        return HourRange(hour_floor(self.start, seconds), end)

    def days(self) -> int:
        """Calendar days the range touches."""
        return ((self.end - timedelta(hours=1)).date() - self.start.date()).days + 1

    def partitions(self, grain: str = "hour") -> Column:
        """Condition on ``dt`` and ``hour``; both prune, no path globs needed.

        A day-grained table is replaced a day at a time, so there the range
        means every day it touches.
        """
        last = self.end - timedelta(hours=1)
        dt, hour = F.col("dt"), F.col("hour")
        first_day, last_day = F.lit(self.start.date()), F.lit(last.date())
        days = dt.between(first_day, last_day)
        if grain == "day":
            return days
        return days & ((dt > first_day) | (hour >= self.start.hour)) & ((dt < last_day) | (hour <= last.hour))

    def covers(self, moment: str) -> Column:
        """Condition on a time column of rows not yet partitioned."""
        time = F.col(moment)
        start, end = (F.lit(t.replace(tzinfo=timezone.utc)) for t in (self.start, self.end))
        return (time >= start) & (time < end)

    def __str__(self) -> str:
        return f"{hour_key(self.start)}..{hour_key(self.end - timedelta(hours=1))}"


def folder_name(column: str, value: str) -> str:
    """The folder of a partition value; what Spark escapes covers all that a path pattern could take for a wildcard."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


@dataclass(frozen=True)
class Table:
    """A hive-partitioned Parquet folder with a fixed schema.

    A reader sees the files that are there, whatever part of the table it
    names: no log of a file sink stands between writers and readers.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...]

    def folders(self, hours: HourRange | None = None, symbol: str | None = None) -> str:
        """Path pattern of the folders a read has to list.

        Plain folders have no catalog, so reading the root lists every symbol
        and day ever written before any filter prunes. A job over some hours,
        or a reader of one symbol, lists only the days or the symbol it needs.
        """
        levels = []
        for name in self.partition_by:
            if name == "symbol" and symbol is not None:
                levels.append(folder_name("symbol", symbol))
            elif name == "dt" and hours is not None:
                days = [hours.start.date() + timedelta(days=n) for n in range(hours.days())]
                levels.append(f"dt={{{','.join(map(str, days))}}}")
            else:
                levels.append(f"{name}=*")
        while levels and levels[-1].endswith("=*"):
            levels.pop()
        return "/".join([self.path, *levels])

    def open(
        self, spark: SparkSession, hours: HourRange | None = None, symbol: str | None = None
    ) -> DataFrame | None:
        """Rows with partition columns, or None when no such folder was written.

        ``hours`` and ``symbol`` limit both the listing and the rows; a
        day-grained table gives every day the hours touch.
        """
        schema = with_partitions(self.schema, self.partition_by)
        reader = spark.read.schema(schema)
        try:
            rows = reader.option("basePath", self.path).parquet(self.folders(hours, symbol))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if hours is not None:
            rows = rows.filter(hours.partitions("hour" if "hour" in self.partition_by else "day"))
        return rows if symbol is None else rows.filter(F.col("symbol") == symbol)

    def read(
        self, spark: SparkSession, hours: HourRange | None = None, symbol: str | None = None
    ) -> DataFrame:
        """Like :meth:`open`, with an empty frame where there is nothing."""
        rows = self.open(spark, hours, symbol)
        if rows is None:
            rows = spark.createDataFrame([], with_partitions(self.schema, self.partition_by))
        return rows

    def _batch_folder(self, query_id: str, batch_id: int) -> str:
        """Where a table that is only dealt out by batch keeps one."""
        return "/".join([self.path, folder_name("query_id", query_id), f"batch_id={batch_id}"])

    def batch(self, spark: SparkSession, query_id: str, batch_id: int) -> DataFrame:
        """Rows of one micro-batch, none if there was no such batch."""
        try:
            return spark.read.schema(self.schema).parquet(self._batch_folder(query_id, batch_id))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)

    def run(self, spark: SparkSession, run_id: str, hours: HourRange | None = None) -> DataFrame:
        """Rows of one run of a table that is dealt out by run."""
        return self.read(spark, hours).filter(F.col("run_id") == run_id)

    def drop_batch(self, spark: SparkSession, query_id: str, batch_id: int) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._batch_folder(query_id, batch_id))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def day_folders(self, spark: SparkSession, symbol: str | None = None, before: date | None = None) -> Iterator[tuple[date, str]]:
        """Days and paths of the folders that hold a day, in no order: names only, no file is opened.

        One folder is listed at a time, and nothing of it is kept: with many
        symbols and years there are more days than a driver should hold. Days
        from ``before`` on are passed over.
        """
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = path_of(self.path)
        store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

        def inside(path, levels: tuple[str, ...]) -> Iterator[tuple[date, str]]:
            level, *rest = levels
            if level == "symbol" and symbol is not None:
                own = path_of(path, folder_name("symbol", symbol))
                if store.exists(own):
                    yield from inside(own, tuple(rest))
                return
            entries = store.listStatusIterator(path)
            while entries.hasNext():
                found = entries.next().getPath()
                name, _, value = found.getName().partition("=")
                if name != level:
                    continue
                if rest:
                    yield from inside(found, tuple(rest))
                # the null partition has no date
                elif value[:1].isdigit() and (before is None or date.fromisoformat(value) < before):
                    yield date.fromisoformat(value), found.toString()

        if store.exists(root):
            yield from inside(root, self.partition_by[: self.partition_by.index("dt") + 1])

    @property
    def time_folders(self) -> tuple[str, ...]:
        """Partition columns that the schema does not hold."""
        return tuple(c for c in self.partition_by if c not in self.schema.fieldNames())

    def placed(self, df: DataFrame, time_column: str = "window_start") -> DataFrame:
        """``df`` in the table's types, with its time folders derived."""
        return conform(dt_hour(df, time_column), self.schema, self.time_folders)

    def replace_partitions(self, df: DataFrame, sort_by: tuple[str, ...]) -> None:
        """Write candles, replacing exactly the folders there are rows for.

        A folder's rows meet in one task and become one sorted file. ``df``
        must be unique per symbol and window.
        """
        self.write_gathered(self.gathered(self.placed(df)), sort_by)

    def write_gathered(self, rows: DataFrame, sort_by: tuple[str, ...]) -> None:
        """Write rows that :meth:`gathered` has dealt out already."""
        (
            rows.sortWithinPartitions(*self.partition_by, *sort_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*self.partition_by)
            .parquet(self.path)
        )

    def gathered(self, rows: DataFrame) -> DataFrame:
        """Placed rows with the rows of each folder in one task, or in a few where a folder has no bound."""
        keys = [F.col(c) for c in self.partition_by]
        if "symbol" in self.partition_by:
            # Folders of one symbol's hour or day are many. Their cost is
            # opening files, not bytes, so they are spread over every shuffle
            # partition; with an explicit number adaptive execution does not
            # pack them together.
            width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            # A candle folder holds at most the candles of that time. A busy
            # symbol's raw trades have no such bound: each task gets those of
            # some input partitions only.
            lanes = 1 if "window_start" in self.schema.fieldNames() else -(-rows.rdd.getNumPartitions() // FAN_IN)
            if lanes <= 1:
                return rows.repartition(width, *keys)
            dealt = rows.withColumn("__lane", F.pmod(F.spark_partition_id(), F.lit(lanes)))
            return dealt.repartition(width, *keys, "__lane").drop("__lane")
        # Folders holding all symbols are few and grow with the symbols, so
        # their size decides: adaptive execution splits the large ones.
        return rows.hint("rebalance", *keys)


def rows_per_file(df: DataFrame) -> DataFrame:
    """One row per file behind ``df`` with its row count; reads footers only."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


@dataclass(frozen=True)
class Lake:
    """Paths and tables under one root URI.

    ``grain`` is the narrowest time folder. Hours suit a few busy symbols; with
    many symbols or thin ones, days keep folders and files from outnumbering
    the rows in them.
    """

    root: str
    grain: str = "hour"

    @staticmethod
    def in_bucket(bucket: str, grain: str = "hour") -> Lake:
        return Lake(f"s3a://{bucket}", grain)

    def path(self, layer: str, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{dataset}"

    def span(self, hours: HourRange) -> HourRange:
        """The hours a job over ``hours`` rewrites: whole folders only."""
        return hours.aligned(86_400) if self.grain == "day" else hours

    def _candles(self, layer: str, dataset: str, *extra: str, by_symbol: bool = True) -> Table:
        by = (("symbol",) if by_symbol else ()) + TIME_PARTITIONS[self.grain]
        return Table(self.path(layer, dataset), CANDLE_SCHEMA, (*by, *extra))

    @property
    def trades(self) -> Table:
        """Raw trades, in folders of their own per micro-batch."""
        by = ("symbol", *TIME_PARTITIONS[self.grain], "query_id", "batch_id")
        return Table(self.path("bronze", "trades"), TRADE_SCHEMA, by)

    def rejects(self, of: str = "trades") -> Table:
        """Messages, exchange events or klines that could not be used, by the day they came in."""
        return Table(self.path("bronze", f"rejects_{of}"), REJECT_SCHEMA, ("dt", "query_id", "batch_id"))

    @property
    def late(self) -> Table:
        """Trades that came in behind their symbol's clock, in folders of their own per micro-batch."""
        return Table(self.path("bronze", "late_trades"), TRADE_SCHEMA, (*TIME_PARTITIONS[self.grain], "query_id", "batch_id"))

    @property
    def parts(self) -> Table:
        """Parts of candles, as many for a window as micro-batches had trades of it."""
        return Table(self.path("silver", "ohlc_1m_parts"), PART_SCHEMA, (*TIME_PARTITIONS[self.grain], "query_id", "batch_id"))

    @property
    def clocks(self) -> Table:
        """The newest trade time of each symbol after each micro-batch; only the last two batches are kept."""
        return Table(self.path("silver", "clocks"), CLOCK_SCHEMA, ("query_id", "batch_id"))

    @property
    def raw(self) -> dict[str, Table]:
        """Everything in bronze, which is kept for a limited time."""
        return {"trades": self.trades, "late_trades": self.late, **{f"rejects_{of}": self.rejects(of) for of in ("trades", "events", "klines")}}

    @property
    def streamed(self) -> Table:
        """Candles as the stream wrote them, in folders of their own per micro-batch.

        Compaction reads them by time only, so symbols share a folder and a
        batch adds one file per hour or day it touches.
        """
        return self._candles("silver", "ohlc_1m", "query_id", "batch_id", by_symbol=False)

    @property
    def backfilled(self) -> Table:
        """Candles of history pages, in folders of their own per run."""
        return self._candles("silver", "ohlc_1m_backfill", "run_id", by_symbol=False)

    @property
    def compacted(self) -> Table:
        return self._candles("silver", "ohlc_1m_compacted")

    def gold(self, label: str) -> Table:
        return self._candles("gold", f"ohlc_{label}", by_symbol=False)

    def streamed_gold(self, label: str) -> Table:
        """Coarser candles as a stream closed them, in folders of their own per micro-batch."""
        return self._candles("gold", f"ohlc_{label}_streamed", "query_id", "batch_id", by_symbol=False)

    @property
    def lag(self) -> Table:
        """Sketches of the ingest lag by symbol and minute; all symbols share a folder."""
        return Table(self.path("gold", "ingest_lag"), LAG_SCHEMA, TIME_PARTITIONS[self.grain])

    def candles(self, label: str) -> Table:
        """The table a reader of resolution ``label`` uses."""
        return self.compacted if label == "1m" else self.gold(label)
