"""Silver maintenance: compact streamed candles and merge backfilled ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import dt_hour
from tickloom.operators import decode_klines, dedupe_candles, kline_reject_reason, split_klines, tag_sources
from tickloom.schemas import CANDLE_SCHEMA, conform
from tickloom.session import shared_dir
from tickloom.sources.lake import HourRange, Lake, Table, rows_per_file


def merge_tables(spark: SparkSession, sources: dict[str, Table], target: Table, hours: HourRange | None = None, touched: DataFrame | None = None) -> None:
    """Write one deduplicated, sorted copy of ``sources`` into ``target``.

    ``touched`` names folders of the target by its partition columns, and only
    these are written; the sources are read on their days only.

    The target is a function of the sources and nothing in it is read, so a
    rerun over the same hours gives the same files' worth of rows, and running
    compaction and backfill in either order ends in the same state. Rows are
    shuffled once, by the target's folders; copies of a candle meet there.
    """
    rows = {name: table.read(spark, hours) for name, table in sources.items()}
    if touched is not None:
        days = [r.dt for r in touched.select("dt").distinct().collect()]  # at most the days of the hours
        folder = list(target.partition_by)
        rows = {name: df.filter(F.col("dt").isin(days)).join(touched, folder, "left_semi") for name, df in rows.items()}
    frames = {name: conform(df) for name, df in rows.items()}
    tagged = dt_hour(tag_sources(frames), "window_start")
    dealt = target.gathered(tagged)
    merged = dedupe_candles(dealt, prefer="source_rank", within=target.partition_by)
    target.write_gathered(conform(merged, CANDLE_SCHEMA, target.time_folders), sort_by=("window_start",))


def compaction_metrics(spark: SparkSession, sources: dict[str, Table], target: Table, hours: HourRange | None = None) -> DataFrame:
    """One row: files and rows on both sides, measured from the files themselves."""
    tables = [(table, "before") for table in sources.values()] + [(target, "after")]
    files = spark.createDataFrame([], "file string, rows long, side string")
    for table, side in tables:
        rows = table.open(spark, hours)
        if rows is not None:
            files = files.unionByName(rows_per_file(rows).withColumn("side", F.lit(side)))
    before, after = F.col("side") == "before", F.col("side") == "after"
    return files.agg(
        F.count_if(before).alias("files_before"),
        F.count_if(after).alias("files_after"),
        F.coalesce(F.sum(F.when(before, F.col("rows"))), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(after, F.col("rows"))), F.lit(0)).alias("rows_after"),
    ).withColumn("hours", F.lit(str(hours) if hours else "all"))


def compact(spark: SparkSession, lake: Lake, hours: HourRange | None = None) -> DataFrame:
    """Rewrite the hours' many small streamed files as one file per symbol and hour.

    Any range of hours is one Spark job. Returns the metrics row.
    """
    hours = hours and lake.span(hours)
    sources = {"stream": lake.streamed, "backfill": lake.backfilled}
    merge_tables(spark, sources, lake.compacted, hours)
    return compaction_metrics(spark, sources, lake.compacted, hours)


def backfill(spark: SparkSession, lake: Lake, pages: DataFrame, hours: HourRange, run_id: str | None = None) -> dict[str, int]:
    """Land kline pages as backfilled candles and merge them with streamed ones.

    ``pages`` holds (symbol, page). A run lands in folders of its own, so no run
    takes candles of another away; give ``run_id`` to repeat a run. Every kline
    is counted once: ``landed``, ``outside`` the hours, or ``malformed``, and
    those are kept with a reason among the rejects.
    """
    hours = lake.span(hours)
    run_id = run_id or uuid.uuid4().hex
    staged = shared_dir(spark, "klines")
    decode_klines(pages, keep=("kline",)).write.parquet(staged)
    klines = spark.read.parquet(staged)
    usable, rejects = split_klines(klines)
    covered = hours.covers("window_start")
    inside = usable.filter(covered).drop("kline")
    # a page that holds a candle twice must not pile up copies in one folder
    lake.backfilled.replace_partitions(dedupe_candles(inside).withColumn("run_id", F.lit(run_id)), sort_by=("window_start",))
    table = lake.rejects("klines")
    stamped = rejects.select("reason", F.col("kline").alias("value"), F.current_timestamp().alias("rejected_at"))
    owned = stamped.withColumns({"query_id": F.lit(run_id), "batch_id": F.lit(0).cast("long")})
    table.write_gathered(table.gathered(table.placed(owned, "rejected_at")), sort_by=("reason",))
    landed = dt_hour(lake.backfilled.run(spark, run_id, hours), "window_start").select(*lake.compacted.partition_by).distinct()
    merge_tables(spark, {"stream": lake.streamed, "backfill": lake.backfilled}, lake.compacted, hours, landed)
    bad = kline_reject_reason().isNotNull()
    counts = {"klines": F.count("*"), "landed": F.count_if(~bad & covered), "outside": F.count_if(~bad & ~covered), "malformed": F.count_if(bad)}
    return klines.agg(*[c.alias(name) for name, c in counts.items()]).first().asDict()


def rows_per_symbol(spark: SparkSession, table: Table, hours: HourRange) -> DataFrame:
    """Candles each symbol has in the hours' folders."""
    return table.read(spark, hours).groupBy("symbol").agg(F.count("*").alias("rows"))
