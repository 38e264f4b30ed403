"""One candle per symbol and window, whatever arrived how often."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schemas import CANDLE_VALUES


def dedupe_candles(candles: DataFrame, prefer: str | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """Keep the copy with the most trades for each (symbol, window_start).

    Equal counts are decided by ``prefer`` (ascending, if given) and then by
    every value column, so a rerun keeps the same row. Spark turns the
    ``rn = 1`` filter into a group limit before the shuffle: each map task
    sends at most one row per group, however many copies a group has.
    ``within`` names columns that follow from the window start and that the rows
    are dealt out by already; they spare a second shuffle.
    """
    order = [F.desc("trade_count")]
    if prefer is not None:
        order.append(F.asc(prefer))
    order += [F.desc(c) for c in ("window_end", *CANDLE_VALUES) if c != "trade_count"]
    copies = Window.partitionBy(*within, *(c for c in ("symbol", "window_start") if c not in within)).orderBy(*order)
    return candles.withColumn("rn", F.row_number().over(copies)).filter("rn = 1").drop("rn")


def tag_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Candles of several origins with ``source`` and ``source_rank``."""
    tagged = [
        df.withColumns({"source": F.lit(name), "source_rank": F.lit(rank)})
        for rank, (name, df) in enumerate(sources.items())
    ]
    return reduce(lambda left, right: left.unionByName(right), tagged)


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union candles of several origins and keep one per window.

    The first named source wins among copies with equal trade counts; the
    result tells each row's origin in ``source``.
    """
    return dedupe_candles(tag_sources(sources), prefer="source_rank").drop("source_rank")


def compare_sources(left: DataFrame, right: DataFrame, names: tuple[str, str] = ("stream", "backfill")) -> DataFrame:
    """What a merge of two origins decides without a trace: a row for each candle that they do not agree on.

    ``status``: ``only_<name>`` where one has it, ``differs`` where both do.
    ``fields``: the value columns that differ, null being a value, in the order
    of a candle; empty for a candle that one lacks. Both candles come along
    under the names of their origins, null where there is none. Copies within an
    origin are met first, as a merge would. One shuffle for each side.
    """
    values = ("window_end", *CANDLE_VALUES)
    sides = [
        dedupe_candles(df).select(F.col("symbol").alias(f"{name}_symbol"), F.col("window_start").alias(f"{name}_start"), F.struct(*values).alias(name))
        for df, name in zip((left, right), names, strict=True)
    ]
    a, b = names
    same = F.col(f"{a}_symbol").eqNullSafe(F.col(f"{b}_symbol")) & F.col(f"{a}_start").eqNullSafe(F.col(f"{b}_start"))
    joined = sides[0].join(sides[1], same, "full")
    differing = F.array_compact(F.array(*[F.when(~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), F.lit(c)) for c in values]))
    status = F.when(F.col(b).isNull(), f"only_{a}").when(F.col(a).isNull(), f"only_{b}").otherwise("differs")
    found = joined.select(
        F.coalesce(f"{a}_symbol", f"{b}_symbol").alias("symbol"),
        F.coalesce(f"{a}_start", f"{b}_start").alias("window_start"),
        status.alias("status"),
        F.when(status == "differs", differing).otherwise(F.array().cast("array<string>")).alias("fields"),
        a,
        b,
    )
    return found.filter((F.col("status") != "differs") | (F.size("fields") > 0))
