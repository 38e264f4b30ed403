"""Lake jobs: compaction, backfill, rollup, checks, retention, reading."""

import datetime
import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import START, candle, candles, texts, trades
from tickloom.operators import build_candles, candle_gaps, candle_history
from tickloom.plans.checks import CheckFailed, check_gaps, check_hours, check_invariants, find_missing_hours, require
from tickloom.plans.compaction import backfill, compact, merge_tables
from tickloom.plans.history import lake_history
from tickloom.plans.maintenance import maintain
from tickloom.plans.retention import drop_folders, expired_folders, expiry_report
from tickloom.plans.rollups import finest_first, rollup
from tickloom.session import STREAM_STATE_CONFS, StoreConfig, shared_dir
from tickloom.sources import HourRange, Lake
from tickloom.streaming import batch_writer, candle_writer

HOUR = HourRange.of("2026-01-01-00:00")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


def files(path):
    return sorted(Path(path).rglob("*.parquet"))


def stream_in(lake, df, batch_id, query_id="q1"):
    candle_writer(lake.streamed, query_id)(df, batch_id)


def kline(minute, close="11", count=7):
    ms = int(START.timestamp() * 1000) + minute * 60_000
    return [ms, "10", "12", "9", close, "5", ms + 59_999, "50", count, "0", "0", "0"]


def pages(spark, **by_symbol):
    rows = [(s, json.dumps(k)) for s, k in by_symbol.items()]
    return spark.createDataFrame(rows, "symbol string, page string")


def test_an_hour_of_streamed_files_becomes_one_per_symbol(spark, lake):
    rows = [candle(s, m) for s in ("A", "B", "C") for m in range(60)]
    owned = candles(spark, rows).withColumns({"query_id": F.lit("q1"), "batch_id": F.minute("window_start")})
    lake.streamed.replace_partitions(owned, sort_by=("window_start",))
    metrics = compact(spark, lake, HOUR).first().asDict()
    assert metrics == {
        "files_before": 60, "files_after": 3, "rows_before": 180, "rows_after": 180,
        "hours": "2026-01-01-00:00..2026-01-01-00:00",
    }
    assert len(files(lake.streamed.path)) == 60 and len(files(lake.compacted.path)) == 3
    one = spark.read.parquet(str(files(lake.compacted.path)[0]))
    assert "dt" not in one.columns and "symbol" not in one.columns
    starts = [r.window_start for r in one.collect()]
    assert len(starts) == 60 and starts == sorted(starts)


def test_a_batch_written_twice_leaves_one_copy(spark, lake):
    batch = candles(spark, [candle(minute=m) for m in range(3)])
    stream_in(lake, batch, 0)
    stream_in(lake, batch, 0)
    assert lake.streamed.read(spark).count() == 3
    # a new checkpoint counts batches from zero again and must not replace these
    stream_in(lake, batch, 0, query_id="q2")
    assert lake.streamed.read(spark).count() == 6
    assert compact(spark, lake, HOUR).first().rows_after == 3


def test_empty_batch_writes_nothing(spark, lake):
    stream_in(lake, candles(spark, []), 0)
    assert not files(lake.streamed.path)


def test_compaction_touches_only_its_hours_and_reruns_the_same(spark, lake):
    stream_in(lake, candles(spark, [candle(minute=m) for m in (0, 1, 60, 61)]), 0)
    compact(spark, lake)
    late = [candle(minute=1, count=9, close=10), candle(minute=61, count=9, close=10)]
    stream_in(lake, candles(spark, late), 1)
    for _ in range(2):
        compact(spark, lake, HOUR)
        assert texts(lake.compacted.read(spark), "window_start", "close", "trade_count") == [
            ("2026-01-01 00:00:00", "11.00000000", "1"),
            ("2026-01-01 00:01:00", "10.00000000", "9"),
            ("2026-01-01 01:00:00", "11.00000000", "1"),
            ("2026-01-01 01:01:00", "11.00000000", "1"),
        ]


def test_backfill_completes_the_stream_in_either_order(spark, lake):
    stream_in(lake, candles(spark, [candle("A", 0, count=9, close=10), candle("A", 1, count=2)]), 0)
    landed = pages(spark, A=[kline(0), kline(1), kline(2), kline(60)], B=[kline(0), kline(0)])
    landed = landed.unionByName(landed)
    seen = backfill(spark, lake, landed, HOUR)
    assert seen == {"klines": 12, "landed": 10, "outside": 2, "malformed": 0}
    expected = [
        ("A", "2026-01-01 00:00:00", "10.00000000", "9"),
        ("A", "2026-01-01 00:01:00", "11.00000000", "7"),
        ("A", "2026-01-01 00:02:00", "11.00000000", "7"),
        ("B", "2026-01-01 00:00:00", "11.00000000", "7"),
    ]
    columns = ("symbol", "window_start", "close", "trade_count")
    assert texts(lake.compacted.read(spark), *columns) == expected
    compact(spark, lake, HOUR)
    assert texts(lake.compacted.read(spark), *columns) == expected
    assert len(files(lake.backfilled.path)) == 1


def test_rollup_cascades_and_matches_direct_candles(spark, lake):
    assert finest_first(("1h", "5m", "15m")) == {"5m": "1m", "15m": "5m", "1h": "15m"}
    assert finest_first(("10m", "15m")) == {"10m": "1m", "15m": "1m"}
    rows = [(s, i, str(100 + i % 17), "2", f"2026-01-01 {i // 60:02}:{i % 60:02}:30") for s in "AB" for i in range(0, 90, 2)]
    ticks = trades(spark, rows)
    lake.compacted.replace_partitions(build_candles(ticks, "1 minute"), sort_by=("window_start",))
    hours = HourRange.of("2026-01-01-00:00", "2026-01-01-01:00")
    assert rollup(spark, lake, hours) == {"5m": 36, "15m": 12, "1h": 4}
    for label, width in {"5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}.items():
        gold = lake.gold(label).read(spark)
        assert set(gold.columns) >= {"dt", "hour", "symbol"}
        values = [c for c in gold.columns if c not in ("dt", "hour")]
        assert texts(gold, *values) == texts(build_candles(ticks, width), *values)
        assert len(files(lake.gold(label).path)) == 2  # one per hour, all symbols inside
    before = texts(lake.gold("5m").read(spark))
    rollup(spark, lake, hours)
    assert texts(lake.gold("5m").read(spark)) == before


def test_windows_longer_than_an_hour_stay_whole(spark, lake):
    df = candles(spark, [candle(minute=m) for m in (0, 60, 200)])
    lake.compacted.replace_partitions(df, sort_by=("window_start",))
    rollup(spark, lake, HourRange.of("2026-01-01-01:00"), ("4h",))
    assert texts(lake.gold("4h").read(spark), "window_start", "trade_count") == [("2026-01-01 00:00:00", "3")]


def test_day_grain_rewrites_whole_days(spark, tmp_path):
    lake = Lake(str(tmp_path), grain="day")
    stream_in(lake, candles(spark, [candle(minute=m) for m in (0, 1, 600, 1500)]), 0)
    compact(spark, lake)
    compact(spark, lake, HOUR)
    assert lake.compacted.read(spark).count() == 4
    assert len(files(lake.compacted.path)) == 2
    assert "hour" not in lake.compacted.read(spark).columns


def test_hour_ranges_select_folders(spark, lake, capsys):
    df = candles(spark, [candle(minute=60 * h) for h in (0, 23, 24, 30, 47, 48)])
    lake.compacted.replace_partitions(df, sort_by=("window_start",))
    picked = lake.compacted.read(spark, HourRange.of("2026-01-01-23:00", "2026-01-02-06:00"))
    assert texts(picked, "dt", "hour") == [("2026-01-01", "23"), ("2026-01-02", "0"), ("2026-01-02", "6")]
    picked.explain("formatted")
    scan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(dt" in scan and "PushedFilters" not in scan


def test_reads_list_only_the_folders_they_need(spark, lake):
    table = lake.compacted
    hours = HourRange.of("2026-01-01-23:00", "2026-01-02-06:00")
    assert table.folders() == table.path
    assert table.folders(hours) == table.path + "/symbol=*/dt={2026-01-01,2026-01-02}"
    assert table.folders(symbol="A") == table.path + "/symbol=A"
    assert table.folders(hours, "A") == table.path + "/symbol=A/dt={2026-01-01,2026-01-02}"
    assert table.folders(symbol="A/*") == table.path + "/symbol=A%2F%2A"
    assert lake.gold("1h").folders(HOUR) == lake.gold("1h").path + "/dt={2026-01-01}"
    assert table.folders(HourRange.of("2020-01-01-00:00", "2026-01-01-00:00")).count(",") == 2192
    df = candles(spark, [candle(s, 1440 * d) for s in ("A", "B*") for d in range(3)])
    table.replace_partitions(df, sort_by=("window_start",))
    assert texts(table.read(spark, hours), "symbol", "dt") == [("A", "2026-01-02"), ("B*", "2026-01-02")]
    assert texts(table.read(spark, symbol="B*"), "dt") == [("2026-01-01",), ("2026-01-02",), ("2026-01-03",)]
    assert len(table.open(spark, HOUR, "A").inputFiles()) == 1
    assert table.open(spark, HourRange.of("2027-01-01-00:00")) is None
    assert table.read(spark, HourRange.of("2027-01-01-00:00")).count() == 0


def test_checks_block_the_rollup(spark, lake):
    stream_in(lake, candles(spark, [candle(minute=0), candle(minute=5, high=8)]), 0)
    with pytest.raises(CheckFailed) as failure:
        maintain(spark, lake, HOUR)
    assert failure.value.result.metrics["high_below_low"] == 1
    assert lake.gold("5m").open(spark) is None


def test_maintenance_end_to_end(spark, lake):
    stream_in(lake, candles(spark, [candle(minute=0)]), 0)
    report = maintain(spark, lake, HOUR, pages(spark, A=[kline(0), kline(3)]))
    assert report.compaction["files_after"] == 1
    invariants, gaps = report.checks
    assert invariants.passed and not gaps.passed and gaps.metrics == {"gaps": 1, "missing": 2}
    assert require(gaps) is gaps
    assert report.rollups == {"5m": 1, "15m": 1, "1h": 1}
    assert texts(lake.gold("1h").read(spark), "trade_count") == [("14",)]


def test_gaps_before_the_first_candle_of_the_hours_count(spark, lake):
    df = candles(spark, [candle(minute=m) for m in (10, 58, 65, 66, 130)])
    lake.compacted.replace_partitions(df, sort_by=("window_start",))
    _, gaps = check_hours(spark, lake, HourRange.of("2026-01-01-01:00"))
    assert gaps.metrics == {"gaps": 1, "missing": 6}


def test_an_hour_without_data_is_skipped(spark, lake):
    stream_in(lake, candles(spark, [candle(minute=600)]), 0)
    report = maintain(spark, lake, HOUR)
    assert (report.compaction["files_before"], report.compaction["rows_after"]) == (0, 0)
    assert all(check.passed for check in report.checks)
    assert report.rollups == {"5m": 0, "15m": 0, "1h": 0}
    assert not files(lake.compacted.path)


def test_checks_on_an_empty_lake_pass(spark, lake):
    empty = lake.compacted.read(spark)
    assert check_invariants(empty).passed and check_gaps(empty).passed


def test_other_read_errors_surface(spark, tmp_path):
    bad = tmp_path / "silver" / "ohlc_1m_compacted" / "symbol=A" / "dt=2026-01-01" / "hour=0"
    bad.mkdir(parents=True)
    (bad / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|file"):
        Lake(str(tmp_path)).compacted.read(spark).count()


def raw_trades(spark, lake, rows):
    typed = trades(spark, rows).withColumns({f.name: F.lit(None).cast(f.dataType) for f in lake.trades.schema if f.name in ("trade_time_ms", "is_buyer_maker", "source", "ingested_at_ms")})
    batch_writer(lake.trades, "trade_time", query_id="test")(typed, 0)


def test_retention_reports_then_drops_only_expired_days(spark, lake):
    rows = [("A", 1, "1", "1", f"2026-01-{d:02} 05:00:00") for d in (1, 2, 3)] + [("B*", 2, "1", "1", "2026-01-01 06:00:00")]
    raw_trades(spark, lake, rows)
    rejects = spark.sql("SELECT 'bad' AS reason, 'x' AS value, timestamp'2026-01-01 03:00:00' AS rejected_at")
    for of in ("trades", "events", "klines"):
        batch_writer(lake.rejects(of), "rejected_at", query_id="test")(rejects, 0)
    as_of = datetime.date(2026, 1, 9)
    folders = expired_folders(spark, lake, as_of)
    expected = [(f"rejects_{of}", "None", "2026-01-01", "1") for of in ("events", "klines", "trades")] + [("trades", s, "2026-01-01", "1") for s in ("A", "B*")]
    assert sorted(tuple(map(str, r)) for r in expiry_report(spark, folders).collect()) == expected
    assert lake.trades.read(spark).count() == 4
    assert len(drop_folders(spark, folders)) == len(folders) == 5
    assert texts(lake.trades.read(spark), "symbol", "dt") == [("A", "2026-01-02"), ("A", "2026-01-03")]
    assert lake.rejects("klines").read(spark).count() == 0
    assert expired_folders(spark, lake, as_of) == []


@pytest.mark.parametrize("days", [1, 62, 63, 400])
def test_archive_reads_agree_whatever_the_range(spark, lake, days):
    raw_trades(spark, lake, [(s, n, "1", "1", f"2026-01-{1 + n % 28:02} 05:00:00") for n in range(60) for s in ("A", "B*")])
    hours = HourRange.of("2026-01-01-00:00", "2026-01-31-23:00")
    wide = HourRange(hours.start - datetime.timedelta(days=days), hours.end)
    everything = texts(lake.trades.read(spark), "symbol", "trade_id")
    assert len(everything) == 120
    assert texts(lake.trades.read(spark, wide), "symbol", "trade_id") == everything
    assert sorted(texts(lake.trades.read(spark, wide, "A"), "symbol", "trade_id") + texts(lake.trades.read(spark, symbol="B*"), "symbol", "trade_id")) == everything


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_backfills_add_up(spark, tmp_path, grain):
    """Two runs that share a folder, and a partial page over a full hour, lose nothing."""
    lake = Lake(str(tmp_path / "lake"), grain)
    span = HourRange.of("2026-01-01-00:00", "2026-01-01-06:00")
    five, six = ([kline(60 * h + m) for m in range(60)] for h in (5, 6))
    backfill(spark, lake, pages(spark, A=five), span)
    backfill(spark, lake, pages(spark, A=six), span)
    report = backfill(spark, lake, pages(spark, A=five[:10]), span)
    assert report == {"klines": 10, "landed": 10, "outside": 0, "malformed": 0}
    assert lake.compacted.read(spark).count() == 120
    before = lake.backfilled.read(spark).count()
    backfill(spark, lake, pages(spark, A=six), span, run_id="again")
    backfill(spark, lake, pages(spark, A=six), span, run_id="again")
    assert lake.backfilled.read(spark).count() == before + 60
    compact(spark, lake)
    assert lake.compacted.read(spark).count() == 120


def test_every_kline_is_counted(spark, lake):
    landed = spark.createDataFrame([("A", json.dumps([kline(1), kline(9999), [2**63 - 1, *kline(2)[1:]], ["x"]])), ("A", "broken"), ("A", "[]"), (None, json.dumps([kline(3)]))], "symbol string, page string")
    assert backfill(spark, lake, landed, HOUR) == {"klines": 6, "landed": 1, "outside": 1, "malformed": 4}
    assert sorted(r.reason for r in lake.rejects("klines").read(spark).collect()) == ["bad_symbol", "bad_window_start", "malformed_kline", "malformed_kline"]
    assert lake.compacted.read(spark).count() == 1


def test_compaction_shuffles_its_rows_once(spark, lake, monkeypatch):
    stream_in(lake, candles(spark, [candle(s, m) for s in "AB" for m in (0, 1)]), 0)
    plans = []
    monkeypatch.setattr(type(lake.compacted), "write_gathered", lambda self, rows, sort_by: plans.append(rows._jdf.queryExecution().sparkPlan().toString() + rows._jdf.queryExecution().executedPlan().toString()))
    merge_tables(spark, {"stream": lake.streamed}, lake.compacted)
    assert plans[0].split("AdaptiveSparkPlan")[1].count("Exchange hashpartitioning") == 1


def test_gap_scan_is_read_once(spark):
    plan = candle_gaps(candles(spark, [candle()]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Exchange") == 2


def test_an_outage_of_days_counts(spark, lake):
    df = candles(spark, [candle("A", 10), candle("A", 3 * 1440 + 65), candle("B", 3 * 1440 + 66)])
    lake.compacted.replace_partitions(df, sort_by=("window_start",))
    _, gaps = check_hours(spark, lake, HourRange.of("2026-01-04-01:00"))
    assert not gaps.passed and gaps.metrics == {"gaps": 1, "missing": 3 * 1440 + 54}


def test_missing_hours_of_the_lake(spark, tmp_path):
    hours = HourRange.of("2026-01-01-00:00", "2026-01-01-03:00")
    df = candles(spark, [candle("A", 0), candle("A", 180), candle("B", 60)])
    wanted = [("A", f"2026-01-01 0{h}:00:00") for h in (1, 2)] + [("B", f"2026-01-01 0{h}:00:00") for h in (0, 2, 3)]
    for grain in ("hour", "day"):
        lake = Lake(str(tmp_path / grain), grain)
        lake.compacted.replace_partitions(df, sort_by=("window_start",))
        assert texts(find_missing_hours(spark, lake, hours), "symbol", "hour_start") == wanted
        named = spark.createDataFrame([("C",)], "symbol string")
        assert find_missing_hours(spark, lake, hours, named).count() == 4


@pytest.mark.parametrize("label", ["1m", "1h"])
def test_history_of_the_lake_reads_the_last_days_only(spark, lake, capsys, label):
    rows = [candle("A", 1440 * d + m) for d in range(9) for m in (0, 1)] + [candle("B", 1440 * 20 + m) for m in range(3)]
    table = lake.candles(label)
    table.replace_partitions(candles(spark, rows), sort_by=("window_start",))
    history = lake_history(spark, lake, "A", label)
    assert texts(history, "window_start") == [("2026-01-09 00:00:00",), ("2026-01-09 00:01:00",)]
    history.explain("formatted")
    scans = [part.split("PartitionFilters:")[1].split("\n")[0] for part in capsys.readouterr().out.split("Scan parquet")[1:] if "PartitionFilters:" in part]
    assert scans and all("dt#" in scan and ">=" in scan for scan in scans)
    assert all("dt=2026-01-08" in f or "dt=2026-01-09" in f for f in history.inputFiles())
    assert lake_history(spark, lake, "nothing", label).count() == 0


def test_history_prunes_symbol_and_days(spark, lake, capsys):
    df = candles(spark, [candle("A", 1440 * d + m) for d in range(3) for m in (0, 1)] + [candle("B", 0)])
    lake.compacted.replace_partitions(df, sort_by=("window_start",))
    history = candle_history(lake.candles("1m").read(spark), "A")
    assert texts(history, "window_start") == [("2026-01-03 00:00:00",), ("2026-01-03 00:01:00",)]
    history.explain("formatted")
    scan = capsys.readouterr().out
    assert "(symbol#" in scan.split("PartitionFilters:")[1].split("\n")[0]


def test_store_settings_follow_the_endpoint():
    local = StoreConfig("http://store:9000", "key", "secret").spark_confs()
    assert local["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert local["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert local["spark.hadoop.fs.s3a.access.key"] == "key"
    cloud = StoreConfig(region="eu-west-3").spark_confs()
    assert not any("key" in k or "endpoint" == k.rsplit(".", 1)[1] for k in cloud)
    assert Lake.in_bucket("b").path("silver", "x") == "s3a://b/silver/x"


def test_shared_dir_uses_the_cluster_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base + "/x-") and first != second
    assert uuid.UUID(first[-32:])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") in STREAM_STATE_CONFS.values()
