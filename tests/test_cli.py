"""The command line, driven through files in place of a broker."""

import json

import pytest

from helpers import START, message
from tickloom.__main__ import arguments, main
from tickloom.schemas import MESSAGE_SCHEMA
from tickloom.sources import Lake

HOUR = "2026-01-01-00:00"


def test_stream_to_history(spark, tmp_path, capsys, monkeypatch):
    # the commands share the tests' session
    monkeypatch.setattr("tickloom.__main__.build_session", lambda *args, **kwargs: spark)
    lake = str(tmp_path / "lake")
    topic = tmp_path / "topic"
    events = tmp_path / "events"
    events.mkdir()
    begin = int(START.timestamp() * 1000) + 30_000
    (events / "0.txt").write_text(
        "\n".join(
            json.dumps({"data": {"s": s, "t": m, "p": str(10 + m), "q": "1", "T": begin + m * 60_000, "E": 0, "m": True}})
            for m in range(6)
            for s in ("A", "UNLISTED")
        )
    )

    def run(*words):
        main(["--lake", lake, *words])
        return capsys.readouterr().out

    run("ingest", "--events", str(events), "--symbols", "b, a", "--files", str(topic), "--checkpoint", str(tmp_path / "in"), "--trigger", "once")
    assert {(r.key, r.partition) for r in spark.read.schema(MESSAGE_SCHEMA).parquet(str(topic)).collect()} == {("A", 1)}
    for job in ("bronze", "rejects", "silver"):
        run(job, "--files", str(topic), "--checkpoint", str(tmp_path / job), "--trigger", "once")
    out = str(tmp_path / "live-topic")
    run("live", "--files", str(topic), "--checkpoint", str(tmp_path / "live"), "--trigger", "once", "--out-files", out)
    assert "2026-01-01T00:05:00.000Z" in run("latest", "--files", out, "--symbols", "a")

    pages = tmp_path / "pages.json"
    ms = int(START.timestamp() * 1000) + 7 * 60_000
    kline = [ms, "1", "1", "1", "1", "1", ms + 59_999, "1", 1]
    pages.write_text(json.dumps({"symbol": "A", "page": json.dumps([kline])}))
    assert "'klines': 1" in run("backfill", "--hours", HOUR, "--pages", str(pages))
    assert "files_before" in run("compact", "--hours", HOUR)
    assert "passed=True" in run("check", "--hours", HOUR)
    assert "'5m': 2" in run("rollup", "--hours", HOUR, "--resolutions", "5m")
    assert "MaintenanceReport" in run("maintain", "--hours", HOUR, HOUR)
    assert "p95_lag_ms" in run("lag", "--hours", HOUR)
    history = run("history", "--symbol", "A", "--resolution", "1m")
    assert "2026-01-01 00:07:00" in history and "2026-01-01 00:00:00" in history
    assert "2026-01-01" in run("expire", "--as-of", "2026-02-01")
    assert Lake(lake).trades.read(spark).count() == 6
    assert "dropped 1 folders" in run("expire", "--as-of", "2026-02-01", "--drop")
    assert Lake(lake).trades.read(spark).count() == 0


def test_every_row_is_printed(spark, tmp_path, capsys, monkeypatch):
    """25 symbols in the newest candles, the lag, the expiry report, the missing hours and the backfill."""
    monkeypatch.setattr("tickloom.__main__.build_session", lambda *args, **kwargs: spark)
    lake, topic = str(tmp_path / "lake"), str(tmp_path / "topic")
    symbols = [f"S{n:02}" for n in range(25)]
    begin = int(START.timestamp() * 1000) + 30_000
    trades = [(s, message(s, n, time="2026-01-01 00:00:30"), n % 3, n) for n, s in enumerate(symbols)]
    spark.createDataFrame(trades, MESSAGE_SCHEMA).write.parquet(topic)

    def run(*words):
        main(["--lake", lake, *words])
        return capsys.readouterr().out

    def shown(out):
        return sorted({s for s in symbols if s in out})

    run("bronze", "--files", topic, "--checkpoint", str(tmp_path / "b"), "--trigger", "once")
    live = str(tmp_path / "live")
    run("live", "--files", topic, "--checkpoint", str(tmp_path / "l"), "--trigger", "once", "--out-files", live)
    assert shown(run("latest", "--files", live)) == symbols
    assert shown(run("latest", "--files", live, "--since", "2026-01-01")) == symbols
    assert shown(run("lag", "--hours", HOUR)) == symbols
    assert shown(run("expire", "--as-of", "2026-02-01")) == symbols
    skew = run("skew", "--files", topic).splitlines()
    assert [line.split("\t")[:2] for line in skew[1:]] == [["0", "9"], ["1", "8"], ["2", "8"]]
    pages = tmp_path / "pages.json"
    kline = [begin - 30_000, "1", "1", "1", "1", "1", begin + 29_999, "1", 1]
    pages.write_text("\n".join(json.dumps({"symbol": s, "page": json.dumps([kline])}) for s in symbols))
    assert shown(run("backfill", "--hours", HOUR, "--pages", str(pages))) == symbols
    missing = run("missing", "--hours", HOUR, "2026-01-01-02:00")
    assert shown(missing) == symbols and len(missing.splitlines()) == 1 + 50
    assert len(run("missing", "--hours", HOUR, "--symbols", "s01,other").splitlines()) == 1 + 1


def test_event_rejects_command(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tickloom.__main__.build_session", lambda *args, **kwargs: spark)
    events = tmp_path / "events"
    events.mkdir()
    good = {"s": "A", "t": 1, "p": "1", "q": "1", "T": 1, "E": 0, "m": True}
    (events / "0.txt").write_text("\n".join(["junk", json.dumps({"data": good}), json.dumps({"data": good | {"p": None}})]))
    main(["--lake", str(tmp_path), "event-rejects", "--events", str(events), "--checkpoint", str(tmp_path / "c"), "--trigger", "once"])
    kept = Lake(str(tmp_path)).rejects("events").read(spark)
    assert sorted((r.reason, r.value[:4]) for r in kept.collect()) == [("bad_price", '{"da'), ("malformed_event", "junk")]


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        arguments().parse_args(["--lake", "x", "nonsense"])
