"""Archives as a data source, and license scans."""

import gzip
import hashlib
import random
import zlib
from pathlib import Path

import duckdb
import pytest

from tickloom.llm import warc
from tickloom.llm.licenses import LINE, NOTICES, PASSAGE, WINDOW, Notice, scan_licenses, scan_sql
from tickloom.llm.warc import archive_pages, member, member_length, parse_headers, read_pages, record, use_warc, write_pages


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>é" + "x" * 200 + "</p>"
    rows = [(3, "http://a/3", long), (1, "http://a/1", long), (2, "http://a/2\r\nX: y", "WARC/1.1\r\n\r\n" * 30), (4, None, None), (5, "u", "short"), (6, "u", "short"), (7, "u", ""), (1, "http://a/1", long), (None, "n", long), (8, "big", "z" * 3_000_000), (9, "m", "é" * 50), (10, "m", "é" * 50)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, first int")


def slow_pages(rows):
    first = {}
    for key, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and key is not None:
            first[data] = min(first.get(data, key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        to = first.get(data)
        other = to is not None and key != to
        out.append((str(key), len(data), hashlib.sha256(data).hexdigest(), "revisit" if other else "response", str(to) if other else "None"))
    return sorted(out)


def test_pages_come_back(pages):
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in archive_pages(pages).collect())
    assert got == slow_pages([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_no_pages(spark, pages):
    assert archive_pages(pages.limit(0)).collect() == []


def test_filters_are_answered_from_headers(spark, pages, tmp_path, monkeypatch):
    use_warc(spark)
    path = str(tmp_path / "archive")
    write_pages(pages, path)
    records = spark.read.format("warc").load(path)
    revisits = records.filter("record_type = 'revisit'")
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert revisits.count() == 3 and revisits.filter("payload IS NOT NULL").count() == 0
    assert records.filter("record_id IN ('<urn:page:5>', '<urn:page:8>')").count() == 2
    assert records.filter("record_id = '<urn:page:8>' AND record_type = 'revisit'").count() == 0
    assert records.filter("payload_length > 1000000").count() == 1
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert bare.count() == 12 and bare.filter("payload IS NOT NULL").count() == 0


def test_unwanted_payloads_are_not_inflated(tmp_path):
    """The second member is damaged behind its headers: only who wants its payload notices."""
    one, two, three = (member(record({"record_type": t, "record_id": f"<{t}>", "payload_length": 90_000}, random.Random(1).randbytes(90_000))) for t in ("response", "metadata", "resource"))
    hurt = bytearray(two)
    hurt[len(two) // 2 :] = bytes(len(two) - len(two) // 2)
    (tmp_path / "x.warc.gz").write_bytes(one + bytes(hurt) + three)
    reader = warc.WarcReader(str(tmp_path), True)
    reader._want("record_type", {"response", "resource"})
    (part,) = reader.partitions()
    rows = [r for batch in reader.read(part) for r in batch.to_pylist()]
    assert [r["record_type"] for r in rows] == ["response", "resource"]
    with pytest.raises(zlib.error):
        list(warc.WarcReader(str(tmp_path), True).read(part))


def test_members_are_gzip():
    data = record({"record_type": "response", "record_id": "<x>", "payload_length": 2}, b"hi")
    one = member(data)
    assert gzip.decompress(one) == data and member_length(one[:24]) == len(one) and member_length(gzip.compress(data)[:24]) is None
    assert parse_headers(data.partition(b"\r\n\r\n")[0])["warc-type"] == "response"


@pytest.mark.parametrize("name, pack", [("foreign.warc.gz", gzip.compress), ("plain.warc", bytes)])
def test_archives_of_other_writers(spark, tmp_path, name, pack):
    use_warc(spark)
    records = [record({"record_type": t, "record_id": f"<{k}>"}, f"body {k}".encode()) for k, t in enumerate(["response", "request", "response"])]
    Path(tmp_path / name).write_bytes(b"".join(map(pack, records)))
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [(r.record_id, bytes(r.payload)) for r in sorted(rows, key=lambda r: r.record_id)] == [(f"<{k}>", f"body {k}".encode()) for k in range(3)]
    assert spark.read.format("warc").load(str(tmp_path)).filter("record_type = 'request'").count() == 1


def test_files_of_failed_tasks_are_not_read(spark, pages, tmp_path):
    use_warc(spark)
    path = tmp_path / "archive"
    write_pages(pages, str(path))
    (path / "part-lost.warc.gz").write_bytes(member(record({"record_type": "response", "record_id": "<urn:page:99>"}, b"x")))
    assert read_pages(spark, str(path)).count() == 12


LICENSED = [
    "Released under the MIT License. apache  LICENSE; cc-by",
    "nothing here\nAll rights reserved.",
    NOTICES[13].text,
    "x " * 150 + " ".join(NOTICES[13].text.split()[:-6]) + " y" * 150,
    " ".join(NOTICES[14].text.split()[:40]),
    "gnu general public license gnu general public license",
    "GNU\nGeneral\tPublic--License licens",
    "MİT license, K license, mit licenses, cc bye",
    "Licensed under the\nApache License, Version 2.0.",
    "licensed under cc by nc 4.0, licensed under cc by sa 4.0",
]


@pytest.fixture(scope="module")
def licensed(table, odd):
    rows = [(500 + k, t) for k, t in enumerate(LICENSED)] + [(600, "word " * 2000 + "mit license " * 900), (601, None)]
    return table(rows).unionByName(odd)


def plain(rows):
    return sorted(tuple(str(round(v, 9) if isinstance(v, float) else v) for v in r) for r in rows)


COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_scans_equal_sql(licensed):
    con = duckdb.connect()
    con.register("documents", licensed.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    want = plain(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({scan_sql()})").fetchall())
    got = plain(scan_licenses(licensed).select(*COLUMNS).collect())
    assert got == want
    labels = {r.doc_id: (r.base_labels, r.labels) for r in scan_licenses(licensed).collect()}
    assert labels[500] == ("apache,cc-by,mit", "apache,cc-by,mit") and labels[501] == ("", "all-rights-reserved")
    assert "mit" in labels[502][1] and "mit" in labels[503][1] and labels[508][0] == "apache"
    assert labels[509][1] == "cc-by,cc-by-nc,cc-by-sa" and labels[507] == ("", "")


def test_no_documents(nothing):
    assert scan_licenses(nothing).collect() == []


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_the_join_finds_every_block(spark, table, threshold):
    """Prefix, length and positional filters against counting out all blocks and notices."""
    rng = random.Random(int(threshold * 10))
    words = [f"w{k}" for k in range(30)]
    notices = tuple(Notice(f"n{k}", scope, threshold, " ".join(rng.sample(words, rng.randrange(2, 12)))) for k, scope in enumerate([LINE, PASSAGE] * 8))
    docs = [(k, "\n".join(" ".join(rng.choices(words, weights=range(1, 31), k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12)))) for k in range(40)]
    want = {}
    for key, text in docs:
        own = text.split()
        blocks = {LINE: [set(line.split()) for line in text.split("\n")], PASSAGE: [set(own[i : i + WINDOW]) for i in range(0, len(own), WINDOW // 2)]}
        want[key] = ",".join(sorted({n.label for n in notices for b in blocks[n.scope] if len(b & set(n.words)) >= n.need}))
    assert {r.doc_id: r.labels for r in scan_licenses(table(docs), notices=notices).collect()} == want
