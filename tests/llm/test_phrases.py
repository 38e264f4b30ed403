"""Collocations against a count of every phrase in plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import phrases
from tickloom.llm.phrases import collocations, ranked, scored_phrases, tile_counts


def plain(rows, longest, least, share, top):
    """(lang, rank, phrase, a, l, r, n, score) by the definition; rows are (text, lang)."""
    count, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                count.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {k: v for k, v in count.items() if v >= least}
    held = {
        (lang, words[i : i + k])
        for (lang, words), f in often.items()
        for k in range(2, len(words))
        for i in range(len(words) - k + 1)
        if 100 * f >= share * often[lang, words[i : i + k]]
    }
    found = collections.defaultdict(list)
    for (lang, words), a in often.items():
        if len(words) > 1 and (lang, words) not in held:
            score, _, left, right = min((1000 * a * n[lang] // (count[lang, words[:k]] * count[lang, words[k:]]), k, count[lang, words[:k]], count[lang, words[k:]]) for k in range(1, len(words)))
            found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, le, ri, n[lang], -s) for lang, all_ in found.items() for i, (s, a, p, le, ri) in enumerate(sorted(all_)[:top]))


def texts_of(seed, docs, vocabulary):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "ß", "a_b", "x'y"]
    fixed = ["New York City hall", "as well AS", "one two one two one", "very very very very very very"]
    rows = []
    for _ in range(docs):
        out = []
        for _ in range(draw.randint(0, 60)):
            out.append(draw.choice(fixed) if draw.random() < 0.2 else draw.choice(words[: draw.choice([3, 10, len(words)])]))
            out.append(draw.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\x0b"]))
        rows.append(("".join(out), draw.choice(["en", "en", "de", None, "und"])))
    return rows


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("lookup_rows", [1 << 18, 0])
@pytest.mark.parametrize(("longest", "least", "share", "top"), [(5, 4, 100, 2000), (3, 2, 60, 7), (2, 1, 100, 50)])
def test_equals_a_count_of_every_phrase(spark, lookup_rows, longest, least, share, top):
    rows = texts_of(longest, 120, 40)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    out = collocations(frame, top=top, longest=longest, least=least, share=share, lookup_rows=lookup_rows)
    expected = plain(rows, longest, least, share, top)
    assert found(out) == expected
    assert len(expected) > 20


def test_odd_documents(spark, odd, nothing):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert found(collocations(odd, least=2)) == plain(rows, 5, 2, 100, 2000)
    assert found(collocations(nothing, least=2)) == []
    clash = odd.selectExpr("*", "1 AS id", "'x' AS phrase", "2 AS block", "3 AS keys", "4 AS n", "5 AS place", "6 AS left")
    assert found(collocations(clash, least=2)) == plain(rows, 5, 2, 100, 2000)


def test_products_beyond_64_bits_are_exact(spark):
    """One common pair: 1000 a n and l r are far apart, and floors are taken of whole numbers."""
    rows = [("a b " * 70_000, "en"), ("a c. b", "en")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert found(collocations(frame, least=100)) == plain(rows, 5, 100, 100, 2000)


def test_words_are_kept_as_lists(spark):
    frame = spark.createDataFrame([("x y x y x y", "en")], "text string, lang string")
    assert {tuple(r.words) for r in scored_phrases(frame, least=2, longest=3).collect()} == {("x", "y"), ("x", "y", "x"), ("y", "x", "y")}


@pytest.mark.parametrize("size", [5, 40, 3000])
def test_tiles_count_pairs(size):
    draw = np.random.default_rng(size)
    left, right = (np.minimum(draw.geometric(0.05, 5000), size).astype(np.int64) * 7 for _ in range(2))
    a, b, counts, place = tile_counts(left, right, 16)
    assert dict(zip(zip(a.tolist(), b.tolist(), strict=True), counts.tolist(), strict=True)) == collections.Counter(zip(left.tolist(), right.tolist(), strict=True))
    assert (a[place] == left).all() and (b[place] == right).all()


def test_ranks_are_dense_and_by_frequency(spark):
    frame = spark.range(1000).selectExpr("id AS left", "id AS right", "id % 17 AS n").repartition(7)
    got = sorted((r.id, -r.n, r.left) for r in ranked(frame, ["left", "right"], "ranks").collect())
    assert [g[0] for g in got] == list(range(1000))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


@pytest.mark.parametrize("lookup_rows", [1 << 18, 0])
def test_spark_takes_no_block_apart(spark, monkeypatch, lookup_rows):
    """The JVM makes no row of a block's keys, gathers none, and has no table of all pairs of a task's blocks."""
    plans = []
    for name in ("stored", "stored_at"):

        def noted(df, *args, f=getattr(phrases, name)):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return f(df, *args)

        monkeypatch.setattr(phrases, name, noted)
    rows = texts_of(1, 60, 40)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    out = scored_phrases(frame, longest=3, least=4, lookup_rows=lookup_rows)
    assert out.count() > 5
    assert len(plans) > 8
    for plan in plans:
        assert "Generate" not in plan
        assert "collect_list" not in plan
        if "MapInArrow" in plan and "partial_sum" in plan:
            assert plan.index("partial_sum") < plan.index("Exchange") < plan.index("MapInArrow")


@pytest.mark.parametrize("scale", [1, 1 << 24, 1 << 33])
def test_pairs_are_added_up_in_bounded_parts(monkeypatch, scale):
    monkeypatch.setattr(phrases, "MERGED", 50)
    monkeypatch.setattr(phrases, "SENT", 16)
    draw = np.random.default_rng(1)
    expected, blocks = collections.Counter(), []
    for size in (0, 1, 30, 200, 7, 7, 7, 7, 7, 7, 7, 7):
        pairs = sorted({(int(a) * scale, int(b) * scale) for a, b in draw.integers(0, 15, (size, 2))})
        counts = draw.integers(1, 9, len(pairs))
        expected.update({p: int(n) for p, n in zip(pairs, counts, strict=True)})
        left, right = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
        blocks.append(pa.record_batch([pa.array([phrases.packed(left)]), pa.array([phrases.packed(right)]), pa.array([phrases.packed(counts, "<i4")])], names=["left", "right", "counts"]))
    out = list(phrases.pair_sums(iter(blocks)))
    got = collections.Counter()
    for batch in out:
        assert batch.num_rows <= 16
        for row in batch.to_pylist():
            got[row["left"], row["right"]] += row["n"]
    assert got == expected
    if scale < 1 << 31:
        assert sum(b.num_rows for b in out) < sum(len(b.column(0)[0].as_py()) // 8 for b in blocks)
    assert list(phrases.pair_sums(iter([]))) == []


def test_words_are_added_up_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(phrases, "MERGED", 8)
    monkeypatch.setattr(phrases, "SENT", 3)
    texts = [("en", "a b é"), ("de", "a b"), ("en", ""), ("en", "a b c d e f g"), ("de", "a"), ("en", "a")]
    blocks = [pa.record_batch([pa.array([lang]), pa.array([text.encode()]), pa.array([phrases.packed(np.arange(1, len(text.split()) + 1), "<i4")])], names=["lang", "words", "counts"]) for lang, text in texts]
    expected, got = collections.Counter(), collections.Counter()
    for lang, text in texts:
        expected.update({(lang, w): i for i, w in enumerate(text.split(), 1)})
    out = list(phrases.word_sums(iter(blocks)))
    for batch in out:
        assert batch.num_rows <= 3
        for row in batch.to_pylist():
            got[row["lang"], row["word"]] += row["n"]
    assert got == expected
