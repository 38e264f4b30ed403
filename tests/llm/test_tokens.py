"""Token counts and packing against the tokenizer library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import bpe_fst
from tickloom.llm.bpe_fst import Transducer
from tickloom.llm.packing import Shard, pack, ranks, signatures
from tickloom.llm.queries import BYTE_BPE, QUERIES, piece_digests
from tickloom.llm.token_counts import count_tokens

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library(texts):
    return [e.ids for e in LIBRARY.encode_batch(list(texts), add_special_tokens=False)]


def assert_equal_ids(machine, texts):
    want = library(texts)
    data = [t.encode() for t in texts]
    assert machine.count(data).tolist() == [len(x) for x in want]
    ids, counts = machine.encode(data)
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


ODD = ["", " ", "  a", "\n\n x", "it's we'll 'sure ''s 's's I've'd", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "a" * 3000, " " * 700 + "x", "😀 漢字 кот", "'", "'r", "x <|endoftext|", "=-" * 400]


def test_odd_texts():
    assert_equal_ids(Transducer.of(BYTE_BPE), ODD)


def test_random_texts():
    rng = random.Random(3)
    assert_equal_ids(Transducer.of(BYTE_BPE), ["".join(rng.choice("ab 'stre\n!1é漢  lvmTHE") for _ in range(rng.randrange(80))) for _ in range(2000)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cn", "Cs"], max_codepoint=0xFFFF), max_size=40), max_size=5))
def test_any_text(texts):
    assert_equal_ids(Transducer.of(BYTE_BPE), texts)


def test_chunks_without_a_mark_compose():
    """A pre-token over many chunks is a chain of maps that are all head."""
    rng = random.Random(9)
    word = "".join(rng.choice("abcdefgh") for _ in range(bpe_fst.CHUNK * 5 + 7))
    assert_equal_ids(Transducer.of(BYTE_BPE), [word, "b", word[100:], " " + word[:900]])


def unspaced(size, seed=9, alphabet="abcdefgh"):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(size))


@pytest.mark.parametrize("text", [unspaced(1_000_000), "x" * 1_000_000, "=-" * 300_000, "abc" * 200_000, " " * 400_000 + "x", "漢字かな" * 60_000], ids="letters x signs abc spaces cjk".split())
def test_a_megabyte_without_a_boundary(monkeypatch, text):
    """Chunk maps are composed in logarithmic rounds: few passes over the chunks, whatever their number."""
    machine, passes = Transducer.of(BYTE_BPE), []
    advance = machine._advance
    monkeypatch.setattr(machine, "_advance", lambda state, column: passes.append(1) or advance(state, column))
    assert_equal_ids(machine, [text])
    blocks = 2 * -(-len(text.encode()) // bpe_fst.BLOCK)  # counted, then encoded
    assert len(passes) <= blocks * (bpe_fst.TURNS + 2) * bpe_fst.CHUNK


@pytest.mark.parametrize("turns", [1, 2, 8])
def test_maps_that_are_closed_late(monkeypatch, turns):
    """What few turns don't close is followed along the text: the same ids."""
    monkeypatch.setattr(bpe_fst, "TURNS", turns)
    monkeypatch.setattr(bpe_fst, "CHUNK", 4)
    texts = [unspaced(3000, 1), "x" * 999, "a b" + unspaced(700, 2, "etaoins") + " <|endoftext|>" + unspaced(90, 3), "=-" * 200]
    assert_equal_ids(Transducer.of(BYTE_BPE), texts)


def test_pieces_are_entered_where_the_last_was_left(monkeypatch):
    monkeypatch.setattr(bpe_fst, "BLOCK", 1024)
    assert_equal_ids(Transducer.of(BYTE_BPE), [unspaced(9000), "the " * 1000, "x" * 5000 + "<|endoftext|>" + unspaced(3000, 5)])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abet 'x=<|endoftext|>漢", max_size=300), st.sampled_from([1, 2, 3, 8]))
def test_any_text_in_small_chunks(text, chunk):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bpe_fst, "CHUNK", chunk)
        patch.setattr(bpe_fst, "BLOCK", 8 * chunk)
        assert_equal_ids(Transducer.of(BYTE_BPE), [text, text[3:]])


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe_fst, "MAX_STATES", 3000)
    rng = random.Random(4)
    texts = ["".join(rng.choice("etaoinshr dlu") for _ in range(3000)) for _ in range(8)] + ["".join(rng.choice("etaoinshr") for _ in range(6000))]
    assert_equal_ids(Transducer(BYTE_BPE), texts)


def test_short_words_are_merged_once():
    """A text of short words makes no states; words met again are looked up."""
    machine, rng = Transducer(BYTE_BPE), random.Random(4)
    words = ["".join(rng.choice("abtheringé漢'1!") for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    texts = [" ".join(words[k : k + 30]) for k in range(0, 3000, 30)]

    def assert_ids():
        ids, counts = machine.encode([t.encode() for t in texts])
        want = library(texts)
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]

    assert_ids()
    known = machine.words.known
    assert len(machine.states) == 2 and known > 1000
    assert_ids()
    assert machine.words.known == known


@pytest.mark.parametrize("change", [("MAX_WORDS", 40), ("SHORT", 8), ("SHORT", 17)])
def test_words_that_are_forgotten_or_too_long(monkeypatch, change):
    monkeypatch.setattr(bpe_fst, *change)
    assert_equal_ids(Transducer(BYTE_BPE), [*ODD, *(unspaced(n) for n in range(1, 40)), *(" " + unspaced(n, n) for n in range(1, 40))])


def test_words_with_equal_keys(monkeypatch):
    """Only a word's bytes tell whether it is the one that was remembered."""
    monkeypatch.setattr(bpe_fst.Words, "ODD", (np.uint64(0),) * 3)
    assert_equal_ids(Transducer(BYTE_BPE), [*ODD, "a the that then thatthat abcdefghijklmnopq abcdefghijklmnopr"])


def test_counts_of_odd_rows(odd):
    rows = count_tokens(odd, BYTE_BPE).collect()
    texts = [r.text for r in odd.select("text").collect()]
    want = sorted((len((t or "").encode()), len(i), len(i) > 512) for t, i in zip(texts, library([t or "" for t in texts]), strict=True))
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want


def test_counts_of_nothing(nothing):
    assert count_tokens(nothing, BYTE_BPE).collect() == []


def assert_packed(docs, pieces, window):
    """Every id once, sequences without gaps, little padding. Documents with one key are told apart by their ids."""
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id].append([*library([r.text or ""])[0], 1])
    sequences, got = defaultdict(list), defaultdict(int)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        fits = [ids for ids in want[p.doc_id] if len(ids) == p.doc_tokens and zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32]
        assert fits
        got[p.doc_id] += p.length
    assert got == {k: sum(map(len, v)) for k, v in want.items()}
    short = 0
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at and length > 0
            at += length
        assert at <= window
        short += at < window
    return short


def test_packing_odd_rows(odd):
    result = piece_digests(pack(odd.coalesce(1), BYTE_BPE, window=64, shard_tokens=500))
    assert assert_packed(odd, result.collect(), 64) == 1  # only the last window of the partition has room


def test_packing_nothing(nothing):
    assert pack(nothing, BYTE_BPE).collect() == []


def test_neighbours_share_a_window():
    """The seed takes the item that shares its rare terms before the others."""
    items = [(0, 0, np.array([5, 6, 7, 8])), (1, 0, np.array([1, 2, 3, 4])), (2, 0, np.array([5, 6, 7, 9])), (3, 0, np.array([1, 2, 3, 9]))]
    shard = Shard(items, np.ones(10), 4.0)
    windows = [[i for i, *_ in pieces] for pieces, _ in shard.windows(8)]
    assert windows == [[0, 2], [1, 3]]


@pytest.mark.parametrize("sizes", [[3, 3, 3], [8, 1], [5], [7, 7, 7, 7, 7]])
def test_windows_are_full(sizes):
    items = [(k, 0, np.arange(n)) for k, n in enumerate(sizes)]
    rooms = [room for _, room in Shard(items, np.ones(10), 4.0).windows(8)]
    assert all(r == 0 for r in rooms[:-1]) and len(rooms) == -(-sum(sizes) // 8)


def plain_bm25(items, seed, idf, mean):
    """Okapi's formula, term by term."""
    out = []
    for ids in items:
        tf = [list(ids).count(t) for t in sorted(set(items[seed]))]
        out.append(sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ids) / mean)) for t, n in zip(sorted(set(items[seed])), tf, strict=True) if n))
    return out


def plain_windows(items, idf, mean, size):
    """Seeds in order; unused neighbours, best first, that fit; the best one left is cut and seeds the next window."""
    scores = [plain_bm25(items, k, idf, mean) for k in range(len(items))]
    left = {k: (0, len(x)) for k, x in enumerate(items)}
    out, seed = [], None
    while left or seed is not None:
        if seed is None:
            seed = min(left)
            start, length = left.pop(seed)
        pieces, room = [(seed, start, length)], size - length
        ranked = sorted(left, key=lambda k: (-scores[seed][k], k))
        for k in ranked:
            if left[k][1] <= room and room:
                pieces.append((k, *left.pop(k)))
                room -= pieces[-1][2]
        seed = None
        rest = [k for k in ranked if k in left]
        if room and rest:
            seed = rest[0]
            start, length = left.pop(seed)
            pieces.append((seed, start, room))
            start, length = start + room, length - room
        out.append(pieces)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_shard_against_plain_bm25(seed):
    rng = np.random.default_rng(seed)
    items = [np.minimum(rng.zipf(1.3, rng.integers(1, 40)), 50) for _ in range(60)]
    df = np.bincount(np.concatenate([np.unique(x) for x in items]), minlength=51)
    idf = np.log1p((60 - df + 0.5) / (df + 0.5))
    shard = Shard([(k, 0, x) for k, x in enumerate(items)], idf, 20.0)
    for k in range(60):
        assert np.allclose(shard.scores(k), plain_bm25(items, k, idf, 20.0), rtol=1e-12)
    assert [pieces for pieces, _ in shard.windows(64)] == plain_windows(items, idf, 20.0, 64)


def test_signatures_are_the_earliest_terms():
    """Shared terms only, each once; the first agrees as often as the weighted Jaccard similarity says."""
    idf = np.log1p(np.linspace(1, 50, 3000))
    rank = ranks(idf, np.arange(3000) >= 10)
    assert sorted(rank[10:]) == list(range(2990)) and set(rank[:10]) == {(1 << 21) - 1}
    items = [np.array([5, 700, 40, 700, 900, 2500]), np.array([3]), np.array([40, 40])]
    for ids, code in zip(items, signatures(items, rank).tolist(), strict=True):
        want = [*sorted({int(r) for r in rank[ids]} - {(1 << 21) - 1}), *[(1 << 21) - 1] * 3][:3]
        assert [code >> 42, code >> 21 & (1 << 21) - 1, code & (1 << 21) - 1] == want
    rng = np.random.default_rng(2)
    same, expected = 0, 0.0
    for _ in range(2000):
        both, one, two = np.split(rng.choice(np.arange(10, 3000), 90, replace=False), [40, 65])
        a, b = signatures([np.append(both, one), np.append(both, two)], rank)
        same += a >> 42 == b >> 42
        expected += idf[both].sum() / (idf[both].sum() + idf[one].sum() + idf[two].sum())
    assert abs(same - expected) < 100


def test_neighbours_meet_from_anywhere(table):
    """Near copies that stand far apart in the table are in one sequence; by position alone they would not be."""
    rng = random.Random(8)
    letters = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6)) for _ in range(30)]
    topics = [[unspaced(6, 100 * t + k, letters[t]) for k in range(60)] for t in range(30)]
    docs = table([(k, " ".join(rng.choice(topics[k % 30]) for _ in range(60))) for k in range(240)])
    rows = pack(docs.repartition(3), BYTE_BPE, window=2048, shard_tokens=8192).collect()
    sequences = defaultdict(set)
    for r in rows:
        sequences[r.sequence_id].add(r.doc_id % 30)
    pieces = sum(len([r for r in rows if r.sequence_id == s]) for s in sequences)
    assert sum(map(len, sequences.values())) < 0.5 * pieces  # several documents of a topic each


def test_hot_copies_and_long_texts(table):
    """A third of all rows are one text, some texts fill windows alone, keys repeat: every id once, no gaps."""
    docs = table([(k, unspaced(40, k) + " the end") for k in range(60)] + [(k % 7, "copy of a copy") for k in range(45)] + [(500 + k, "long text " * 400) for k in range(3)])
    rows = piece_digests(pack(docs.repartition(4), BYTE_BPE, window=128, shard_tokens=700))
    assert assert_packed(docs, rows.collect(), 128) <= int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shard_recall(texts, size, order):
    """How often the best BM25 neighbour among all items is in the own shard of so many tokens."""
    items = [np.array([*ids, 1]) for ids in library(texts)]
    items = [x[len(x) // 2048 * 2048 :] for x in items if len(x) % 2048]
    df = np.bincount(np.concatenate([np.unique(x) for x in items]))
    idf = np.log1p((len(items) - df + 0.5) / (df + 0.5))
    sizes = np.array(list(map(len, items)))
    at = np.lexsort((np.arange(len(items)), signatures(items, ranks(idf, df > 1)))) if order else np.arange(len(items))
    own = np.empty(len(items), int)
    own[at] = (np.cumsum(sizes[at]) - 1) // size
    index, met = Shard([(k, 0, x) for k, x in enumerate(items)], idf, sizes.mean()), 0
    for seed in range(0, len(items), 3):
        scores = index.scores(seed)
        scores[seed] = -1
        met += scores[own == own[seed]].max() >= scores.max()
    return met / len(range(0, len(items), 3))


def test_shards_by_content_hold_more_neighbours(spark):
    """On sf0.01 in about a dozen shards; the README has the figures of sf0.1."""
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    by_position, by_content = shard_recall(texts, 1 << 16, False), shard_recall(texts, 1 << 16, True)
    assert by_content > 2 * by_position


def test_texts_are_read_in_small_batches(spark, table, tmp_path):
    """A reader held 4,096 texts at once in the JVM, in arrays that grow by doubling."""
    table([(i, f"text {i} " * 40) for i in range(600)]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    spark.conf.unset(setting)
    assert QUERIES["op2_packing"](spark, str(tmp_path)).select("doc_id").distinct().count() == 600
    texts = spark.read.parquet(f"{tmp_path}/documents.parquet").select("text")
    assert len(texts.collect()) == 600
    to_rows = texts._jdf.queryExecution().executedPlan().children().apply(0)
    assert to_rows.metrics().apply("numInputBatches").value() == 3
