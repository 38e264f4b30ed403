"""Best-fit packing: every id once, every capacity kept, few sequences."""

import collections
import random

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm.bestfit import Capacity, best_fit, pack_best_fit, plan

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def placed(contents):
    return [s for s, copies in contents for _ in range(copies)]


def decreasing_best_fit(lengths, size):
    """One item after the other, tokens only."""
    room = []
    for s in sorted((s for s, n in lengths.items() for _ in range(n)), reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= s]
        if fits:
            room[min(fits)[1]] -= s
        else:
            room.append(size - s)
    return len(room)


@pytest.mark.parametrize("capacity", [Capacity(100, 100, 10_000), Capacity(100, 3, 10_000), Capacity(100, 100, 2600 + 7400), Capacity(100, 5, 4000)])
@pytest.mark.parametrize("criterion", ["norm", "dot"])
def test_plans_keep_every_capacity_and_lose_nothing(capacity, criterion):
    draw = random.Random(1)
    for _ in range(20):
        most = int(capacity.attention**0.5)
        lengths = {s: draw.randint(1, 40) for s in draw.sample(range(1, min(100, most) + 1), 30)}
        weights = np.array([1.0, draw.random(), draw.random()])
        made = best_fit(lengths, capacity, criterion, weights)
        items = collections.Counter()
        for n, contents in zip(made.count, made.contents, strict=True):
            each = placed(contents)
            assert sum(each) <= capacity.tokens and len(each) <= capacity.documents and sum(s * s for s in each) <= capacity.attention
            for s in each:
                items[s] += n
        assert items == lengths


def test_few_sequences():
    draw = random.Random(2)
    for _ in range(10):
        lengths = collections.Counter(min(100, int(draw.paretovariate(1.1) * 3)) for _ in range(2000))
        made = plan(dict(lengths), Capacity(100, 100, 10_000)).sequences
        assert made <= decreasing_best_fit(lengths, 100)
        assert made <= 1.02 * -(-sum(s * n for s, n in lengths.items()) // 100) + 1


def test_items_that_fit_nowhere():
    with pytest.raises(ValueError):
        plan({11: 1}, Capacity(100, 5, 120))
    assert plan({}, Capacity()).sequences == 0


def test_slots_number_every_item_once():
    lengths = {60: 3, 40: 4, 7: 9, 1: 2}
    seen = set()
    made = plan(lengths, Capacity(100, 100, 10_000))
    for s, first, n, base, offset in made.slots().tolist():
        copies = next(c for (length, c) in made.contents[[sum(made.count[:i]) for i in range(len(made.count))].index(base)] if length == s)
        for i in range(copies * n):
            seen.add((s, first + i, base + i % n, offset + s * (i // n)))
    assert {(s, i) for s, i, _, _ in seen} == {(s, i) for s, n in lengths.items() for i in range(n)}
    assert len({(q, o) for _, _, q, o in seen}) == sum(lengths.values())


def check(docs, out, window):
    """Contract of the pieces against the tokenizer library."""
    library = Tokenizer.from_file(BYTE_BPE)
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range((len(ids) - 1) % window + 1, len(ids) + 1, window)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, piece, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    rows = out.collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return by


def test_pieces(spark, odd, nothing):
    for window in (1024, 16, 1):
        by = check(odd, pack_best_fit(odd.repartition(4), BYTE_BPE, Capacity(window, window, window * window)), window)
        total = sum(n for p in by.values() for _, n in p)
        assert len(by) <= -(-total // window) + 3
    assert pack_best_fit(nothing, BYTE_BPE).collect() == []


def test_capacities_hold_in_the_result(spark, table):
    docs = table([(i, "word " * (i % 40)) for i in range(400)])
    capacity = Capacity(128, 4, 6000)
    out = pack_best_fit(docs.repartition(6), BYTE_BPE, capacity)
    check(docs, out, 128)
    worst = out.groupBy("sequence_id").agg(F.count("*").alias("d"), F.sum(F.col("length") * F.col("length")).alias("a")).agg(F.max("d"), F.max("a")).first()
    assert worst[0] <= 4 and worst[1] <= 6000


def test_long_documents_need_a_capacity_for_whole_windows(spark, table):
    with pytest.raises(ValueError):
        pack_best_fit(table([(1, "word " * 300)]), BYTE_BPE, Capacity(100, 5, 9000))
