"""SimHash, vectors, passages and benchmark overlaps against brute force."""

import math
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tickloom.llm import buckets, embeddings, simhash
from tickloom.llm.common import byte_hashes
from tickloom.llm.components import connected_components
from tickloom.llm.decontamination import WORD, contaminated, decontaminate
from tickloom.llm.substrings import Texts, doc_hash, remove_repeats, repeated_passages, similar_sets, shingle_set, without


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (None, 3), (5000, -9)] + [(2000, k) for k in range(2001, 2300)]
    sets = Sets()
    for a, b in edges:
        if a is not None and a != b:
            sets.join(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.find(x) for x in sets.up}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def near_texts(count, seed=1):
    rng = random.Random(seed)
    bases = [[rng.choice(["alpha", "Beta", "gamma", "delta", "eps", "zeta", "eta"]) + str(rng.randrange(50)) for _ in range(120)] for _ in range(6)]
    out = []
    for _ in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
        out.append(" ".join(words))
    return out


def test_simhash_groups(table, odd, monkeypatch):
    monkeypatch.setattr(buckets, "TILE", 16)
    docs = odd.select("doc_id", "text").unionByName(table(list(enumerate(near_texts(150), 100))).select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [slow_fingerprint(t[:9000] if t and len(t) < 9000 else t) for _, t in rows]
    sets = Sets()
    for a in range(len(rows)):
        sets.find(a)
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                sets.join(a, b)
    least = defaultdict(lambda: None)
    for k, (key, _) in enumerate(rows):
        root = sets.find(k)
        if key is not None and (least[root] is None or key < least[root]):
            least[root] = key
    want = sorted((str(key), f"{fps[k]:016x}", str(least[sets.find(k)])) for k, (key, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.simhash_groups(docs).collect()) == want
    kept = simhash.keep_one_of_each(docs).collect()
    assert len(kept) == len({sets.find(k) for k in range(len(rows))})


def test_simhash_of_nothing(nothing):
    assert simhash.simhash_groups(nothing).collect() == []
    assert simhash.keep_one_of_each(nothing).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6])
@pytest.mark.parametrize("count", [2, 40, 700])
def test_bit_sliced_distances(count, radius):
    rng = np.random.default_rng(count)
    base = rng.integers(0, 2**62, 5, dtype=np.int64)
    x = base[rng.integers(0, 5, count)]
    for _ in range(4):
        x = x ^ np.where(rng.random(count) < 0.5, np.int64(1) << rng.integers(0, 62, count), 0)
    x = x.view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None]) <= radius
    group = np.repeat(np.arange(count // 20 + 1), 20)[:count]
    for got, links in ((simhash._one_group(x, radius), near), (simhash._many_groups(x, group, radius), near & (group[:, None] == group[None]))):
        want = buckets.forest(count, *np.nonzero(links))
        assert sorted(got[1].tolist()) == sorted(want[1].tolist()) and sorted(got[0].tolist()) == sorted(want[0].tolist())


def test_tiles_cover_every_pair(spark):
    """A bucket far larger than a tile: each pair of members meets in one group, and no group is large."""
    rows = spark.range(1000).selectExpr("id AS node", "1L AS bucket").unionByName(spark.range(2000, 2001).selectExpr("id AS node", "2L AS bucket"))
    groups = defaultdict(list)
    for r in buckets.grouped_tiles(rows, 100).collect():
        groups[r.bucket, r.lo, r.hi].append(r.node)
    assert {k[0] for k in groups} == {1} and max(map(len, groups.values())) < 300
    met = {(a, b) for nodes in groups.values() for a in nodes for b in nodes if a < b}
    assert len(met) == 1000 * 999 // 2


def slow_vectors(keys, vectors, threshold=0.9):
    sets, links = Sets(), [0] * len(keys)
    good = [k for k, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for a in range(len(keys)):
        sets.find(a)
    for a in good:
        for b in good:
            if b < a and len(vectors[a]) == len(vectors[b]):
                x, y = (np.array(vectors[k]) / np.abs(vectors[k]).max() for k in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    sets.join(a, b)
    least = {}
    for k, key in enumerate(keys):
        r = sets.find(k)
        least[r] = min((x for x in (least.get(r), key) if x is not None), default=None)
    return sorted((str(key), links[k], str(least[sets.find(k)]), key == least[sets.find(k)]) for k, key in enumerate(keys))


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE_ROWS", 64)
    monkeypatch.setattr(embeddings, "STRIPE", 16)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(25, 8))
    vectors = [(base[rng.integers(25)] + rng.normal(size=8) * 0.25).tolist() for _ in range(300)]
    vectors += [None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1.0] * 4, [2.0] * 4, [1e-200] * 4, [1e200] * 4, [-0.0, 0.0, 1.0]]
    vectors += vectors[:25]
    keys = [*range(len(vectors) - 2), 3, None]
    frame = spark.createDataFrame([(k, v, "x", 1) for k, v in zip(keys, vectors, strict=True)], "vec_id long, embedding array<double>, vec string, n_links int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embeddings.near_vectors(frame).collect())
    assert got == slow_vectors(keys, vectors)


def test_no_vectors(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_quantisation_bound():
    """The bound holds for every pair, so a pair outside it needs no second look."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(200, 64)) * rng.lognormal(size=(200, 1))
    q = embeddings.Quantised(v)
    true = q.unit @ q.unit.T
    near = (q.as_float @ q.as_float.T) * q.scale[:, None] * q.scale[None]
    bound = q.kept[:, None] * q.rest[None] + q.rest[:, None] * (q.kept + q.rest)[None]
    assert (np.abs(true - near) <= bound + embeddings.SLACK).all()


def test_buckets_with_the_same_members_are_compared_once(spark):
    members = {1: [1, 2, 3], 2: [3, 2, 1], 3: [1, 2], 4: [1, 2, 2], 5: [7], 6: [2, 1], 7: [4, 5], 8: [1, 3, 3]}
    rows = spark.createDataFrame([(b, n) for b, nodes in members.items() for n in nodes], "bucket long, node long")
    assert sorted(map(tuple, buckets.different_buckets(rows).collect())) == [(1, 3), (3, 2), (4, 3), (7, 2), (8, 3)]
    payloads = rows.selectExpr("node", "cast('' AS binary) AS payload")

    def chain(nodes, payload, group):
        at = np.flatnonzero(group[1:] == group[:-1])
        return at, at + 1

    links = buckets.links_in_buckets(rows.filter("bucket NOT IN (4, 8)"), chain, payloads=payloads).collect()
    assert sorted(tuple(sorted(r)) for r in links) in ([(1, 2), (1, 2), (2, 3), (4, 5)], [(1, 2), (1, 2), (1, 3), (4, 5)], [(1, 2), (1, 3), (2, 3), (4, 5)])


def test_word_hashes():
    """Words are hashed by their bytes alone, wherever they stand and however long they are."""
    rng = random.Random(5)
    words = ["", *("".join(rng.choice("aB") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 200]))) for _ in range(600)), "a" * 8, "a" * 9, "a" * 16, "é"]
    texts = [" \t".join(words[k : k + 9]).encode() for k in range(0, len(words), 9)]
    found = Texts([*texts, b"", b" \n"])
    plain = [w for t in texts for w in t.translate(bytes.maketrans(b"AB", b"ab")).split()]
    assert found.lasting_hashes().tolist() == [xxhash.xxh64_intdigest(w) for w in plain]
    hashes = found.hashes().tolist()
    by_word = dict(zip(plain, hashes, strict=True))
    assert hashes == [by_word[w] for w in plain] and len(set(hashes)) == len(by_word)
    assert [texts[k][a:b].lower() for k, a, b in zip(found.owner, found.begin, found.end, strict=True)] == plain
    assert not len(byte_hashes(b"", np.zeros(0, int), np.zeros(0, int)))


def prose(count, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(count))


def test_passages(table):
    line, inside, near = prose(60, 1), prose(90, 2), prose(70, 3)
    changed = near.split()
    changed[30] = "changed"
    docs = table(
        [
            (1, f"{prose(30, 10)}\n{line}\n{prose(30, 11)}"),
            (2, f"{prose(30, 12)}\n{line.upper()}"),
            (3, f"{prose(40, 13)} {inside} {prose(40, 14)}"),
            (4, f"{prose(45, 15)} {inside} {prose(35, 16)}"),
            (5, f"{near}\n{prose(30, 17)}"),
            (6, f"{' '.join(changed)}\n{prose(30, 18)}"),
            (7, f"{prose(200, 19)}\n{prose(40, 20)}"),
            (8, line),
            (9, None),
            (10, ""),
            (None, f"{prose(30, 21)}\n{line}"),
            (7, f"{prose(200, 19)}\n{prose(40, 20)}"),
        ]
    )
    found = repeated_passages(docs).collect()
    assert {r.id for r in found} == {1, 2, 3, 4, 5, 6, 8, None}
    assert {r.id for r in found if r.kept} == {1, 3, 5}
    out = defaultdict(list)
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in remove_repeats(docs).collect():
        out[r.doc_id].append(r.text)
        assert r.text is None or r.n_chars == len(r.text)
    assert all(out[k] == [before[k]] for k in (1, 3, 5, 9, 10)) and out[7] == [before[7]] * 2
    assert out[2] == [prose(30, 12)] and out[None] == [prose(30, 21)] and out[6] == [prose(30, 18)]
    assert 8 not in out
    gone = before[4].split()
    left = out[4][0].split()
    assert left[:45] == gone[:45] and left[-35:] == gone[-35:] and len(gone) - len(left) >= 50


def wrapped(text, size=8):
    words = text.split()
    return "\n".join(" ".join(words[k : k + size]) for k in range(0, len(words), size))


def test_passages_across_short_lines(table):
    """Line breaks don't matter, also where no line has 24 words."""
    verse = prose(60, 30)
    docs = table([(1, wrapped(f"{prose(11, 31)} {verse} {prose(13, 32)}")), (2, wrapped(f"{prose(6, 33)} {verse} {prose(9, 34)}")), (3, f"{prose(70, 35)} {verse}"), (4, wrapped(prose(60, 36)))])
    assert sorted((r.id, r.words, r.kept) for r in repeated_passages(docs).collect()) == [(1, 60, True), (2, 60, False), (3, 60, False)]
    assert {r.doc_id: r.text.split() for r in remove_repeats(docs).collect() if r.doc_id in (2, 3)} == {2: f"{prose(6, 33)} {prose(9, 34)}".split(), 3: prose(70, 35).split()}


def test_every_passage_inside_lines(table):
    """Passages of 24 to 70 words, to the word."""
    sizes = {k: 24 + k % 47 for k in range(188)}
    docs = table([(1000 * side + k, f"{prose(60, 10_000 * side + k)} {prose(n, 50_000 + k)} {prose(60, 20_000 * side + k)}") for side in (1, 2) for k, n in sizes.items()])
    found = {r.id: (r.words, r.first_id) for r in repeated_passages(docs).filter("NOT kept").collect()}
    assert found.keys() == {2000 + k for k in sizes}
    # a neighbour may be equal by chance
    assert all(0 <= found[2000 + k][0] - n <= 2 and found[2000 + k][1] == 1000 + k for k, n in sizes.items())


def test_passages_with_wide_spacing(table):
    passage = prose(90, 40).split()
    docs = table([(1, f"{prose(40, 41)}  {'  '.join(passage)}  {prose(40, 42)}"), (2, f"{prose(40, 43)} \t{' \t '.join(passage)} {prose(40, 44)}")])
    assert sorted((r.id, r.words, r.kept) for r in repeated_passages(docs).collect()) == [(1, 90, True), (2, 90, False)]


def windows_of(text, size):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def test_a_passage_is_not_kept_by_a_paragraph_that_goes(table):
    """12 goes as a near copy of 11; what 13 shares with 12 only must stay in 13."""
    base, other = prose(400, 70).split(), prose(30, 71)
    near = [*base[:185], *other.split(), *base[215:]]
    docs = table([(11, " ".join(base)), (12, " ".join(near)), (13, f"{prose(30, 72)} {other} {prose(30, 73)}")])
    out = {r.doc_id: r.text for r in remove_repeats(docs).collect()}
    assert 12 not in out and out[11] == " ".join(base) and other in out[13]


def test_a_passage_goes_from_a_paragraph_that_is_kept(table):
    passage, rest = prose(40, 74), prose(40, 75)
    docs = table([(1, f"{prose(50, 76)} {passage} {prose(50, 77)}"), (2, f"{passage} {rest}"), (3, f"{passage} {rest}\n{prose(30, 78)}")])
    out = {r.doc_id: r.text for r in remove_repeats(docs).collect()}
    assert passage in out[1] and out[2].split() == rest.split() and out[3].split() == prose(30, 78).split()
    places = {(r.id, r.words, r.kept) for r in repeated_passages(docs).collect()}
    assert {(1, 40, True), (2, 40, False), (2, 80, True), (3, 80, False)} <= places


@pytest.mark.parametrize("seed", [1, 2])
def test_no_removed_window_vanishes_and_none_stays_twice(table, seed):
    """Chains of overlapping passages of few different words, in lines too short for paragraphs."""
    rng = random.Random(seed)
    size = 4
    stream = [f"w{rng.randrange(6)}" for _ in range(60)]
    docs = []
    for k in range(40):
        words = []
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(50)
            words += stream[at : at + rng.randrange(3, 14)] + [f"own{k}x{rng.randrange(3)}"] * rng.randrange(2)
        docs.append((rng.choice([k, k, k % 5, None]), "\n".join(" ".join(words[i : i + 3]) for i in range(0, len(words), 3))))
    frame = table(docs)
    places = repeated_passages(frame, min_words=size).collect()
    gone = defaultdict(set)
    for r in places:
        if not r.kept:
            gone[r.doc, r.id].add((r.begin, r.end))
    left, removed = defaultdict(set), set()
    for r in frame.select("doc_id", "text", doc_hash("text").alias("h")).distinct().collect():
        data = r.text.encode()
        spans = [(m.start(), m.end()) for m in re.finditer(rb"\S+", data)]
        stays = [not any(a <= b and e <= z for a, z in gone[r.h, r.doc_id]) for b, e in spans]
        for i in range(len(spans) - size + 1):
            window = tuple(data[b:e] for b, e in spans[i : i + size])
            begin, end = spans[i][0], spans[i + size - 1][1]
            if any(a <= begin and end <= z for a, z in gone[r.h, r.doc_id]):
                removed.add(window)
            if all(stays[i : i + size]):
                left[window].add(r.doc_id)
    assert len(removed) > 30 and removed <= left.keys()
    # rows of one key are not set against each other
    assert not [w for w, ids in left.items() if len(ids) > 1]
    texts = {r.text for r in remove_repeats(frame, min_words=size).collect()}
    assert set().union(*(windows_of(t, size) for t in texts)) >= {tuple(w.decode() for w in k) for k in left}


def test_passages_of_odd_rows(odd, nothing):
    assert repeated_passages(odd).filter("NOT kept").count() == 0
    assert sorted(map(str, remove_repeats(odd).collect())) == sorted(map(str, odd.collect()))
    assert repeated_passages(nothing).collect() == [] and remove_repeats(nothing).collect() == []


def test_a_task_needs_one_python_worker(table):
    """A function that a filter runs too is run twice a row, in two workers a task."""
    passage = " ".join(f"w{k}" for k in range(30))
    docs = table([(1, f"one {passage}"), (2, f"another {passage} here"), (3, "nothing of it")])

    def functions(frame):
        return sorted(re.findall(r"ArrowEvalPython \[(\w+)", frame._jdf.queryExecution().executedPlan().toString()))

    assert functions(simhash.keep_one_of_each(docs)) == []  # from the written fingerprints
    assert functions(remove_repeats(docs)) == ["cut", "marked"]  # each on its side of the union


def test_cutting_out():
    assert without(b"aa bb cc\ndd", [3], [5]) == "aa cc\ndd"
    assert without(b"aa\nbb\n\ncc", [3], [5]) == "aa\n\ncc"
    assert without(b"aa bb", [0, 2], [3, 5]) == ""


def test_similar_sets_against_all_pairs():
    rng = random.Random(8)
    texts = []
    for base in range(12):
        words = prose(40, base).split()
        for _ in range(6):
            own = list(words)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(40)] = "zz"
            texts.append(" ".join(own).encode())
    sets = [shingle_set(t) for t in texts]
    want, got = Sets(), Sets()
    for a in range(len(sets)):
        want.find(a), got.find(a)
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                want.join(a, b)
    for a, b in similar_sets(sets, 0.8):
        got.join(a, b)
    assert [want.find(k) for k in range(len(sets))] == [got.find(k) for k in range(len(sets))]


def slow_overlaps(docs, items):
    windows = {}
    for key, text in items:
        words = WORD.findall((text or "").lower())
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n >= 8 else 0):
            windows.setdefault(tuple(words[i : i + n]), []).append(key)
    out = {}
    for key, text in docs:
        words = WORD.findall((text or "").lower())
        hits = [(i, n, min(ks)) for w, ks in windows.items() for n in [len(w)] for i in range(len(words) - n + 1) if sum(x != y for x, y in zip(w, words[i : i + n], strict=True)) <= (2 if n == 13 else 1)]
        if hits:
            out[key] = (min(k for *_, k in hits), len({i for i, *_ in hits}), min(i for i, *_ in hits), max(i + n - 1 for i, n, _ in hits))
    return out


@pytest.mark.parametrize("size", range(8, 14))
def test_each_substituted_word_is_found(spark, table, size):
    """Any one word of an item of 8 to 12 words may be another, any two of 13; one more and it is no overlap."""
    words, allowed = prose(size, 70 + size).split(), 2 if size == 13 else 1
    docs = []
    for n in range(allowed + 2):
        for places in combinations(range(size), n):
            changed = ["other" if k in places else w for k, w in enumerate(words)]
            docs.append((len(docs), " ".join([prose(9, 400), *changed, prose(9, 401)])))
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.n_windows, r.first_word, r.last_word) for r in contaminated(table(docs), bench).collect()}
    assert got == slow_overlaps(docs, [(5, " ".join(words))])
    assert len(got) == sum(math.comb(size, n) for n in range(allowed + 1))


def test_benchmark_overlaps(spark, table, odd):
    rng = random.Random(6)
    items = [(k, prose(n, 50 + k)) for k, n in enumerate([30, 13, 12, 8, 7, 40, 0])] + [(90, None), (91, prose(30, 50))]
    docs = [(k, prose(60, 200 + k)) for k in range(12)]
    for k in range(12, 60):
        words = rng.choice(items[:6])[1].split()
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = "other"
        docs.append((k, f"{prose(20, k)}, {' '.join(words).title()}! {prose(20, 300 + k)}"))
    frame = table(docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.n_windows, r.first_word, r.last_word) for r in contaminated(frame, bench).collect()}
    want = slow_overlaps(docs, items)
    assert got == want and 20 < len(want) < 60
    assert {r.doc_id for r in decontaminate(frame, bench).collect()} == {k for k, _ in docs} - set(want)
    assert decontaminate(odd, bench).count() == odd.count()
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(frame, none).collect() == [] and decontaminate(frame.limit(0), bench).collect() == []
