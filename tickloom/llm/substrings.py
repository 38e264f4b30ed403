"""Passages that repeat across documents, by paragraph MinHash banding.

Equal texts are one text; of their rows the one with the smallest key stays.

A paragraph is a line of ``min_words`` words or more. Equal paragraphs are one
node; nodes that agree in a band of their MinHash meet in a bucket, where exact
Jaccard of five-word shingles decides. Components of the links are clusters:
the paragraphs of the document with the smallest key stay, the others are
removals. Two rows a band and eight bands find a pair of similarity 0.8 with
probability 0.9997.

What the removed paragraphs leave is then looked through for shorter passages:
windows of ``min_words`` words, whatever their lines and spacing, that are in
more than one text. So an equal passage of that many words is found to the word.
Who keeps a window is decided among places that are left, and a window goes only
if the place that keeps it is sure to stay (see ``settled``); so none that goes
vanishes and none is left in two documents.

To keep most windows from being shuffled, anchors are met first: a shorter window
in each, the one with the smallest hash. Equal windows have equal anchors, so
only texts that share an anchor with another are looked through, and of their
windows only those whose hash is in a bitmap of shared ones become rows. Tasks
send each anchor and window with two texts at most, which is all that tells a
shared one, so a passage of very many texts is no large group. Both bitmaps have
a fixed size; what they let through in vain meets nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.buckets import links_in_buckets
from tickloom.llm.common import ASCII_LOWER, blocks_of, byte_hashes, release, stored, text_bytes
from tickloom.llm.components import connected_components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 8, 2
MIN_WORDS = 24
#: About so many bytes of text for each part of the windows.
PART_BYTES = 4 << 20
#: Windows a task gathers before it passes them on.
GATHER = 1 << 20
#: Bits of the bitmap of documents, a fixed size; two are set for each.
BITMAP_BITS = 1 << 26
#: Bytes of text taken at once.
BLOCK = 1 << 20
#: Bits of the bitmap of shared windows at most.
WINDOW_BITS = 28

OCCURRENCES = "doc long, id {id}, `begin` int, `end` int, words int, node long, body binary, bands array<long>"


# Odd multipliers of the hash functions, from a seeded generator.
MULTIPLIERS = np.random.default_rng(17).integers(1 << 62, 1 << 63, BANDS * BAND_ROWS + SHINGLE, dtype=np.uint64) * 2 + 1
STEP = int(MULTIPLIERS[0])
BACK = pow(STEP, -1, 1 << 64)
#: Which bytes part words, as bytes.split() has them.
BLANK = np.isin(np.arange(256), list(b" \t\n\r\v\f"))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One hash for each window of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + count]) * MULTIPLIERS[k]
        out ^= out >> np.uint64(29)
    return out


def band_keys(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(paragraphs, bands): keys from the smallest values of each hash function; ``first``: where a paragraph's shingles begin."""
    keys = np.empty((len(first), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(first), band, np.uint64)
        for row in range(BAND_ROWS):
            h = shingles * MULTIPLIERS[SHINGLE + band * BAND_ROWS + row]
            h ^= h >> np.uint64(32)
            h *= MULTIPLIERS[0]
            key = (key ^ np.minimum.reduceat(h, first)) * MULTIPLIERS[1]
            key ^= key >> np.uint64(31)
        keys[:, band] = key
    return keys.view(np.int64)


def window_keys(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of ``size`` words, whatever the size: a polynomial of the words' hashes from running sums."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.append(np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(np.full(len(words), STEP, np.uint64))))
    out = (total[size:] - total[:-size]) * np.cumprod(np.full(count, BACK, np.uint64))
    out = (out ^ out >> np.uint64(32)) * MULTIPLIERS[1]
    return out ^ out >> np.uint64(29)


class Texts:
    """The words of some texts: places in bytes of their text, the text of each, and hashes."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts)
        inside = np.zeros(len(joined) + 2, bool)
        inside[1:-1] = ~BLANK[np.frombuffer(joined, np.uint8)]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        #: places in the joined texts
        self.at, self.to = edges[::2], edges[1::2]
        self.lower = joined.translate(ASCII_LOWER)
        self.first = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        first_word = np.searchsorted(self.at, self.first)
        self.words = np.diff(first_word, append=len(self.at))  # of each text
        self.owner = np.repeat(np.arange(len(texts)), self.words)
        self.begin, self.end = self.at - self.first[self.owner], self.to - self.first[self.owner]
        self.number = np.arange(len(self.at)) - first_word[self.owner]

    def hashes(self) -> np.ndarray:
        """Of each word."""
        return byte_hashes(self.lower, self.at, self.to)

    def lasting_hashes(self, some: np.ndarray | slice = slice(None)) -> np.ndarray:
        """XXH64 of some words, which results depend on; each different word is hashed once."""
        at, to = self.at[some], self.to[some]
        number, different = pd.factorize(byte_hashes(self.lower, at, to))
        one = np.empty(len(different), np.int64)
        one[number] = np.arange(len(number))
        found = (xxhash.xxh64_intdigest(self.lower[a:b]) for a, b in zip(at[one].tolist(), to[one].tolist(), strict=True))
        return np.fromiter(found, np.uint64, len(one))[number]

    def windows(self, size: int) -> np.ndarray:
        """Where a window of ``size`` words of one text begins."""
        return np.flatnonzero(self.owner[: max(0, len(self.owner) - size + 1)] == self.owner[size - 1 :])

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts and keys of the anchors of all windows of ``size`` words: of the windows of half as many in it, the smallest key."""
        at = self.windows(size)
        if not len(at):
            return at, np.zeros(0, np.uint64)
        half = max(1, size // 2)
        least = window_keys(self.hashes(), half)
        width, span = size - half + 1, 1
        while span < width:  # smallest of 1, 2, 4, ... and then of all
            step = min(span, width - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        least, owner = least[at], self.owner[at]
        first = np.append(True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]))
        return owner[first], least[first]


def occurrences(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """Paragraphs of all texts, and a row without a node for each text of ``min_words`` words; begin and end are byte places. ``doc``: a hash of the text."""
    kind = docs.schema[key].dataType.simpleString()
    schema = OCCURRENCES.format(id=kind)
    id_type = pa.int64()

    def rows(block: list[tuple]) -> pa.RecordBatch:
        numbers, row_ids, texts = zip(*block, strict=True)
        words = Texts(list(texts))
        # the lines of all texts: equal to those of the joined texts
        ends = np.append(np.flatnonzero(np.frombuffer(words.lower, np.uint8) == 10), len(words.lower))
        starts = np.append(0, ends[:-1] + 1)
        first_word = np.searchsorted(words.at, starts)
        in_line = np.diff(first_word, append=len(words.at))
        lines = np.flatnonzero(in_line >= min_words)
        starts, ends, sizes = starts[lines], ends[lines], in_line[lines]
        owner = np.searchsorted(words.first, starts, side="right") - 1
        bodies = [b" ".join(words.lower[a:b].split()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        nodes = np.array(list(map(xxhash.xxh64_intdigest, bodies)), np.uint64).view(np.int64)
        hashes = words.lasting_hashes(np.repeat(in_line >= min_words, in_line))
        count = np.maximum(sizes - SHINGLE + 1, 0)
        line = np.repeat(np.arange(len(lines)), sizes)
        shingles = shingle_hashes(hashes)
        shingles = shingles[line[: len(shingles)] == line[len(line) - len(shingles) :]]
        bands = band_keys(shingles, np.cumsum(count) - count) if len(lines) else np.zeros((0, BANDS), np.int64)
        long = np.flatnonzero(words.words >= min_words).tolist()
        own = [*owner.tolist(), *long]
        begins = [*(starts - words.first[owner]).tolist(), *(len(texts[k]) - len(texts[k].lstrip()) for k in long)]
        ends = [*(ends - words.first[owner]).tolist(), *(len(texts[k].rstrip()) for k in long)]
        none = [None] * len(long)
        keys = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1)))
        return pa.record_batch(
            [
                pa.array([numbers[k] for k in own], pa.int64()),
                pa.array([row_ids[k] for k in own], id_type),
                pa.array(begins, pa.int32()),
                pa.array(ends, pa.int32()),
                pa.array([*sizes.tolist(), *words.words[long].tolist()], pa.int32()),
                pa.array([*nodes.tolist(), *none], pa.int64()),
                pa.array([*bodies, *none], pa.binary()),
                pa.concat_arrays([keys, pa.nulls(len(long), keys.type)]),
            ],
            names=["doc", "id", "begin", "end", "words", "node", "body", "bands"],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal id_type
        release()
        for part in parts:
            id_type = part.column(1).type
            for block in blocks_of(part, BLOCK):
                yield rows(block)

    return docs.select(doc_hash(text).alias("doc"), F.col(key).alias("id"), text_bytes(text).alias("text")).mapInArrow(run, schema)


def doc_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def similar_paragraphs(similarity: float = SIMILARITY):
    """The comparison for ``links_in_buckets``: payloads are lower-cased words; exact Jaccard of their shingles."""

    def compare(nodes: np.ndarray, payloads: list, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        out_i: list[int] = []
        out_j: list[int] = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                for i, j in similar_sets([shingle_set(p) for p in payloads[a:b]], similarity):
                    out_i.append(a + i)
                    out_j.append(a + j)
        return np.array(out_i, int), np.array(out_j, int)

    return compare


def shingle_set(body: bytes) -> set[tuple]:
    words = body.split(b" ")
    return set(zip(*(words[k:] for k in range(SHINGLE)), strict=False)) or {tuple(words)}


def similar_sets(sets: list[set], similarity: float) -> list[tuple[int, int]]:
    """A forest of the pairs with that Jaccard similarity: breadth first, each set meets only those not reached yet."""
    sizes = np.array([len(s) for s in sets])
    places: dict[tuple, list[int]] = {}
    for k, s in enumerate(sets):
        for shingle in s:
            places.setdefault(shingle, []).append(k)
    arrays = {shingle: np.array(where) for shingle, where in places.items() if len(where) > 1}
    free = np.ones(len(sets), bool)
    left = len(sets)
    links = []
    for root in range(len(sets)):
        if not free[root]:
            continue
        free[root] = False
        left -= 1
        queue = [root]
        while queue and left:
            own = queue.pop()
            found = [arrays[s] for s in sets[own] if s in arrays]
            if not found:
                continue
            shared = np.bincount(np.concatenate(found), minlength=len(sets))
            hits = np.flatnonzero(free & (shared >= similarity * (sizes + sizes[own] - shared)) & (shared > 0))
            free[hits] = False
            left -= len(hits)
            links.extend((own, int(k)) for k in hits)
            queue.extend(hits.tolist())
    return links


def _parted(keys: np.ndarray, parts_bits: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by part of the hash space, and (part, begin, end) of those that have any."""
    owner = (keys >> np.uint64(64 - parts_bits)).astype(np.int64) if parts_bits else np.zeros(len(keys), np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange((1 << parts_bits) + 1))
    return order, [(p, int(cuts[p]), int(cuts[p + 1])) for p in np.flatnonzero(np.diff(cuts)).tolist()]


def _numbers(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _by_key(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and docs by key and doc, where each key begins, and whether it has several docs."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    last = np.append(first[1:], len(keys)) - 1
    return keys, docs, first, docs[first] != docs[last]


def _gathered(parts: Iterator[pa.RecordBatch], found, parts_bits: int, marks: bool) -> Iterator[pa.RecordBatch]:
    """Keys of the hash space's parts with the docs that have them: the first and the last of each key of a batch.

    ``found`` gives keys and docs of a block. With ``marks``, the docs that share a key
    with others of the batch go along: those between the two would else be lost.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        keys, docs, first, several = _by_key(*(np.concatenate(x) for x in zip(*held, strict=True)))
        shared = np.unique(docs[np.repeat(several, np.diff(first, append=len(keys)))]) if marks else docs[:0]
        ends = np.append(first[1:], len(keys)) - 1
        two = np.concatenate([first, ends[several]])
        keys, docs = keys[two], docs[two]
        order, cuts = _parted(keys, parts_bits)
        keys, docs = keys[order], docs[order]
        names = [p for p, _, _ in cuts]
        columns = [[x[a:b].tobytes() for _, a, b in cuts] for x in (keys, docs)]
        shares = np.array_split(shared, len(names))
        return pa.record_batch([pa.array(names, pa.int64()), *(pa.array(c, pa.binary()) for c in columns), pa.array([x.tobytes() for x in shares], pa.binary())], names=["part", "keys", "docs", "marks"])

    for part in parts:
        for block in blocks_of(part, BLOCK, 2):
            keys, docs = found(block)
            held.append((keys, docs))
            size += len(keys)
            if size >= GATHER:
                yield batch()
                held, size = [], 0
    if size:
        yield batch()


GATHERED = "part long, keys binary, docs binary, marks binary"


def _bits(docs: np.ndarray) -> np.ndarray:
    """(2, documents): the places of documents in the bitmap."""
    docs = docs.view(np.uint64)
    return np.stack([docs % np.uint64(BITMAP_BITS), docs // np.uint64(BITMAP_BITS) % np.uint64(BITMAP_BITS)]).astype(np.int64)


def _bit_words(docs: np.ndarray) -> pa.Table:
    place = np.unique(_bits(docs)) if len(docs) else np.zeros(0, np.int64)
    word = np.flatnonzero(np.append(True, place[1:] >> 6 != place[:-1] >> 6)) if len(place) else np.zeros(0, int)
    bits = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), word) if len(place) else np.zeros(0, np.uint64)
    return pa.table([pa.array(place[word] >> 6, pa.int64()), pa.array(bits.view(np.int64))], names=["word", "bits"])


def _bitmap(words: DataFrame) -> np.ndarray:
    """One bitmap of documents out of rows ``word``, ``bits``: as many rows as it has words at most."""
    out = np.zeros(BITMAP_BITS // 64, np.uint64)
    for row in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        out[row.word] = np.uint64(row.bits & 0xFFFFFFFFFFFFFFFF)
    return out


def _in_bitmap(held: Broadcast):
    """A column function: may this document be in the broadcast bitmap?"""

    @F.pandas_udf("boolean")
    def marked(docs: pd.Series) -> pd.Series:
        one, two = _bits(docs.to_numpy(np.int64))
        hit = [held.value[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1) for place in (one, two)]
        return pd.Series((hit[0] & hit[1]).astype(bool))

    return marked


def sharing_documents(rows: DataFrame, min_words: int, parts_bits: int) -> np.ndarray:
    """A bitmap that has every text that shares an anchor with another; ``rows``: ``doc``, ``id``, ``text``."""

    def anchors(block: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        texts = Texts([data for *_, data in block])
        owner, keys = texts.anchors(min_words)
        return keys, np.array([doc for doc, *_ in block], np.int64)[owner]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from _gathered(parts, anchors, parts_bits, True)

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        keys, docs, first, several = _by_key(_numbers(table, "keys", "<u8"), _numbers(table, "docs", "<i8"))
        return _bit_words(np.union1d(docs[np.repeat(several, np.diff(first, append=len(keys)))], _numbers(table, "marks", "<i8")))

    return _bitmap(rows.mapInArrow(run, GATHERED).groupBy("part").applyInArrow(meet, "word long, bits long"))


class Windows:
    """The windows of some texts without what was cut out of them, in places of the texts."""

    def __init__(self, block: list[tuple], size: int):
        """Rows (doc, id, text, cuts); no window goes across a cut."""
        pieces, self.row, base, number = [], [], [], []
        for k, (_, _, data, cuts) in enumerate(block):
            at = 0
            for begin, end in [*sorted((c["begin"], c["end"]) for c in cuts or ()), (len(data), len(data))]:
                if begin > at:
                    pieces.append(data[at:begin])
                    self.row.append(k)
                    base.append(at)
                at = max(at, end)
        texts = Texts(pieces) if pieces else None
        self.row = np.array(self.row, int)
        at = texts.windows(size) if pieces else np.zeros(0, int)
        owner = texts.owner[at] if pieces else at
        if pieces:
            # numbers go on from piece to piece of a text, with a gap of a window
            words = np.bincount(texts.owner, minlength=len(pieces)) + size
            number = np.cumsum(words) - words
        self.keys = window_keys(texts.lasting_hashes(), size)[at] if pieces else np.zeros(0, np.uint64)
        self.owner = self.row[owner]
        self.number = texts.number[at] + number[owner] if pieces else at
        self.begin = texts.begin[at] + np.array(base, int)[owner] if pieces else at
        self.end = texts.end[at + size - 1] + np.array(base, int)[owner] if pieces else at


def shared_windows(texts: DataFrame, kind: str, min_words: int, parts_bits: int, bitmap_bits: int) -> tuple[DataFrame, Broadcast]:
    """``key``, ``doc``, ``id``, ``number``, ``begin``, ``end`` of every window that more than one text has, and of a few others; and the broadcast they need.

    ``texts``: ``doc``, ``id``, ``text``, ``cuts``, one row a text. Shared windows are
    found first, each task sending a window once; their part of the hash space is
    a bitmap, and all parts side by side are what the second pass goes by.
    """
    bits = max(bitmap_bits, parts_bits + 3)

    def keys_of(block: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        windows = Windows(block, min_words)
        return windows.keys, np.array([doc for doc, *_ in block], np.int64)[windows.owner]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from _gathered(parts, keys_of, parts_bits, False)

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        keys, _, first, several = _by_key(_numbers(table, "keys", "<u8"), _numbers(table, "docs", "<i8"))
        part = np.zeros(1 << bits - parts_bits, bool)
        part[((keys[first][several] >> np.uint64(64 - bits)) & np.uint64(len(part) - 1)).astype(np.int64)] = True
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    found = np.zeros(1 << bits - 3, np.uint8)
    width = 1 << bits - parts_bits - 3
    for r in texts.mapInArrow(run, GATHERED).groupBy("part").applyInArrow(meet, "part long, bits binary").toLocalIterator():  # the bitmap's size in all
        found[r.part * width : (r.part + 1) * width] = np.frombuffer(r.bits, np.uint8)
    held = texts.sparkSession.sparkContext.broadcast(found)

    def emit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = held.value
        for part in parts:
            id_type = part.column(1).type
            for block in blocks_of(part, BLOCK, 2):
                windows = Windows(block, min_words)
                place = (windows.keys >> np.uint64(64 - bits)).astype(np.int64)
                hit = (bitmap[place >> 3] >> (place & 7) & 1).astype(bool)
                owner = windows.owner[hit]
                arrays = [
                    pa.array(windows.keys[hit].view(np.int64)),
                    pa.array(np.array([doc for doc, *_ in block], np.int64)[owner]),
                    pa.array([x for _, x, *_ in block], id_type).take(pa.array(owner)),
                    *(pa.array(x[hit].astype(np.int32)) for x in (windows.number, windows.begin, windows.end)),
                ]
                yield pa.record_batch(arrays, names=["key", "doc", "id", "number", "begin", "end"])

    return texts.mapInArrow(emit, f"key long, doc long, id {kind}, number int, `begin` int, `end` int"), held


def settled(windows: DataFrame, min_words: int) -> DataFrame:
    """``windows`` of several texts with ``first_id`` and ``kept``: decisions that hold together.

    The smallest key that has a window keeps it. But where the keeper's place
    overlaps with a window that the keeper loses to another, that place may go,
    and with it the window. So a window is settled only when a place of its
    keeper overlaps with nothing that is to go; then its other places go. What
    is left, without places that were cut into, is decided in the next round. The
    smallest key never loses a window, so each round settles some; chains of
    overlapping passages are as many rounds as they are long.
    """
    near = Window.partitionBy("doc").orderBy("number").rangeBetween(1 - min_words, min_words - 1)
    left, done = windows, []
    while True:
        facts = left.groupBy("key").agg(F.min("id").alias("first_id"), F.min("doc").alias("one"), F.max("doc").alias("other"))
        # written, so that the join reads two exchanges and adaptive execution can split a window of very many texts
        facts = stored(facts.filter("one <> other").select("key", "first_id"), "facts")
        kept = F.col("id").eqNullSafe(F.col("first_id")) | F.col("first_id").isNull()
        told = left.join(facts, "key").withColumn("kept", kept)
        told = stored(told.withColumn("threatened", F.max(~F.col("kept")).over(near)), "told")
        # threatened places are few, and so are the windows that have no other
        risky = told.filter("kept AND threatened").select("key").distinct()
        sure = told.filter("kept AND NOT threatened").select("key").join(risky, "key", "left_semi").distinct()
        unsafe = stored(risky.join(sure, "key", "left_anti"), "unsafe")
        told = told.drop("threatened")
        if unsafe.isEmpty():
            return reduce(DataFrame.unionByName, [*done, told])
        done.append(told.join(unsafe, "key", "left_anti"))
        judged = told.join(unsafe.withColumn("unsafe", F.lit(True)), "key", "left").withColumn("unsafe", F.col("unsafe").isNotNull())
        open_texts = judged.filter("unsafe").select("doc").distinct()
        cut = F.max(~F.col("unsafe") & ~F.col("kept")).over(near)
        judged = judged.join(open_texts, "doc", "left_semi").withColumn("cut", cut)
        left = stored(judged.filter("unsafe AND NOT cut").select(windows.columns), "left")


def runs_of(windows: DataFrame, min_words: int) -> DataFrame:
    """Windows that follow each other in a text, with one decision: ``doc``, ``id``, ``begin``, ``end``, ``words``, ``passage``, ``first_id``, ``kept``."""
    alike = ["doc", "id", "first_id", "kept"]
    order = Window.partitionBy(*alike).orderBy("number")
    begins = F.coalesce(F.col("number") - F.lag("number").over(order) > 1, F.lit(True)).cast("int")
    numbered = windows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(*alike, "run")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"), (F.max("number") - F.min("number") + min_words).alias("words"), F.min("key").alias("passage"))
        .drop("run")
    )


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Every place of a passage that occurs in more than one document.

    ``doc`` (hash of the text), ``id``, ``begin``, ``end`` (bytes of the UTF-8
    text), ``words``, ``passage`` (the same for equal words and for similar
    paragraphs), ``first_id`` (smallest key with it) and ``kept`` (is this the
    document that keeps it?). A text that is equal to that of a smaller key is
    one passage from its first to its last word. A paragraph that is similar to
    one of a smaller key is one too. In what is left, runs of windows of
    ``min_words`` words are. After all that is not kept has gone, every window
    of such a run is still whole in the document that keeps it, and no window of
    the input is left in two documents. Places of one text may overlap. A null or empty text has no
    passages. Rows with equal key and text count as one document; of several
    texts with one key none is removed for another. Null keys are never first,
    unless all keys of a passage are null: then nothing of it is removed. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    found = stored(occurrences(docs, key, text, min_words), "passages")
    lines = found.filter("node IS NOT NULL")
    kind = docs.schema[key].dataType.simpleString()
    columns = ("doc", "id", "begin", "end", "words", "passage", "first_id", "kept")

    # equal texts: all but the first go whole
    whole = found.filter("node IS NULL").select("doc", "id", "begin", "end", "words").distinct()
    copied = whole.groupBy("doc").agg(F.min("id").alias("first_id"), F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    copies = whole.join(copied, "doc").withColumn("kept", F.col("id").eqNullSafe(F.col("first_id"))).withColumn("passage", F.col("doc"))

    # paragraphs: clusters of similar ones
    places = (F.min("id").alias("first_id"), F.min("doc").alias("one"), F.max("doc").alias("other"))
    bands = lines.select("node", "bands").dropDuplicates(["node"]).select("node", F.explode("bands").alias("bucket"))
    links = links_in_buckets(bands, similar_paragraphs(similarity), payloads=lines.select("node", F.col("body").alias("payload")))
    joined = connected_components(links)
    classes = lines.groupBy("node").agg(*places).join(joined, "node", "left").withColumn("passage", F.coalesce("component", "node"))
    by_passage = classes.groupBy("passage").agg(F.min("first_id").alias("first_id"), F.min("one").alias("one"), F.max("other").alias("other")).filter("one <> other").select("passage", "first_id")
    repeated = classes.select("node", "passage").join(by_passage, "passage")
    own = lines.groupBy("doc", "begin", "end", "words", "node").agg(F.min("id").alias("id"))  # each text once
    paragraphs = own.join(repeated, "node").withColumn("kept", F.col("id").eqNullSafe(F.col("first_id")) | F.col("first_id").isNull())
    paragraphs = stored(paragraphs.select(*columns), "paragraphs")

    # windows of what is left
    rows = docs.select(doc_hash(text).alias("doc"), F.col(key).alias("id"), text_bytes(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts_bits = min(WINDOW_BITS, (size // PART_BYTES).bit_length())
    held = spark.sparkContext.broadcast(sharing_documents(rows, min_words, parts_bits))
    sharing = rows.filter(_in_bitmap(held)("doc"))
    cuts = paragraphs.filter("NOT kept").groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))  # a text's paragraphs at most
    texts = stored(sharing.groupBy("doc").agg(F.min("id").alias("id"), F.any_value("text").alias("text")).join(cuts, "doc", "left").select("doc", "id", "text", "cuts"), "sharing")
    held.destroy()
    windows, held = shared_windows(texts, kind, min_words, parts_bits, min(WINDOW_BITS, max(20, size.bit_length() - 3)))
    windows = stored(windows, "windows")
    held.destroy()
    runs = runs_of(settled(windows, min_words), min_words)
    return paragraphs.unionByName(runs.select(*columns)).unionByName(copies.select(*columns))


def without(data: bytes, begins: list[int], ends: list[int]) -> str:
    """The text without those byte ranges; lines that lose all their words go."""
    out, at = [], 0
    for begin, end in sorted(zip(begins, ends, strict=True)):
        if begin > at:
            out.append(data[at:begin])
        else:
            out.append(b"")
        at = max(at, end)
    # a mark where something went, to tell lines that were emptied from lines that were empty
    joined = b"\0".join([*out, data[at:]])
    lines = [line for line in joined.split(b"\n") if line.strip(b"\0 \t\r") or b"\0" not in line]
    return b"\n".join(b" ".join(x.strip(b" ") for x in line.split(b"\0") if x.strip(b" ")) if b"\0" in line else line for line in lines).decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The table with each repeated passage in its first document only (see ``repeated_passages``).

    A document of which nothing but spaces remains goes. Texts without repeats,
    null and empty texts stay as they are, and so do all other columns;
    ``n_chars``, where the table has it, is counted anew for changed texts. Rows
    with equal key and text are treated alike.
    """
    spark = docs.sparkSession
    places = repeated_passages(docs, key, text, min_words, similarity).filter("NOT kept")
    gone = stored(places.groupBy(F.col("doc").alias("__doc"), F.col("id").alias("__id")).agg(F.collect_list("begin").alias("__begins"), F.collect_list("end").alias("__ends")), "gone")

    def words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from _bit_words(part.column(0).to_numpy()).to_batches()

    # only texts that lose something are shuffled
    loses = _in_bitmap(spark.sparkContext.broadcast(_bitmap(gone.select("__doc").mapInArrow(words, "word long, bits long"))))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else without(t, list(b), list(e)) for t, b, e in zip(texts, begins, ends, strict=True)], dtype=object)

    hashed = docs.withColumn("__hash", doc_hash(text))
    # written, so that no task needs two Python workers: each would keep what later stages load into it
    losing = stored(hashed.filter(loses("__hash")), "losing")
    joined = losing.join(gone, (F.col("__hash") == F.col("__doc")) & F.col(key).eqNullSafe(F.col("__id")), "left")
    # not deterministic as far as the optimizer goes: else the filter cuts each text once more, in a second Python worker of the task
    changed = joined.withColumn("__text", cut.asNondeterministic()(text_bytes(text), F.col("__begins"), F.col("__ends")))
    kept = changed.filter("__text IS NULL OR trim(__text) <> ''")
    columns = []
    for name in docs.columns:
        column = F.col(f"`{name}`")
        if name == text:
            column = F.coalesce("__text", column)
        elif name == "n_chars":
            column = F.coalesce(F.char_length("__text").cast(docs.schema[name].dataType), column)
        columns.append(column.alias(name))
    return kept.select(*columns).unionByName(hashed.filter(~loses("__hash")).select(*[F.col(f"`{c}`") for c in docs.columns]))
