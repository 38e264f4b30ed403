"""Packing documents into fixed windows, filled with lexically similar documents.

Documents are tokenized once into a stored table. A document's full windows are
sequences of their own; what remains of it is an item. Items are dealt to shards
by content: every term draws a time from an exponential distribution whose rate
is its inverse document frequency, and items are ordered by their three earliest
terms. So two items begin with the same term with a probability of their Jaccard
similarity, weighted by inverse document frequencies, however large the table is.
The order is a range partitioning; a hot group, copies for example, is cut by row
numbers wherever a partition ends.

A shard is about ``shard_tokens`` tokens of consecutive items and has a BM25
inverted index; the term statistics (document frequencies of all token ids,
number of documents, mean length) come from all documents. The first unused item
is a seed: its BM25 neighbours that are unused fill its window, best first, as
long as they fit whole; the best one left is cut to fill the rest, and what
remains of it is the next seed. So only the last window of a partition is padded:
items of an unfinished window move on to the next shard of the partition.

Shuffled are the 50 thousand term counts of each task, and the items once. A task
holds one shard and one Arrow batch. A neighbour is looked for within the shard.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bpe_fst import BLOCK, Transducer
from tickloom.llm.common import blocks_of, release, stored, text_bytes, valid_utf8

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 20
#: Neighbours of a seed that are ranked before the others.
NEAREST = 32
#: Terms that an item is dealt by, and the bits of each one's rank.
DEALT_BY, RANK_BITS = 3, 21
# The usual BM25 constants.
K1, B = 1.2, 0.75


def id_type(vocabulary: str, end_id: int) -> str:
    """How ids are kept between the steps: unsigned, in two bytes where all fit."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = json.load(file)
    largest = max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if largest < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``key`` and ``ids`` (see ``id_type``), the end id last; and for each partition one row of ``statistics`` without them.

    Statistics are pairs of longs: a term and the number of documents that have
    it; term -1 counts documents, term -2 tokens.
    """
    width = id_type(vocabulary, end_id)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(vocabulary)
        names = [key, "ids", "statistics"]
        df = np.zeros(max(len(machine.length), end_id + 1), np.int64)
        documents, total, key_type = 0, 0, None
        for part in parts:
            key_type = part.column(0).type
            for rows in blocks_of(part, BLOCK):
                ids, counts = machine.encode(valid_utf8([data for _, data in rows]))
                begin = np.cumsum([0, *counts.tolist()])
                with_end = np.insert(ids, begin[1:], end_id)
                cut = (begin + np.arange(len(begin))).tolist()
                own = [with_end[a:b] for a, b in zip(cut, cut[1:], strict=False)]
                pairs = np.sort(np.repeat(np.arange(len(own)), np.diff(cut)) * len(df) + with_end)  # (document, term)
                first = np.append(True, pairs[1:] != pairs[:-1])
                df += np.bincount(pairs[first] % len(df), minlength=len(df))
                documents, total = documents + len(own), total + len(with_end)
                yield pa.record_batch([pa.array([k for k, _ in rows], key_type), pa.array([x.astype(width).tobytes() for x in own], pa.binary()), pa.nulls(len(own), pa.binary())], names=names)
        if key_type is not None:
            terms = np.flatnonzero(df)
            pairs = np.stack([np.append(terms, [-1, -2]), np.append(df[terms], [documents, total])], 1).astype("<i8")
            yield pa.record_batch([pa.nulls(1, key_type), pa.nulls(1, pa.binary()), pa.array([pairs.tobytes()], pa.binary())], names=names)

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, statistics binary"
    return docs.select(F.col(key), text_bytes(text).alias("text")).mapInArrow(run, schema)


def term_statistics(tokens: DataFrame) -> DataFrame:
    """``term`` and ``df`` over all partitions."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for data in part.column(0).to_pylist():
                pairs = np.frombuffer(data, "<i8").reshape(-1, 2)
                yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["term", "df"])

    found = tokens.filter("statistics IS NOT NULL").select("statistics")
    return found.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def ranks(idf: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The order of all terms by -log(u) / idf, u a hash of the term in (0, 1); terms that are not shared come last."""
    x = (np.arange(len(idf), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    u = ((x ^ x >> np.uint64(31)) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-54
    last = (1 << RANK_BITS) - 1
    rank = np.full(len(idf), last, np.int64)
    order = np.argsort(-np.log(u) / np.maximum(idf, 1e-12), kind="stable")
    order = order[shared[order]]
    rank[order] = np.minimum(np.arange(len(order)), last)
    return rank


def signatures(items: list[np.ndarray], rank: np.ndarray) -> np.ndarray:
    """Each item's earliest terms, the first in the highest bits. No item is empty."""
    sizes = np.array(list(map(len, items)))
    begin = np.cumsum(sizes) - sizes
    flat, out = rank[np.concatenate(items)], np.zeros(len(items), np.int64)
    for _ in range(DEALT_BY):
        least = np.minimum.reduceat(flat, begin)
        out = out << RANK_BITS | least
        flat[flat == np.repeat(least, sizes)] = (1 << RANK_BITS) - 1
    return out


class Shard:
    """An inverted index of items and the windows filled from it.

    Terms that an eighth of the items have are rows of a matrix, added up whole;
    all others are postings. Used items leave the index whenever they are a
    third of it.
    """

    def __init__(self, items: list[tuple[int, int, np.ndarray]], idf: np.ndarray, mean: float):
        """Items: (document, start, ids)."""
        self.items = items
        self.start = np.array([s for _, s, _ in items], np.int64)
        self.length = np.array([len(x) for _, _, x in items], np.int64)
        self.terms, where, tf = [], [], []
        for k, (_, _, ids) in enumerate(items):
            term, n = np.unique(ids, return_counts=True)
            self.terms.append(term)
            where.append(np.full(len(term), k, np.int32))
            tf.append(n)
        term = np.concatenate(self.terms)
        where = np.concatenate(where)
        tf = np.concatenate(tf).astype(np.float64)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.length[where] / mean))
        count = np.bincount(term)
        common = np.flatnonzero(count * 8 >= len(items))
        self.row = np.full(len(count), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), len(items)))
        dense = self.row[term] >= 0
        self.matrix[self.row[term[dense]], where[dense]] = weight[dense]
        term, where, weight = term[~dense], where[~dense], weight[~dense]
        order = np.argsort(term, kind="stable")
        self.posting, self.weight = where[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(len(count) + 1))
        self.live = np.arange(len(items))

    def scores(self, seed: int) -> np.ndarray:
        """The score of every live item."""
        row = self.row[self.terms[seed]]
        rare = self.terms[seed][row < 0]
        begin, end = self.first[rare], self.first[rare + 1]
        n = end - begin
        at = np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)
        return self.matrix[row[row >= 0]].sum(0) + np.bincount(self.posting[at], self.weight[at], len(self.live))

    def forget(self, unused: np.ndarray) -> None:
        """Only unused items stay live."""
        stay = unused[self.live]
        number = np.cumsum(stay) - 1
        kept = stay[self.posting]
        self.first = np.append(0, np.cumsum(kept))[self.first]
        self.posting, self.weight = number[self.posting[kept]], self.weight[kept]
        self.matrix, self.live = self.matrix[:, stay], self.live[stay]

    def windows(self, size: int) -> Iterator[tuple[list[tuple[int, int, int]], int]]:
        """Each window's pieces (item, start, length) and its free room; only the last has any."""
        unused = np.ones(len(self.items), bool)
        seed, next_item, left = -1, 0, len(unused)
        while True:
            if seed < 0:
                while next_item < len(unused) and not unused[next_item]:
                    next_item += 1
                if next_item == len(unused):
                    return
                seed = next_item
            if unused[seed]:
                unused[seed] = False
                left -= 1
            pieces = [(seed, int(self.start[seed]), int(self.length[seed]))]
            room = size - int(self.length[seed])
            if room and left:
                if left * 3 < len(self.live) * 2:
                    self.forget(unused)
                score = self.scores(seed)
                free = np.flatnonzero(unused[self.live])
                free, score = self.live[free], score[free]
                # the best neighbours first; of the others only those are ranked that still fit
                least = np.partition(score, -NEAREST)[-NEAREST] if len(score) > NEAREST else -1.0
                for near in (True, False):
                    at = np.flatnonzero((score >= least) if near else (score < least) & (self.length[free] <= room))
                    for item in free[at[np.argsort(-score[at], kind="stable")]].tolist():
                        n = int(self.length[item])
                        if n <= room:
                            pieces.append((item, int(self.start[item]), n))
                            unused[item] = False
                            left -= 1
                            room -= n
                            if not room:
                                break
                    if not room:
                        break
                seed = -1
                if room and left:
                    seed = int(free[np.where(unused[free], score, -1.0).argmax()])
                    unused[seed] = False
                    left -= 1
                    pieces.append((seed, int(self.start[seed]), room))
                    self.start[seed] += room
                    self.length[seed] -= room
                    room = 0
            else:
                seed = -1
            yield pieces, room


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers.
    Every id of every document is in exactly one piece. A null text counts as
    empty and still has its end id. Rows with a repeated or null key are packed
    as documents of their own. Other columns are ignored. An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    tokens = stored(tokenize(docs, vocabulary, key, text, end_id), "tokens")
    # bounded by the vocabulary, not by the corpus
    counts = {r.term: r.df for r in term_statistics(tokens).collect()}
    documents, total = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(max(counts, default=0) + 1)
    df[list(counts)] = list(counts.values())
    idf = np.log1p((documents - df + 0.5) / (df + 0.5))
    statistics = spark.sparkContext.broadcast((idf, min(window, total / max(documents, 1)), ranks(idf, df > 1)))
    kind = docs.schema[key].dataType.simpleString()
    width = id_type(vocabulary, end_id)
    pieces = f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        """Rows: key, tokens of the document, start, ids, sequence, offset."""
        keys, sizes, start, ids, sequence, offset = zip(*rows, strict=True)
        return pa.record_batch(
            [
                pa.array(keys, key_type),
                pa.array(start, pa.int64()),
                pa.array(list(map(len, ids)), pa.int64()),
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                pa.array(sizes, pa.int64()),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            names=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Full windows; their sequences have even numbers."""
        sequence = TaskContext.get().partitionId() << 33
        for part in parts:
            for block in blocks_of(part, BLOCK):
                rows = []
                for doc, data in block:
                    ids = np.frombuffer(data, width)
                    for start in range(0, len(ids) // window * window, window):
                        rows.append((doc, len(ids), start, ids[start : start + window], sequence, 0))
                        sequence += 2
                yield batch(rows, part.column(0).type)

    def items_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What remains of the documents, with the signature and a number of its own."""
        rank = statistics.value[2]
        number = TaskContext.get().partitionId() << 33
        for part in parts:
            for block in blocks_of(part, BLOCK):
                sizes = [len(data) // int(width[2]) for _, data in block]
                tails = [(k, n // window * window, np.frombuffer(data, width)[n // window * window :]) for k, ((_, data), n) in enumerate(zip(block, sizes, strict=True)) if n % window]
                if not tails:
                    continue
                own, start, ids = zip(*tails, strict=True)
                yield pa.record_batch(
                    [
                        pa.array([block[k][0] for k in own], part.column(0).type),
                        pa.array([sizes[k] for k in own], pa.int64()),
                        pa.array(start, pa.int64()),
                        pa.array(signatures(ids, rank)),
                        pa.array(np.arange(number, number + len(own))),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    names=["id", "size", "start", "deal", "number", "ids"],
                )
                number += len(own)

    def filled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of items; their sequences have odd numbers."""
        release()
        idf, mean, _ = statistics.value
        sequence = (TaskContext.get().partitionId() << 33) + 1
        owners: list[tuple] = []  # key, tokens of the document
        items: list[tuple[int, int, np.ndarray]] = []
        held, key_type = 0, None

        def shard(last: bool) -> Iterator[pa.RecordBatch]:
            """Pack the held items; an unfinished window is written only at the end, else its items stay."""
            nonlocal sequence, held, items, owners
            rest: list[tuple[int, int, np.ndarray]] = []
            rows = []
            for found, room in Shard(items, idf, mean).windows(window):
                cut = [(items[i][0], s, items[i][2][s - items[i][1] : s - items[i][1] + n]) for i, s, n in found]
                if room and not last:
                    rest = cut
                    continue
                offset = 0
                for doc, start, ids in cut:
                    rows.append((*owners[doc], start, ids, sequence, offset))
                    offset += len(ids)
                sequence += 2
            if rows:
                yield batch(rows, key_type)
            # documents of the items that stay are numbered anew
            held = sum(len(x) for _, _, x in rest)
            items = [(k, s, x) for k, (_, s, x) in enumerate(rest)]
            owners = [owners[d] for d, _, _ in rest]

        for part in parts:
            key_type = part.column(0).type
            for doc, size, start, data in (row for rows in blocks_of(part, BLOCK) for row in rows):
                ids = np.frombuffer(data, width)
                items.append((len(owners), start, ids))
                owners.append((doc, size))
                held += len(ids)
                if held >= shard_tokens:
                    yield from shard(False)
        if items:
            yield from shard(True)

    rows = tokens.filter("ids IS NOT NULL").select(key, "ids")
    items = rows.mapInArrow(items_of, f"id {kind}, size long, start long, deal long, number long, ids binary")
    dealt = items.repartitionByRange("deal", "number").sortWithinPartitions("deal", "number").select("id", "size", "start", "ids")
    return rows.filter(F.length("ids") >= window * int(width[2])).mapInArrow(whole, pieces).unionByName(dealt.mapInArrow(filled, pieces))
