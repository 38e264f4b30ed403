"""A bigram language model in a log-frequency Bloom filter.

Counts are quantised on a scale that grows by half, and a pair of words of level
q is in the filter once for each level up to q. A reader probes level 1, 2, ...
until one is missing; the level reached stands for the middle of its counts. The
filter is in parts by the pair's hash, and a part has ``BITS_PER_EVENT`` bits or
more for each of its insertions, so every pair is in it whatever the corpus. No
task holds more than one part: the number of parts follows the text, and the
different pairs of a block of texts travel to their parts and their levels back.

A document's probability is the product of

    (count(history, word) + MU * p(word)) / (count(history) + MU)

with the pair's count from the filter and those of words exact, as in p below.
Apart from that, each document gets its exact unigram score. The counts of the
``FREQUENT`` most frequent words are sent to the workers; those of all others
are asked for with the pairs. So frequent words are never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Numbers, blocks_of, release, space_words, stored, text_bytes

#: The least bits of a part's filter.
FILTER_BITS = 1 << 12
#: A part's filter is in so many chunks, by the top bits of the n-gram's hash in the part.
CHUNKS = 64
#: Bytes of an n-gram's hash that a part sees, after the bits that name the part.
KEY_BYTES = 5
BITS_PER_EVENT = 6
HASHES = 4
MU = 16.0
#: Words whose counts every worker holds.
FREQUENT = 1 << 17
#: N-grams a task gathers before it passes them on.
GATHER = 1 << 20
#: About so many bytes of text for each part of the n-gram counts.
PART_BYTES = 6 << 20
#: Bytes of text scored at once.
BLOCK = 4 << 20
#: The end of a text as a word; no word has a space.
END, BEGIN = b" ", b"  "

# Odd multipliers of the hash functions, from a seeded generator.
MULTIPLIERS = np.random.default_rng(41).integers(1 << 62, 1 << 63, 8, dtype=np.uint64) * 2 + 1


def _levels() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 62:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, np.int64)


LEVELS = _levels()
#: The count that a level stands for: the middle of its range on a log scale; level 0 is no count.
COUNTS = np.concatenate([[0.0], np.sqrt(LEVELS[:-1].astype(float) * (LEVELS[1:] - 1)), [float(LEVELS[-1])]])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * MULTIPLIERS[0]
    x = (x ^ x >> np.uint64(29)) * MULTIPLIERS[1]
    return x ^ x >> np.uint64(32)


class Block:
    """Some texts as numbers: their different words, and the pairs of a history (the word before, or the begin) and a word."""

    def __init__(self, words: bytes, numbers: bytes, sizes: list[int]):
        """``words``: the different words, one a line; ``numbers``: theirs in all texts, each after BEGIN; ``sizes``: words of each text and its end."""
        self.words = words.split(b"\n")
        flat = np.frombuffer(numbers, "<u4").astype(np.int64)
        self.sizes = np.array(sizes)
        self.first = np.cumsum([0, *sizes[:-1]])
        is_word = np.ones(len(flat), bool)
        is_word[self.first + np.arange(len(sizes))] = False
        self.word = flat[is_word]
        self.history = np.append(flat[:1], flat[:-1])[is_word]

    def pairs(self, at: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the different pairs at some places, which of them each place has, and the places of each."""
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        pairs, own, times = np.unique(self.history[at] * len(self.words) + self.word[at], return_inverse=True, return_counts=True)
        return _mix(hashes[pairs // len(self.words)] * MULTIPLIERS[2] + hashes[pairs % len(self.words)] * MULTIPLIERS[3]), own, times


BLOCKS = "block long, ids array<{id}>, held_out array<boolean>, sizes array<long>, words binary, numbers binary"


def blocks_table(rows: DataFrame, kind: str) -> DataFrame:
    """``id``, ``held_out`` and ``text`` in blocks, as :class:`Block` takes them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        block = TaskContext.get().partitionId() << 33
        for part in parts:
            for rows in blocks_of(part, BLOCK):
                texts = [space_words(data) for *_, data in rows]
                number = Numbers()
                size = sum(map(len, texts)) + 2 * len(texts)
                flat = np.fromiter(map(number.__getitem__, chain.from_iterable((BEGIN, *words, END) for words in texts)), "<u4", size)
                yield pa.record_batch(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([[r[0] for r in rows]], pa.list_(part.column(0).type)),
                        pa.array([[r[1] for r in rows]], pa.list_(pa.bool_())),
                        pa.array([[len(words) + 1 for words in texts]], pa.list_(pa.int64())),
                        pa.array([b"\n".join(number)], pa.binary()),
                        pa.array([flat.tobytes()], pa.binary()),
                    ],
                    names=["block", "ids", "held_out", "sizes", "words", "numbers"],
                )
                block += 1

    return rows.mapInArrow(run, BLOCKS.format(id=kind))


def _events(keys: np.ndarray, level: int) -> np.ndarray:
    return _mix(keys + np.array([level], np.uint64) * MULTIPLIERS[4])


def word_keys(words: list[bytes]) -> np.ndarray:
    return _mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


class LogBloom:
    """The filter's bits, in chunks by the top bits of the key."""

    def __init__(self, bits: np.ndarray, top: int):
        """``top``: the top level that anything reached."""
        self.bits, self.top = bits, top

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key by probes from 1 upwards."""
        chunk_bits = len(self.bits) * 64 // CHUNKS
        out = np.zeros(len(keys), np.int64)
        at = np.arange(len(keys))
        begin = (chunk_of(keys) * np.uint64(chunk_bits)).astype(np.int64)
        for level in range(1, self.top + 1):
            events = _events(keys[at], level)
            for k in range(HASHES):
                place = begin[at] + bit_place(events, k, chunk_bits)
                hit = (self.bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
                at, events = at[hit], events[hit]
                if not len(at):
                    return out
            out[at] = level
        return out


def chunk_of(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - CHUNKS.bit_length() + 1)


def bit_place(events: np.ndarray, k: int, bits: int) -> np.ndarray:
    """Place number k in a chunk of that many bits, a power of two: two hashes make all."""
    step = events >> np.uint64(32) | np.uint64(1)
    return ((events + step * np.array([k], np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def held_out_column(key: str, parts: int, part: int) -> Column:
    """Is this row kept from training? By the CRC-32 of the key as text; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the numbers of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order].astype(np.int64), first)


COUNTED = "part long, filter binary, top int, words binary, times binary, word_sizes array<long>, tokens long"


def scale_of(n: np.ndarray) -> np.ndarray:
    """Sixteen steps for each doubling of a count."""
    return np.floor(np.log2(n) * 16).astype(np.int64)


def owners(keys: np.ndarray, parts_bits: int) -> np.ndarray:
    """The part of each key, by its top bits."""
    return (keys >> np.uint64(64 - parts_bits)).astype(np.int64) if parts_bits else np.zeros(len(keys), np.int64)


def in_part(keys: np.ndarray, parts_bits: int) -> np.ndarray:
    """Keys as their part sees them: without the bits that name the part, KEY_BYTES from the top."""
    return keys << np.uint64(parts_bits) & ~np.uint64((1 << 64 - 8 * KEY_BYTES) - 1)


def packed_keys(keys: np.ndarray) -> bytes:
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.view(">u8").reshape(-1).astype(np.uint64)


def count_ngrams(blocks: DataFrame, parts_bits: int, bits: int = FILTER_BITS) -> DataFrame:
    """One row for each part of the hash space that has anything of the texts that are not held out.

    ``filter`` are the bits of its pairs (see :class:`LogBloom`), ``bits`` or as
    many more as they need, and ``top`` the highest level; ``words`` its words,
    one a line, ``times`` their exact counts, ``word_sizes`` how many there are
    of each step of ``scale_of``, and ``tokens`` the sum.
    """
    count = 1 << parts_bits

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        words: Counter = Counter()
        size = 0

        def batch() -> pa.RecordBatch:
            keys, n = summed(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
            cuts = np.searchsorted(owners(keys, parts_bits), np.arange(count + 1))
            listed = list(words)
            owner = owners(word_keys(listed), parts_bits)
            order = np.argsort(owner, kind="stable")
            times = np.fromiter(words.values(), np.int64, len(words))[order].astype("<u4")
            word_cuts = np.searchsorted(owner[order], np.arange(count + 1))
            listed = [listed[k] for k in order.tolist()]
            own = np.flatnonzero(np.diff(cuts) + np.diff(word_cuts))
            return pa.record_batch(
                [
                    pa.array(own, pa.int64()),
                    pa.array([keys[cuts[p] : cuts[p + 1]].tobytes() for p in own], pa.binary()),
                    pa.array([n[cuts[p] : cuts[p + 1]].astype("<u4").tobytes() for p in own], pa.binary()),
                    pa.array([b"\n".join(listed[word_cuts[p] : word_cuts[p + 1]]) for p in own], pa.binary()),
                    pa.array([times[word_cuts[p] : word_cuts[p + 1]].tobytes() for p in own], pa.binary()),
                ],
                names=["part", "keys", "counts", "words", "times"],
            )

        for part in parts:
            for held_out, sizes, listed, numbers in zip(*(c.to_pylist() for c in part.columns), strict=True):
                block = Block(listed, numbers, sizes)
                own = np.flatnonzero(np.repeat(~np.array(held_out, bool), block.sizes))
                if not len(own):
                    continue
                keys, _, times = block.pairs(own)
                held.append((keys, times))
                # added to what is there; zip keeps the loop in C
                for word, n in zip(block.words, np.bincount(block.word[own], minlength=len(block.words)).tolist(), strict=True):
                    if n:
                        words[word] += n
                size += len(keys)
                if size >= GATHER:
                    yield batch()
                    held, size = [], 0
                    words = Counter()
        if held:
            yield batch()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()])
        keys, total = summed(keys, n) if len(keys) else (keys, n)
        level = np.searchsorted(LEVELS, total, side="right").astype(np.uint8)
        filter_bits = max(bits, 1 << (BITS_PER_EVENT * int(level.sum(dtype=np.int64))).bit_length())
        keys = in_part(keys, parts_bits)
        cuts = np.searchsorted(chunk_of(keys), np.arange(CHUNKS + 1, dtype=np.uint64))
        chunks = [filled(keys[a:b], level[a:b], filter_bits // 64 // CHUNKS) for a, b in zip(cuts, cuts[1:], strict=False)]
        words: dict[bytes, int] = {}
        for listed, times in zip(table.column("words").to_pylist(), table.column("times").to_pylist(), strict=True):
            if times:
                for word, n in zip(listed.split(b"\n"), np.frombuffer(times, "<u4").tolist(), strict=True):
                    words[word] = words.get(word, 0) + n
        times = np.fromiter(words.values(), "<i8", len(words))
        columns = [key[0].as_py(), np.concatenate(chunks).tobytes(), int(level.max(initial=0)), b"\n".join(words), times.tobytes(), np.bincount(scale_of(times), minlength=1).tolist(), int(times.sum())]
        types = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
        names = ["part", "filter", "top", "words", "times", "word_sizes", "tokens"]
        return pa.table([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names=names)

    training = blocks.select("held_out", "sizes", "words", "numbers")
    return training.mapInArrow(run, "part long, keys binary, counts binary, words binary, times binary").groupBy("part").applyInArrow(merge, COUNTED)


def words_between(counted: DataFrame, least: int, most: int) -> DataFrame:
    """``word`` and ``n`` of the words whose step of ``scale_of`` is in that range, ``most`` excluded."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for listed, times in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if times:
                    n = np.frombuffer(times, "<i8")
                    scale = scale_of(n)
                    own = np.flatnonzero((scale >= least) & (scale < most))
                    words = listed.split(b"\n")
                    yield pa.record_batch([pa.array([words[k] for k in own.tolist()], pa.binary()), pa.array(n[own], pa.int64())], names=["word", "n"])

    return counted.select("words", "times").mapInArrow(run, "word binary, n long")


def histogram(counted: DataFrame, column: str) -> np.ndarray:
    """The sum of an array column by place; a place is a level, so few rows meet."""
    rows = counted.select(F.posexplode(column).alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.place for r in rows), default=0) + 1, np.int64)
    for r in rows:
        out[r.place] = r.n
    return out


def filled(keys: np.ndarray, levels: np.ndarray, chunk_words: int) -> np.ndarray:
    """The words of a chunk with each key in it once for each of its levels."""
    words = np.zeros(chunk_words, np.uint64)
    level = 1
    while len(keys):
        events = _events(keys, level)
        for k in range(HASHES):
            place = bit_place(events, k, chunk_words * 64)
            np.bitwise_or.at(words, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        level += 1
        keys, levels = keys[levels >= level], levels[levels >= level]
    return words


def order_of(keys: np.ndarray, parts_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order in which keys are asked for, and where each part begins."""
    owner = owners(keys, parts_bits)
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange((1 << parts_bits) + 1))


def rare_words(block: Block, exact: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the words whose counts the workers do not hold, and the words."""
    at = np.flatnonzero(exact < 0)
    return at, [block.words[k] for k in at.tolist()]


def answers(asked: DataFrame, counted: DataFrame) -> DataFrame:
    """``levels`` of the pairs and ``counts`` of the words that a block asks of a part."""
    schema = "block long, part long, levels binary, counts binary"

    def answer(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        asked_keys, asked_words = left.column("keys").to_pylist(), left.column("rare").to_pylist()
        keys = unpacked_keys(b"".join(asked_keys))
        levels, times = np.zeros(len(keys), np.int64), {}
        for row in right.to_pylist():  # one at most
            levels = LogBloom(np.frombuffer(row["filter"], np.uint64), row["top"]).levels(keys)
            if row["times"]:
                times = dict(zip(row["words"].split(b"\n"), np.frombuffer(row["times"], "<i8").tolist(), strict=True))
        cuts = np.cumsum([0, *(len(k) // KEY_BYTES for k in asked_keys)]).tolist()
        counts = [np.array([times.get(w, 0) for w in words.split(b"\n")] if words else [], "<i8").tobytes() for words in asked_words]
        columns = [left.column("block").combine_chunks(), left.column("part").combine_chunks(), pa.array([levels[a:b].astype(np.uint8).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()), pa.array(counts, pa.binary())]
        return pa.table(columns, names=["block", "part", "levels", "counts"])

    return asked.groupBy("part").cogroup(counted.select("part", "filter", "top", "words", "times").groupBy("part")).applyInArrow(answer, schema)


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", bits: int = FILTER_BITS, frequent: int = FREQUENT) -> DataFrame:
    """Learn from the rows where ``held_out`` is false, score all.

    ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (exact unigram log10 probability) and ``score`` (log10
    probability by the filter's model). A null text counts as empty: one token,
    its end. Without training rows every count is 0. Rows with repeated or null
    keys are scored each. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), held_out.alias("held_out"), text_bytes(text).alias("text"))
    training = rows.filter("NOT held_out").agg(F.count("*").alias("texts"), F.sum(F.octet_length("text")).alias("size")).first()
    parts_bits = min(20, ((training["size"] or 0) // PART_BYTES).bit_length())
    blocks = stored(blocks_table(rows, kind), "blocks")
    counted = stored(count_ngrams(blocks, parts_bits, bits), "ngrams")
    tokens = counted.agg(F.sum("tokens")).first()[0] or 0
    by_scale = histogram(counted, "word_sizes")
    vocabulary = int(by_scale.sum())
    at_least = np.cumsum(by_scale[::-1])[::-1]  # words that reach each step
    least = int(np.argmax(at_least <= frequent)) if (at_least <= frequent).any() else len(by_scale)
    table = {bytes(r.word): r.n for r in words_between(counted, least, 1 << 20).toLocalIterator()}  # at most ``frequent`` words
    denominator = tokens + 0.1 * (vocabulary + 1)
    shared = spark.sparkContext.broadcast(table | {BEGIN: training["texts"]})

    def known(block: Block) -> np.ndarray:
        return np.fromiter(map(shared.value.get, block.words, repeat(-1)), np.int64, len(block.words))

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for number, sizes, listed, numbers in zip(*(c.to_pylist() for c in part.columns), strict=True):
                block = Block(listed, numbers, sizes)
                keys, _, _ = block.pairs()
                order, cuts = order_of(keys, parts_bits)
                keys = in_part(keys[order], parts_bits)
                _, rare = rare_words(block, known(block))
                word_order, word_cuts = order_of(word_keys(rare), parts_bits)
                rare = [rare[k] for k in word_order.tolist()]
                own = np.flatnonzero(np.diff(cuts) + np.diff(word_cuts))
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(own), number)),
                        pa.array(own, pa.int64()),
                        pa.array([packed_keys(keys[cuts[p] : cuts[p + 1]]) for p in own], pa.binary()),
                        pa.array([b"\n".join(rare[word_cuts[p] : word_cuts[p + 1]]) for p in own], pa.binary()),
                    ],
                    names=["block", "part", "keys", "rare"],
                )

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.select(["sizes", "words", "numbers"]).to_pylist()
        block = Block(row["words"], row["numbers"], row["sizes"])
        right = right.sort_by("part")
        keys, pair, _ = block.pairs()
        level = np.empty(len(keys), np.int64)
        level[order_of(keys, parts_bits)[0]] = np.frombuffer(b"".join(right.column("levels").to_pylist()), np.uint8)
        exact = known(block)
        at, rare = rare_words(block, exact)
        exact[at[order_of(word_keys(rare), parts_bits)[0]]] = np.frombuffer(b"".join(right.column("counts").to_pylist()), "<i8")
        c_history = exact[block.history]
        c_pair = np.minimum(COUNTS[level][pair], c_history)
        log_p = np.log10(exact + 0.1) - np.log10(denominator)
        p = ((exact + 0.1) / denominator)[block.word]
        ids, held = (left.column(name).combine_chunks().flatten() for name in ("ids", "held_out"))
        columns = [
            ids,
            held,
            pa.array(block.sizes, pa.int64()),
            pa.array(np.add.reduceat((exact > 0)[block.word].astype(np.int64), block.first)),
            pa.array(np.full(len(block.sizes), tokens)),
            pa.array(np.add.reduceat(log_p[block.word], block.first)),
            pa.array(np.add.reduceat(np.log10((c_pair + MU * p) / (c_history + MU)), block.first)),
        ]
        return pa.table(columns, names=[name, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    name = key
    asked = blocks.select("block", "sizes", "words", "numbers").mapInArrow(ask, "block long, part long, keys binary, rare binary")
    found = answers(asked, counted)
    schema = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(score, schema)
