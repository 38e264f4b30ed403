"""Benchmark decontamination by spaced seeds.

A window of 13 words is cut into four blocks; each of six seeds looks at two of
them and ignores the others. With two substituted words at most, some seed sees
none of them, so no such overlap is missed. Hashes of the benchmark's windows
under each seed are set in a bitmap of fixed size that every worker gets; it
only keeps training windows from being shuffled that cannot match. The windows
that pass are joined with the benchmark's on their hashes, each distinct window
once, and verified word by word.

Words are runs of letters and digits in lower case. A benchmark text of 8 to 12
words is one window in three blocks; each of three seeds ignores one of them, so
one substituted word is found. A shorter text is no evidence and is not looked
for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Numbers, blocks_of, release, stored, text_bytes

WINDOW = 13
SHORTEST = 8
SUBSTITUTIONS = 2
#: Of a benchmark text of 8 to 12 words.
SHORT_SUBSTITUTIONS = 1
BLOCKS = ((0, 4), (4, 7), (7, 10), (10, 13))
#: Bits of the bitmap, a fixed size; two are set for each hash.
BITMAP_BITS = 1 << 26
#: Bytes of text taken at once.
BLOCK = 2 << 20
WORD = re.compile(r"[^\W_]+")
# Odd multipliers of the hash functions, from a seeded generator.
MULTIPLIERS = np.random.default_rng(23).integers(1 << 62, 1 << 63, 32, dtype=np.uint64) * 2 + 1


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, text after text, and where each text's end."""
    found = [WORD.findall(data.decode("utf-8", "replace").lower()) for data in texts]
    number = Numbers()
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(found)), np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in number), np.uint64, len(number))[ids]
    return hashes, np.cumsum([len(f) for f in found])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x = x * MULTIPLIERS[30]
    return x ^ x >> np.uint64(29)


def _span(words: np.ndarray, begin: int, end: int, count: int) -> np.ndarray:
    out = words[begin : begin + count] * MULTIPLIERS[begin]
    for k in range(begin + 1, end):
        out += words[k : k + count] * MULTIPLIERS[k]
    return out


def seed_keys(words: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """(seeds, windows): the hashes of all windows of that many words under each pair of blocks; three blocks below 13 words."""
    count = len(words) - length + 1
    if count <= 0:
        return np.zeros((0, 0), np.uint64)
    if length < WINDOW:
        ends = [k * length // 3 for k in range(4)]
        blocks = [_span(words, a, b, count) for a, b in zip(ends, ends[1:], strict=False)]
        return np.stack([_mix((blocks[a] ^ MULTIPLIERS[length]) * MULTIPLIERS[22 + s] + blocks[b]) for s, (a, b) in enumerate(combinations(range(3), 2))])
    blocks = [_span(words, a, b, count) for a, b in BLOCKS]
    return np.stack([_mix((blocks[a] ^ MULTIPLIERS[26 + s % 4]) * MULTIPLIERS[22 + s] + blocks[b]) for s, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))])


def window_hash(windows: np.ndarray) -> np.ndarray:
    """A name for each row of word hashes; not a sum that another window's hash is made of."""
    out = np.full(len(windows), MULTIPLIERS[windows.shape[1]])
    for k in range(windows.shape[1]):
        out = _mix(out ^ windows[:, k])
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Are both bits of a key set? The second is looked at only where the first is."""
    one = (keys & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    hit = (bitmap[one >> 6] >> (one & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    place = np.nonzero(hit)
    two = (keys[place] // np.uint64(BITMAP_BITS) % np.uint64(BITMAP_BITS)).astype(np.int64)
    hit[place] = (bitmap[two >> 6] >> (two & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return hit


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``seed`` (hash), ``length``, ``words`` (the window's word hashes) and ``item`` for every window and seed."""
    kind = benchmark.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for item, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                words, _ = words_of([data])
                length = min(WINDOW, len(words))
                if length < SHORTEST:
                    continue
                keys = seed_keys(words, length)
                windows = [_signed(words[i : i + length]).tolist() for i in range(keys.shape[1])]
                n = keys.size
                yield pa.record_batch(
                    [pa.array(_signed(keys).reshape(-1)), pa.array([length] * n, pa.int32()), pa.array(windows * len(keys), pa.list_(pa.int64())), pa.array([item] * n, part.column(0).type)],
                    names=["seed", "length", "words", "item"],
                )

    return benchmark.select(F.col(key), text_bytes(text)).mapInArrow(run, f"seed long, length int, words array<long>, item {kind}")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The rows that overlap with a benchmark text: ``doc`` (hash of key and text), ``key``, ``item_id`` (the smallest), ``n_windows``, ``first_word``, ``last_word``.

    An overlap is a window of 13 consecutive words of which two at most differ
    from a benchmark window (a whole text of 8 to 12 words: one at most). Null and empty texts overlap
    with nothing; an empty table on either side gives no rows. Rows with equal
    key and text are one. Other columns are ignored.
    """
    spark = docs.sparkSession
    tests = stored(benchmark_windows(benchmark, item).groupBy("seed", "length", "words").agg(F.min("item").alias("item")), "benchmark")
    bits = np.zeros(BITMAP_BITS // 64, np.uint64)
    # word number and bits: as many rows as the bitmap has words at most
    size = F.lit(BITMAP_BITS)
    unsigned = "cast(if(seed < 0, cast(seed as decimal(20,0)) + 18446744073709551616, seed) as decimal(20,0))"
    places = tests.select(F.expr(unsigned).alias("u")).select(F.explode(F.array((F.col("u") % size).cast("long"), (F.expr(f"floor(u / {BITMAP_BITS}, 0)").cast("decimal(20,0)") % size).cast("long"))).alias("bit"))
    for row in places.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toLocalIterator():
        bits[row.word] = np.uint64(row.bits & 0xFFFFFFFFFFFFFFFF)
    lengths = sorted(r.length for r in tests.select("length").distinct().collect())  # 8 to 13
    held = spark.sparkContext.broadcast(bits)
    kind = docs.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        bitmap = held.value
        for part in parts:
            for block in blocks_of(part, BLOCK):
                words, ends = words_of([data for *_, data in block])
                for length in lengths:
                    keys = seed_keys(words, length)
                    if not keys.size:
                        continue
                    hit = in_bitmap(bitmap, keys)
                    at = np.flatnonzero(hit.any(0))
                    owner = np.searchsorted(ends, at, side="right")
                    inside = at + length <= ends[owner]  # not across two texts
                    at, owner = at[inside], owner[inside]
                    if not len(at):
                        continue
                    windows = words[at[:, None] + np.arange(length)]
                    begin = np.append(0, ends[:-1])[owner]
                    columns = [
                        pa.array([block[k][0] for k in owner.tolist()], pa.int64()),
                        pa.array([block[k][1] for k in owner.tolist()], part.column(1).type),
                        pa.array(at - begin, pa.int32()),
                        pa.array(np.full(len(at), length), pa.int32()),
                        pa.array(_signed(window_hash(windows))),
                        pa.array(_signed(windows).tolist(), pa.list_(pa.int64())),
                        pa.array([_signed(keys[hit[:, i], i]).tolist() for i in at.tolist()], pa.list_(pa.int64())),
                    ]
                    yield pa.record_batch(columns, names=["doc", "id", "place", "length", "window", "words", "seeds"])

    marked = docs.select(F.xxhash64(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("doc"), F.col(key), text_bytes(text).alias("text"))
    hits = stored(marked.mapInArrow(run, f"doc long, id {kind}, place int, length int, window long, words array<long>, seeds array<long>"), "hits")
    distinct = hits.select("window", "length", "words", "seeds").dropDuplicates(["window", "length"]).withColumn("seed", F.explode("seeds")).drop("seeds")
    differing = F.aggregate(F.zip_with("words", "test", lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    joined = distinct.join(tests.select("seed", "length", F.col("words").alias("test"), "item"), ["seed", "length"])
    verified = joined.filter(differing <= F.when(F.col("length") == WINDOW, SUBSTITUTIONS).otherwise(SHORT_SUBSTITUTIONS)).groupBy("window", "length").agg(F.min("item").alias("item"))
    return (
        hits.select("doc", "id", "place", "length", "window")
        .join(verified, ["window", "length"])
        .groupBy("doc", "id")
        .agg(F.min("item").alias("item_id"), F.countDistinct("place").alias("n_windows"), F.min("place").alias("first_word"), F.max(F.col("place") + F.col("length") - 1).alias("last_word"))
        .withColumnRenamed("id", key)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """The table without the rows that ``contaminated`` finds; all others stay as they are."""
    found = contaminated(docs, benchmark, key, text, item).select(F.col("doc").alias("__doc"))
    marked = docs.withColumn("__hash", F.xxhash64(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return marked.join(found, F.col("__hash") == F.col("__doc"), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
