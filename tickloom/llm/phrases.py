"""Word phrases that occur together more often than their parts let expect.

Frequent words are numbered by falling frequency. In each block of texts the
pairs of neighbouring numbers are dealt into tiles of ``TILE`` by ``TILE``
numbers. A tile that is well filled is counted by direct address, one ``bincount``
over its cells; the pairs of the other tiles are sorted and counted as
coordinates. Spark adds up the counts of all blocks. The frequent pairs are
numbered by falling frequency in their turn, each place of a block gets the
number of the pair that begins there, and neighbouring numbers are pairs again:
two phrases of k words that overlap in all but one make one of k + 1. A phrase
that is frequent is found, since all its parts are.

The counts are summed on the map side, so a common pair costs one row a block
at most and nothing gathers its places. A block finds the numbers of its own
distinct words or pairs in a broadcast table as long as that table is below
``LOOKUP_ROWS`` and ``LOOKUP_BYTES``, and by a join beyond; results are the same.

A block's words, pairs, counts and places are binary values, one each. Spark
hands them on; they are taken apart and put together in the Python tasks.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import ASCII_LOWER, Numbers, blocks_of, discard, stored, stored_at, text_bytes, valid_utf8

# What ends a piece of text. Words stand between spaces and tabs.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
LONGEST, LEAST, SHARE, TOP = 5, 100, 100, 2000
TILE = 256
#: A tile is counted by direct address if so many of its pairs occur for each of its cells.
FILL = 1 / 8
#: Bytes of text in a block.
BLOCK = 4 << 20
#: A table of numbers is broadcast up to this size.
LOOKUP_ROWS, LOOKUP_BYTES = 1 << 18, 16 << 20
#: Phrases of a language are cut to the first ``top`` in so many parts before they meet.
RANK_PARTS = 64
PLACE_BITS = 33
#: A task adds up the counts of so many pairs, or a quarter as many words, before it sends them; rows of a batch it sends.
MERGED, SENT = 1 << 20, 1 << 16
#: A join is asked for the keys of so many parts of the blocks in turn; only one part's questions are on disk.
ASKED_PARTS = 4
#: Rows of a page of a written block table; by itself Parquet would gather a hundred, which are a whole file.
PAGE = 1

WORD, PAIR = ["lang", "word"], ["left", "right"]
BLOCK_OF_PAIRS = pa.schema([("block", pa.int64()), *((k, pa.binary()) for k in ("left", "right", "counts", "ids"))])
BREAK = b"."
TRANSLATION = bytes(BREAK[0] if b in PIECE_ENDS else ASCII_LOWER[b] for b in range(256))


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words in lower case, with ``BREAK`` between pieces; it is never a word itself."""
    joined = BREAK.join(texts).translate(TRANSLATION)
    # no other white space is left: split() takes spaces and tabs
    return joined.replace(BREAK, b" " + BREAK + b" ").split()


def word_blocks(docs: DataFrame, lang: str, text: str, unknown: str) -> DataFrame:
    """``block``, ``lang``, ``n`` words, the distinct ``words`` between spaces, their ``counts``, and for each word the place of its distinct one (-1: a break)."""
    names = ["block", "lang", "n", "words", "counts", "ids"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << PLACE_BITS
        for part in parts:
            for rows in blocks_of(part, BLOCK):
                by_lang: dict[str, list[bytes]] = {}
                for name, data in rows:
                    by_lang.setdefault(name, []).append(data)
                for name, texts in by_lang.items():
                    words = words_of(valid_utf8(texts))
                    seen = Numbers({BREAK: 0})
                    ids = np.fromiter(map(seen.__getitem__, words), np.int32, len(words)) - 1
                    counts = np.bincount(ids + 1, minlength=len(seen))[1:]
                    columns = [[number], [name], [int(counts.sum())], [b" ".join(list(seen)[1:])], [packed(counts, "<i4")], [packed(ids, "<i4")]]
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.string(), pa.int64(), *[pa.binary()] * 3], strict=True)], names=names)
                    number += 1

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(unknown)).alias("lang"), text_bytes(text).alias("text"))
    return named.mapInArrow(run, "block long, lang string, n long, words binary, counts binary, ids binary")


def packed(numbers: np.ndarray, kind: str = "<i8") -> bytes:
    """Numbers as one binary value: Spark hands it on as it is, where it would take an array apart."""
    return numbers.astype(kind, copy=False).tobytes()


def unpacked(value: pa.Scalar, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def tile_counts(left: np.ndarray, right: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs (left, right), their counts, and for each given pair the place of its distinct one.

    Numbers are below 2^39, so that tiles and pairs within a block can be told apart in 64 bits.
    """
    if not len(left):
        return left, right, np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, row = np.unique(left // tile, return_inverse=True)
    columns, column = np.unique(right // tile, return_inverse=True)
    at = row * len(columns) + column
    tiles, which, filled = np.unique(at, return_inverse=True, return_counts=True)
    dense = filled >= FILL * tile * tile
    place = np.empty(len(left), np.int64)
    lefts, rights, counts = [], [], []
    known = 0
    direct = dense[which]
    if direct.any():
        slot = (np.cumsum(dense) - 1)[which[direct]]
        cell = (slot * tile + left[direct] % tile) * tile + right[direct] % tile
        count = np.bincount(cell)
        used = np.flatnonzero(count)
        place[direct] = (np.cumsum(count > 0) - 1)[cell]
        of = tiles[dense][used // (tile * tile)]
        lefts.append(rows[of // len(columns)] * tile + used // tile % tile)
        rights.append(columns[of % len(columns)] * tile + used % tile)
        counts.append(count[used])
        known = len(used)
    if not direct.all():
        rest = ~direct
        numbers, second = np.unique(right[rest], return_inverse=True)
        firsts, first = np.unique(left[rest], return_inverse=True)
        pairs, inverse, count = np.unique(first * len(numbers) + second, return_inverse=True, return_counts=True)
        place[rest] = known + inverse
        lefts.append(firsts[pairs // len(numbers)])
        rights.append(numbers[pairs % len(numbers)])
        counts.append(count)
    return np.concatenate(lefts), np.concatenate(rights), np.concatenate(counts), place


def ranked(counted: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """A written table with an ``id`` from 0 by falling ``n``, ties by ``keys``; no task sees more than its range."""
    counted = written(counted, purpose)[0]  # sorting by ranges reads its input twice
    placed = stored(counted.orderBy(F.desc("n"), *keys).withColumn("place", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("place", PLACE_BITS)
    sizes = sorted((r.part, r.rows) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect())  # a row a partition
    first, offsets = 0, []
    for name, rows in sizes:
        offsets.append((name, first))
        first += rows
    # from Arrow: of a list, Spark makes rows in Python workers, which stay
    before = placed.sparkSession.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip((-1, 0), *offsets, strict=True)], ["part", "before"]))
    numbered = placed.withColumn("part", part).join(F.broadcast(before), "part")
    return numbered.select((F.col("before") + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)).alias("id"), *keys, "n")


def slices(columns: list[np.ndarray | pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Columns as batches of ``SENT`` rows."""
    for begin in range(0, len(columns[0]), SENT):
        yield pa.record_batch([pa.array(c[begin : begin + SENT]) for c in columns], names=names)


def word_sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang``, ``word``, ``n``: the words of blocks, added up as far as ``MERGED`` of them go."""
    sums: dict[str, Counter[bytes]] = defaultdict(Counter)

    def taken() -> Iterator[pa.RecordBatch]:
        for lang, found in sums.items():
            yield from slices([pa.array([lang]).take(pa.array(np.zeros(len(found), np.int32))), pa.array(list(found), pa.binary()).cast(pa.string()), np.fromiter(found.values(), np.int64, len(found))], ["lang", "word", "n"])
        sums.clear()

    for part in parts:
        for lang, words, counts in zip(*part.columns, strict=True):
            found = sums[lang.as_py()]
            for word, n in zip(words.as_py().split(), unpacked(counts, "<i4").tolist(), strict=True):
                found[word] += n
            if sum(map(len, sums.values())) >= MERGED // 4:
                yield from taken()
    yield from taken()


def added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of all parts and the sums of their counts."""
    code = np.concatenate(codes)
    order = np.argsort(code)
    code = code[order]
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[begin], np.add.reduceat(np.concatenate(counts)[order], begin)


def pair_sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``left``, ``right``, ``n``: the pairs of blocks, added up as far as ``MERGED`` of them go; those beyond 31 bits as they are."""
    codes: list[np.ndarray] = []
    sums: list[np.ndarray] = []
    names = ["left", "right", "n"]

    def taken() -> Iterator[pa.RecordBatch]:
        code, count = codes.pop(), sums.pop()
        yield from slices([code >> 32, code & 0xFFFFFFFF, count], names)

    for part in parts:
        for row in zip(*part.columns, strict=True):
            left, right, counts = unpacked(row[0]), unpacked(row[1]), unpacked(row[2], "<i4").astype(np.int64)
            if max(left.max(initial=0), right.max(initial=0)) >= 1 << 31:
                yield from slices([left, right, counts], names)
                continue
            if not len(left):
                continue
            codes.append(left << 32 | right)
            sums.append(counts)
            if sum(map(len, codes)) >= MERGED:
                code, count = added_up(codes, sums)
                codes[:], sums[:] = [code], [count]
                if len(code) >= MERGED // 2:
                    yield from taken()
    if codes:
        code, count = added_up(codes, sums)
        codes[:], sums[:] = [code], [count]
        yield from taken()


def written(df: DataFrame, purpose: str, page_rows: int | None = None) -> tuple[DataFrame, str]:
    """:func:`stored_at`; then the driver collects its garbage, without which the shuffle files of what is written stay on disk."""
    out = stored_at(df, purpose, page_rows)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def frequent(blocks: DataFrame, keys: list[str], least: int, purpose: str) -> DataFrame:
    """``id``, ``keys`` and ``n`` of what the blocks count at least ``least`` times."""
    if keys == WORD:
        counts = blocks.select("lang", "words", "counts").mapInArrow(word_sums, "lang string, word string, n long")
    else:
        counts = blocks.select("left", "right", "counts").mapInArrow(pair_sums, "left long, right long, n long")
    # the tasks have added up what they can; dealt out first, the rows need no second table on that side
    return ranked(counts.repartition(*keys).groupBy(*keys).agg(F.sum("n").alias("n")).filter(F.col("n") >= least), keys, purpose)


class Lookup:
    """Numbers of words or pairs, for the blocks of a task."""

    def __init__(self, table: pa.Table, keys: list[str]):
        ids = table.column("id").to_numpy()
        if keys == WORD:
            self.known: dict[str, dict[bytes, int]] = defaultdict(dict)
            for lang, word, number in zip(table.column("lang").to_pylist(), table.column("word").cast(pa.binary()).to_pylist(), ids.tolist(), strict=True):
                self.known[lang][word] = number
            return
        left, right = (table.column(k).to_numpy() for k in keys)
        self.rights = np.unique(right)
        self.lefts = np.unique(left)
        code = np.searchsorted(self.lefts, left) * len(self.rights) + np.searchsorted(self.rights, right)
        order = np.argsort(code)
        self.code, self.ids = code[order], ids[order]

    def words(self, lang: str, words: list[bytes]) -> np.ndarray:
        """The id of each word, -1 if it has none."""
        known = self.known.get(lang, {})
        return np.array([known.get(w, -1) for w in words], np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id of each pair, -1 if it has none."""
        if not len(self.code):
            return np.full(len(left), -1, np.int64)
        row = np.minimum(np.searchsorted(self.lefts, left), len(self.lefts) - 1)
        column = np.minimum(np.searchsorted(self.rights, right), len(self.rights) - 1)
        code = row * len(self.rights) + column
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        hit = (self.lefts[row] == left) & (self.rights[column] == right) & (self.code[at] == code)
        return np.where(hit, self.ids[at], -1)


def asked_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block``, ``place``, ``lang``, ``word`` of the words of blocks."""
    for part in parts:
        for block, lang, words in zip(*part.columns, strict=True):
            found = pa.array(words.as_py().split(), pa.binary()).cast(pa.string())
            yield from slices([np.full(len(found), block.as_py()), np.arange(len(found), dtype=np.int32), pa.array([lang.as_py()]).take(pa.array(np.zeros(len(found), np.int32))), found], ["block", "place", *WORD])


def asked_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block``, ``place``, ``left``, ``right`` of the pairs of blocks."""
    for part in parts:
        for block, left, right in zip(*part.columns, strict=True):
            left, right = unpacked(left), unpacked(right)
            yield from slices([np.full(len(left), block.as_py()), np.arange(len(left), dtype=np.int32), left, right], ["block", "place", *PAIR])


def next_block(block: int, numbers: np.ndarray, ids: np.ndarray) -> list[tuple[str, pa.Array]]:
    """The columns of a block of the pairs of neighbouring numbers, of none without any; ``numbers``: those of its keys, -1 if unknown."""
    here = np.append(numbers, -1)[ids]  # place -1 stays -1
    both = (here[:-1] >= 0) & (here[1:] >= 0)
    if not both.any():
        return []
    left, right, counts, place = tile_counts(here[:-1][both], here[1:][both])
    out = np.full(len(both), -1, np.int32)
    out[both] = place
    values = {"left": packed(left), "right": packed(right), "counts": packed(counts, "<i4"), "ids": packed(out, "<i4")}
    return [("block", pa.array([block], pa.int64())), *((k, pa.array([v], pa.binary())) for k, v in values.items())]


def next_blocks(blocks: DataFrame, known: DataFrame, keys: list[str], lookup_rows: int) -> tuple[DataFrame, list[str]]:
    """Blocks of the pairs of neighbouring numbers, those without any go; and the folders that they are made from."""
    spark = blocks.sparkSession
    columns = ["lang", "words"] if keys == WORD else PAIR
    schema = "block long, left binary, right binary, counts binary, ids binary"
    width = F.octet_length("word") + F.octet_length("lang") if keys == WORD else F.lit(16)
    size = known.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    if size.rows <= lookup_rows and size.bytes <= LOOKUP_BYTES:
        table = spark.sparkContext.broadcast((known.select("id", *keys).toArrow(), keys))

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = Lookup(*table.value)
            for part in parts:
                for block, a, b, ids in zip(*part.columns, strict=True):
                    numbers = lookup.words(a.as_py(), b.as_py().split()) if keys == WORD else lookup.pairs(unpacked(a), unpacked(b))
                    if out := next_block(block.as_py(), numbers, unpacked(ids, "<i4")):
                        yield pa.record_batch(dict(out))

        return blocks.select("block", *columns, "ids").mapInArrow(run, schema), []

    def met(block: pa.Table, found: pa.Table) -> pa.Table:
        ids = unpacked(block.column("ids")[0], "<i4")
        numbers = np.full(int(ids.max(initial=-1)) + 1, -1, np.int64)
        numbers[found.column("place").to_numpy()] = found.column("id").to_numpy()
        out = next_block(block.column("block")[0].as_py(), numbers, ids) if found.num_rows else []
        return pa.table(dict(out) or {f.name: pa.array([], f.type) for f in BLOCK_OF_PAIRS}, schema=BLOCK_OF_PAIRS)

    found, folders = [], []
    for part in range(ASKED_PARTS):
        some = blocks.select("block", *columns).filter(F.pmod(F.xxhash64("block"), F.lit(ASKED_PARTS)) == part)
        if keys == WORD:
            asked = some.mapInArrow(asked_words, "block long, place int, lang string, word string")
        else:
            asked = some.mapInArrow(asked_pairs, "block long, place int, left long, right long")
        answers, folder = written(asked.join(known.select("id", *keys), keys).select("block", "place", "id"), "numbers")
        found.append(answers)
        folders.append(folder)
    numbers = reduce(DataFrame.unionByName, found)
    return blocks.select("block", "ids").groupBy("block").cogroup(numbers.groupBy("block")).applyInArrow(met, schema), folders  # at most a block's keys


def scored_phrases(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    lang: str = "lang",
    text: str = "text",
    unknown: str = "und",
    lookup_rows: int = LOOKUP_ROWS,
) -> DataFrame:
    """``lang``, ``words``, ``a``, ``l``, ``r``, ``n``, ``score`` of every phrase that is frequent and not a part of another.

    Per language (null: ``unknown``): n counts all words, a the places of the
    phrase, l and r those of the parts of its weakest cut, score is
    floor(1000 a n / (l r)). A phrase has 2 to ``longest`` words of one piece of
    text and ``least`` places or more. It is left out if a longer phrase that
    holds it has ``share`` percent of its places. Null, empty and one-word
    texts have no phrases; equal rows count each. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    blocks, folder = written(word_blocks(docs, lang, text, unknown), "words", PAGE)
    spark, keys = docs.sparkSession, WORD
    totals = stored(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = frequent(blocks, keys, least, "ranks")
    one = F.array("n")
    levels = [stored(known.select("id", "lang", F.array("word").alias("words"), one.alias("prefixes"), one.alias("suffixes"), "n"), "phrases")]
    pairs = []
    for size in range(2, longest + 1):
        paired, used = next_blocks(blocks, known, keys, lookup_rows)
        blocks, new = written(paired, "pairs", PAGE)
        for old in (folder, *used):
            discard(spark, old)
        folder, keys = new, PAIR
        known = frequent(blocks, keys, least, "ranks")
        shorter = levels[-1]
        a = shorter.select(F.col("id").alias("left"), "lang", "words", "prefixes")
        b = shorter.select(F.col("id").alias("right"), F.element_at("words", -1).alias("last"), "suffixes")
        longer = known.join(a, "left").join(b, "right")
        levels.append(
            stored(
                longer.select("id", "lang", F.concat("words", F.array("last")).alias("words"), F.concat("prefixes", one).alias("prefixes"), F.concat("suffixes", one).alias("suffixes"), "n"),
                "phrases",
            )
        )
        pairs.append(known)
    discard(spark, folder)
    kept = []
    for number, level in enumerate(levels[1:], 1):
        if number < len(pairs):
            # what lies deeper inside a longer phrase lies inside one of a word more, which has as many places
            inside = pairs[number].select(F.explode(F.array("left", "right")).alias("id"), "n")
            inside = inside.groupBy("id").agg(F.max("n").alias("longer"))
            level = level.join(inside, "id", "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("n"), F.lit(True))).drop("longer")
        kept.append(level.drop("id"))
    phrases = reduce(DataFrame.unionByName, kept).withColumnRenamed("n", "a").join(totals, "lang")
    cuts = "transform(sequence(1, size(words) - 1), k -> struct(cast(1000 AS decimal(4, 0)) * (cast(a AS decimal(19, 0)) * n) div (cast(prefixes[k - 1] AS decimal(19, 0)) * suffixes[size(words) - k - 1]) AS score, k, prefixes[k - 1] AS l, suffixes[size(words) - k - 1] AS r))"
    weakest = F.array_min(F.expr(cuts))
    return phrases.withColumn("cut", weakest).select("lang", "words", "a", F.col("cut.l"), F.col("cut.r"), "n", F.col("cut.score"))


def collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The first ``top`` phrases of each language by score, places and text: ``lang``, ``rank``, ``phrase`` and their numbers.

    Options and results for odd input are those of ``scored_phrases``.
    """
    phrases = scored_phrases(docs, **options).withColumn("phrase", F.array_join("words", " ")).drop("words")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for by in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))], [F.col("lang")]):
        phrases = phrases.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return phrases.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP) -> str:
    """The registered query in SQL: every place of every phrase as a row, for tables of some thousand texts."""
    return rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, {longest + 1}) s(k)),
        f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS n FROM places GROUP BY ALL HAVING count(*) >= {least}),
        totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
        parts AS MATERIALIZED (SELECT lang, k, phrase, n, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        held AS (
            SELECT DISTINCT lang, phrase FROM (
                SELECT b.lang, array_to_string(b.w[i : i + j - 1], ' ') AS phrase, b.n FROM parts b, range(2, {longest}) s(j), range(1, {longest}) t(i)
                WHERE j < b.k AND i + j - 1 <= b.k
            ) b JOIN f USING (lang, phrase) WHERE 100 * b.n >= {share} * f.n
        ),
        cuts AS (
            SELECT c.lang, c.phrase, c.n AS a, x.n AS l, y.n AS r, t.n AS n, c.c AS c, (1000 * CAST(c.n AS HUGEINT) * t.n) // (CAST(x.n AS HUGEINT) * y.n) AS score
            FROM (SELECT *, unnest(range(1, k)) AS c FROM parts ANTI JOIN held USING (lang, phrase)) c
            JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.c], ' ')
            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1 :], ' ')
            JOIN totals t ON t.lang = c.lang
        ),
        weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM weakest QUALIFY rank <= {top}
    """
