"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that occur once or a million times are one node. With radius r the
64 bits are cut into r + 2 blocks; two fingerprints within the radius agree in
two blocks at least, so each pair of blocks gives a bucket. Within a bucket the
bit planes are stored vertically, 64 fingerprints a word. A query's distances
to 64 fingerprints grow together in carry-save counters, bit by bit, and a
word is abandoned once all its counters exceed the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.buckets import forest, links_in_buckets
from tickloom.llm.common import release, space_words, stored, text_bytes
from tickloom.llm.components import connected_components

BITS = 64
SHINGLE = 3
RADIUS = 3
SEED = 42
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Words of 64 lanes compared at once.
CELLS = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = space_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), SEED)).astype(np.int64))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = [0, *ends[: -shingle].tolist()]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begins, (ends[shingle - 1 :] - 1).tolist(), strict=True)), np.uint64, len(begins))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_column(text: str = "text", shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        release()
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash(text_bytes(text))


def bucket_keys(fp: Column, radius: int = RADIUS) -> list[Column]:
    """A long for each pair of blocks: their bits, and the number of the pair."""
    edges = [BITS * k // (radius + 2) for k in range(radius + 3)]
    blocks = [F.shiftrightunsigned(F.shiftleft(fp, BITS - b), BITS - b + a) for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for number, (x, y) in enumerate(combinations(range(radius + 2), 2)):
        keys.append(F.xxhash64(F.lit(number), blocks[x], blocks[y]))
    return keys


def planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): bit b of 64 fingerprints in each word."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _order(fps: np.ndarray) -> list[int]:
    """Planes by how evenly they split the block: distances grow soonest."""
    share = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").mean(0)
    return np.argsort(np.abs(share - 0.5), kind="stable").tolist()


def within_radius(difference, alive: np.ndarray, order: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells (numbers) with lanes within the radius, and those lanes.

    ``difference(plane, cells)`` has the words of differing lanes; ``alive`` the
    lanes of each cell that are to be compared.
    """
    depth = max(1, radius.bit_length())
    cells = np.flatnonzero(alive)
    over = ~alive[cells]
    sums = [np.zeros(len(cells), np.uint64) for _ in range(depth)]
    for step, plane in enumerate(order):
        carry = difference(plane, cells)
        for k in range(depth):  # carry-save: a lane's counter is one bit of each sum
            sums[k], carry = sums[k] ^ carry, sums[k] & carry
        over |= carry
        if step % 4 == 3 or step == len(order) - 1:
            beyond = over
            if radius + 1 < 1 << depth:  # counters that can hold more than the radius
                above, equal = np.zeros_like(over), np.full_like(over, ALL)
                for k in reversed(range(depth)):
                    if radius >> k & 1:
                        equal = equal & sums[k]
                    else:
                        above |= equal & sums[k]
                        equal = equal & ~sums[k]
                beyond = over | above
            live = beyond != ALL
            if not live.all():
                cells, over, beyond = cells[live], over[live], beyond[live]
                sums = [s[live] for s in sums]
            if not len(cells):
                break
    return cells, ~beyond if len(cells) else np.zeros(0, np.uint64)


def _lanes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number and lane of every set bit."""
    bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.nonzero(bits)


def _one_group(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row of a group as query against its planes."""
    plane, n = planes(fps), len(fps)
    words, order = plane.shape[1], _order(fps)
    flips = np.where(np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T, ALL, np.uint64(0))
    valid = np.full(words, ALL)
    if n % 64:
        valid[-1] = np.uint64((1 << n % 64) - 1)
    at_once = max(1, CELLS // words)
    out_i, out_j = [], []
    for begin in range(0, n, at_once):
        count = min(at_once, n - begin)
        cell, hit = within_radius(lambda p, c, b=begin: plane[p][c % words] ^ flips[p][b + c // words], np.tile(valid, count), order, radius)
        which, lane = _lanes(hit)
        i, j = begin + cell[which] // words, cell[which] % words * 64 + lane
        i, j = forest(n, i, j)  # at most n links of each turn are kept
        out_i.append(i)
        out_j.append(j)
    return forest(n, np.concatenate(out_i), np.concatenate(out_j))


def _many_groups(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Small groups that lie one behind the other: the planes against themselves, moved on by 1, 2, ... rows."""
    plane, n = planes(fps), len(fps)
    order = _order(fps)
    out_i, out_j = [], []
    for shift in range(1, int(np.bincount(group).max())):
        same = np.zeros(plane.shape[1] * 64, bool)
        same[: n - shift] = group[shift:] == group[:-shift]
        alive = np.packbits(same, bitorder="little").view(np.uint64)
        s, back = np.uint64(shift), np.uint64(64 - shift)
        following = np.concatenate([plane[:, 1:], np.zeros((BITS, 1), np.uint64)], axis=1)
        moved = plane >> s | following << back
        cell, hit = within_radius(lambda p, c, m=moved: plane[p][c] ^ m[p][c], alive, order, radius)
        which, lane = _lanes(hit)
        i = cell[which] * 64 + lane
        out_i.append(i)
        out_j.append(i + shift)
    return forest(n, np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, int), np.zeros(0, int))


def near_fingerprints(radius: int = RADIUS):
    """The comparison for ``links_in_buckets``: nodes are fingerprints."""

    def compare(nodes: np.ndarray, _: list, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fps = np.ascontiguousarray(nodes).view(np.uint64)
        return _many_groups(fps, group, radius) if group[-1] > 0 or len(fps) <= 32 else _one_group(fps, radius)

    return compare


def fingerprint_components(fps: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``fp``, ``label`` (a fingerprint of its component) and ``component_id`` (the smallest ``key`` in it) for each distinct ``fp``."""
    classes = stored(fps.groupBy("fp").agg(F.min(key).alias("first")), "fingerprints")
    buckets = classes.select(F.col("fp").alias("node"), F.explode(F.array(*bucket_keys(F.col("fp"), radius))).alias("bucket"))
    found = connected_components(links_in_buckets(buckets, near_fingerprints(radius)))
    labelled = classes.join(found, classes.fp == found.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("label"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(firsts, "label").select("fp", "label", "component_id")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``key``, ``fp`` (64 bits), ``fingerprint`` (its 16 hex digits) and ``component_id`` of every row.

    Rows link if their fingerprints differ in ``radius`` bits or fewer;
    ``component_id`` is the smallest key reachable by links (null only if no key
    in the component is set). A null text counts as empty: fingerprint 0. Rows
    with a repeated key each get a row. Other columns are ignored. An empty
    table gives no rows.
    """
    fps = stored(docs.select(F.col(key), fingerprint_column(text, shingle).alias("fp")), "simhash")
    found = fingerprint_components(fps, key, radius).select("fp", "component_id")
    return fps.join(found, "fp").select(key, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The table without near-duplicates: of each component the row with the smallest key (null keys last), then fingerprint, stays, once."""
    # written, so that no text is hashed again where the join looks for null fingerprints, by a second Python worker of the task
    marked = stored(docs.select(*[F.col(f"`{c}`") for c in docs.columns], fingerprint_column(text, shingle).alias("__fp")), "simhash")
    fps = marked.select(F.col(key).alias("id"), F.col("__fp").alias("fp"))
    found = fingerprint_components(fps, "id", radius).select("fp", "label")
    best = fps.join(found, "fp").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("best"))
    kept = best.select(F.col("best.id").alias("__id"), F.col("best.fp").alias("__kept"))
    joined = marked.join(kept, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__kept")), "left_semi")
    return joined.dropDuplicates([key, "__fp"]).select(*[F.col(f"`{c}`") for c in docs.columns])
