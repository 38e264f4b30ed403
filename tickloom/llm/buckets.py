"""Comparing the members of buckets, whatever a bucket's size.

Buckets of one member go. A bucket of more than ``tile`` members is cut into
tiles, and each pair of tiles is compared as a group of its own, so a group has
about two tiles at most and every pair of members meets in one. Groups are
dealt over tasks and sorted; a task streams through them. A comparison returns
a forest of the links it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

TILE = 4096
#: Groups up to this size are handed over many at a time.
SMALL = 32
SMALL_ROWS = 1 << 14

# (nodes, payloads, group number of each row) -> pairs of row numbers
Compare = Callable[[np.ndarray, list, np.ndarray], tuple[np.ndarray, np.ndarray]]


def different_buckets(rows: DataFrame) -> DataFrame:
    """``bucket`` and ``size`` of one of all buckets with the same members, if they are more than one: what these link is found once.

    Members are told by their number and by sums over the halves of their hashes.
    """
    h = F.xxhash64("node")
    halves = F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high")
    members = rows.groupBy("bucket").agg(F.count("*").alias("size"), *halves, F.min("node").alias("least"), F.max("node").alias("most"))
    return members.filter("size > 1").groupBy("size", "low", "high", "least", "most").agg(F.min("bucket").alias("bucket")).select("bucket", "size")


def grouped_tiles(rows: DataFrame, tile: int = TILE, sizes: DataFrame | None = None) -> DataFrame:
    """``bucket``, ``node`` and other columns: adds ``lo`` and ``hi``, the pair of tiles; a row is repeated for each pair it is part of.

    ``sizes``: ``bucket`` and ``size`` of the buckets asked for, else of all.
    """
    if sizes is None:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    tiles = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    placed = rows.join(sizes, "bucket").withColumns({"tiles": tiles, "own": own}).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return placed.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("size", "tiles", "own", "other")


def links_in_buckets(rows: DataFrame, compare: Compare, tile: int = TILE, payloads: DataFrame | None = None) -> DataFrame:
    """Links ``a``, ``b`` between nodes that share a bucket, as ``compare`` finds them.

    ``rows``: ``bucket`` (long), ``node`` (long). ``payloads``: ``node``,
    ``payload`` (binary), repeats allowed; only those of nodes that share a
    bucket travel, and of buckets with the same members one is compared.
    """
    tiles = grouped_tiles(rows, tile, None if payloads is None else different_buckets(rows))
    if payloads is None:
        tiles = tiles.withColumn("payload", F.lit(None).cast("binary"))
    else:
        tiles = stored(tiles, "buckets")
        needed = payloads.join(tiles.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
        tiles = tiles.join(needed, "node")
    groups = tiles.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, list, np.ndarray]] = []
        held_rows = 0

        def links(chunks: list[tuple[np.ndarray, list, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            node = np.concatenate([c[0] for c in chunks])
            payload = [x for c in chunks for x in c[1]]
            group = np.concatenate([np.full(len(c[0]), k) for k, c in enumerate(chunks)])
            i, j = compare(node, payload, group)
            if len(i):
                yield pa.record_batch([pa.array(node[i]), pa.array(node[j])], names=["a", "b"])

        def whole_groups() -> Iterator[tuple[np.ndarray, list]]:
            last, node, payload = None, [], []
            for part in parts:
                keys = np.stack([part.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("bucket", "lo", "hi")])
                nodes, values = part.column("node").to_numpy(zero_copy_only=False), part.column("payload").to_pylist()
                cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), len(nodes)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a == b:
                        continue
                    key = tuple(keys[:, a].tolist())
                    if key != last and node:
                        yield np.concatenate(node), payload
                        node, payload = [], []
                    last = key
                    node.append(nodes[a:b])
                    payload = payload + values[a:b] if payload else values[a:b]
            if node:
                yield np.concatenate(node), payload

        for node, payload in whole_groups():
            if len(node) < 2:
                continue
            if len(node) > SMALL:
                yield from links([(node, payload, node)])
                continue
            held.append((node, payload, node))
            held_rows += len(node)
            if held_rows >= SMALL_ROWS:
                yield from links(held)
                held, held_rows = [], 0
        if held:
            yield from links(held)

    return groups.select("bucket", "lo", "hi", "node", "payload").mapInArrow(run, "a long, b long")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same of ``n`` rows as the given ones, fewer than ``n``: each row with the first of its set."""
    root = np.arange(n)
    while len(i):  # hook the larger root on the smaller, then point every row at its root
        a, b = root[i], root[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        apart = lo != hi
        if not apart.any():
            break
        i, j, lo, hi = i[apart], j[apart], lo[apart], hi[apart]
        np.minimum.at(root, hi, lo)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    own = np.arange(n)
    linked = root != own
    return root[linked], own[linked]
