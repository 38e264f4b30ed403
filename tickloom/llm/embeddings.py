"""Cosine near-duplicates of vectors, all against all in tiles of int8 products.

A vector of length 1 is s q + e with q of int8 and the remainder e, whose
length is computed, not estimated. For two vectors

    |x.y - s_x s_y (q_x.q_y)| <= |x - e_x| |e_y| + |e_x| |y - e_y| + |e_x| |e_y|

so a pair is below the threshold for certain, above it for certain, or is
computed again from the original vectors in double precision. The integer
products are exact: their sums stay below 2^24, and float32 holds those.

Equal vectors are one class with a weight. Classes are dealt into tiles, each
pair of tiles is one group of rows, and a group gives each class's links
counted by weight and a forest of the links, not the links themselves. The work
is that of all pairs of different vectors; what is shuffled is each vector once
for each tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.buckets import forest
from tickloom.llm.common import stored
from tickloom.llm.components import connected_components

THRESHOLD = 0.9
#: Vectors of a tile, and numbers in it at most.
TILE_ROWS, TILE_NUMBERS = 8192, 1 << 22
#: Rows of one tile that meet the other at once.
STRIPE = 1024
#: More dimensions than this are summed up in slices, so that float32 sums of int8 products stay exact.
EXACT_DIMENSIONS = 1024
#: Covers the rounding of the scaled float32 products.
SLACK = 1e-5


class Quantised:
    """Vectors of length 1 as int8, with the exact lengths of what was rounded away."""

    def __init__(self, vectors: np.ndarray):
        self.raw = vectors.astype(np.float64)
        largest = np.abs(self.raw).max(1, keepdims=True)
        scaled = self.raw / largest  # no overflow, whatever the numbers
        unit = scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))
        self.unit = unit
        self.scale = np.abs(unit).max(1) / 127
        self.codes = np.rint(unit / self.scale[:, None]).astype(np.int8)
        kept = self.codes * self.scale[:, None]
        rest = unit - kept
        self.kept, self.rest = np.sqrt((kept * kept).sum(1)), np.sqrt((rest * rest).sum(1))
        self.as_float = self.codes.astype(np.float32)  # the type that has fast products


def tile_links(q: Quantised, a: np.ndarray, b: np.ndarray, weight: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between rows ``a`` and ``b`` (the same rows, or none in common): weight linked to each row, and a forest."""
    n = len(q.scale)
    linked, root = np.zeros(n), np.arange(n)
    same = a is b
    kept_b, rest_b, scale_b = q.kept[b].max(), q.rest[b].max(), q.scale[b].astype(np.float32)
    dimensions = q.codes.shape[1]
    columns = q.as_float[b]
    out_i, out_j = [], []
    for begin in range(0, len(a), STRIPE):
        rows = a[begin : begin + STRIPE]
        left = q.as_float[rows]
        if dimensions <= EXACT_DIMENSIONS:
            near = left @ columns.T
        else:
            near = sum((left[:, k : k + EXACT_DIMENSIONS] @ columns[:, k : k + EXACT_DIMENSIONS].T).astype(np.float64) for k in range(0, dimensions, EXACT_DIMENSIONS))
        near *= scale_b
        bound = q.kept[rows] * rest_b + q.rest[rows] * (kept_b + rest_b)
        possible = near >= ((threshold - bound - SLACK) / q.scale[rows])[:, None].astype(near.dtype)
        if same:
            possible &= np.arange(len(b))[None] > np.arange(begin, begin + len(rows))[:, None]
        i, j = np.nonzero(possible)
        if not len(i):
            continue
        for at in range(0, len(i), 1 << 20):
            pi, pj = i[at : at + (1 << 20)], j[at : at + (1 << 20)]
            x, y = rows[pi], b[pj]
            value = near[pi, pj] * q.scale[x]
            bound = q.kept[x] * q.rest[y] + q.rest[x] * (q.kept[y] + q.rest[y]) + SLACK
            sure = value - bound >= threshold
            open_ = np.flatnonzero(~sure & (value + bound >= threshold))
            for k in range(0, len(open_), 1 << 15):
                part = open_[k : k + (1 << 15)]
                sure[part] = cosine(q, x[part], y[part]) >= threshold
            x, y = x[sure], y[sure]
            linked += np.bincount(x, weight[y], n) + np.bincount(y, weight[x], n)
            new = root[x] != root[y]
            if new.any():
                p, r = forest(n, np.append(out_i, x[new]).astype(int), np.append(out_j, y[new]).astype(int))
                out_i, out_j = p, r
                root = np.arange(n)
                root[r] = p
    return linked, np.asarray(out_i, int), np.asarray(out_j, int)


def cosine(q: Quantised, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In double precision, from the vectors as they came unless their squares overflow."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        a, b = q.raw[x], q.raw[y]
        value = (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))
    odd = ~np.isfinite(value)
    if odd.any():
        value[odd] = (q.unit[x[odd]] * q.unit[y[odd]]).sum(1)
    return value


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows link if their cosine is ``threshold`` or more; ``n_links`` counts the
    other rows linked directly, ``component_id`` is the smallest key reachable.
    Null or zero vectors, and vectors with a null, NaN or infinite component,
    link with nothing; so do vectors of different length with each other. Rows
    with a repeated or null key are vectors of their own; a component without
    any key has a null id. Other columns are ignored.
    """
    value = F.col(vector)
    usable = value.isNotNull() & F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False)) & F.exists(value, lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("id"), value.alias("vec"), F.coalesce(usable, F.lit(False)).alias("usable"))
    good = rows.filter("usable").select("id", "vec")
    classes = stored(good.groupBy("vec").agg(F.count("*").alias("weight"), F.min("id").alias("first")).withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = {r.d: r.n for r in classes.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()}  # one row a vector length
    tiles = {d: -(-n // max(64, min(TILE_ROWS, TILE_NUMBERS // d))) for d, n in sizes.items()}
    of_length = F.create_map(*[F.lit(x) for pair in tiles.items() for x in pair]) if tiles else F.create_map(F.lit(0), F.lit(1))
    placed = classes.withColumn("d", F.size("vec")).withColumn("tiles", of_length[F.col("d")]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    grouped = placed.select("d", "own", "node", "weight", "vec", other).withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other")
    groups = grouped.repartition("d", "lo", "hi").sortWithinPartitions("d", "lo", "hi")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group(pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(pieces).combine_chunks()
            d, lo, hi = (table.column(n)[0].as_py() for n in ("d", "lo", "hi"))
            own = table.column("own").to_numpy()
            node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy().astype(np.float64)
            flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("vec").chunks])
            q = Quantised(flat.reshape(-1, d))
            a = np.flatnonzero(own == lo)
            b = a if lo == hi else np.flatnonzero(own == hi)
            if not len(a) or not len(b):
                return
            linked, i, j = tile_links(q, a, b, weight, threshold)
            some = np.flatnonzero(linked)
            if len(some):
                yield pa.record_batch([pa.array(node[some]), pa.nulls(len(some), pa.int64()), pa.array(linked[some].astype(np.int64))], names=["a", "b", "n"])
            if len(i):
                yield pa.record_batch([pa.array(node[i]), pa.array(node[j]), pa.nulls(len(i), pa.int64())], names=["a", "b", "n"])

        held: list[pa.RecordBatch] = []
        last = None
        for part in parts:
            keys = np.stack([part.column(n).to_numpy() for n in ("d", "lo", "hi")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), part.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if x == y:
                    continue
                now = tuple(keys[:, x].tolist())
                if held and now != last:
                    yield from group(held)
                    held = []
                last = now
                held.append(part.slice(x, y - x))
        if held:
            yield from group(held)

    found = stored(groups.mapInArrow(run, "a long, b long, n long"), "links")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    joined = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    labelled = classes.join(joined, "node", "left").withColumn("label", F.coalesce("component", "node"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    result = labelled.join(counts, "node", "left").join(firsts, "label").select("vec", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = good.join(result, "vec").select("id", "n_links", "component_id")
    alone = rows.filter("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
