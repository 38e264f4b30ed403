"""Clustering around integer centroids with dot products that are kept and updated.

Each vector's exact dot product with every centroid is kept in a written table.
When the centroids move, only the components in which a centroid changed are
multiplied again: the product grows by (new - old) times the vector there. The
nearest centroid is then the smallest |c|^2 - 2 v.c; the lowest number wins a tie.

A round is one pass over the table: it writes the next one and, in a last row of
each task, the task's sums of components by cluster. The sums are added up by
Spark; what reaches the driver is one row of each cluster and component, however
many vectors there are. A cluster that holds most vectors costs no more than
others, since nothing is grouped by cluster but these sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import discard, shared_folder

CENTROIDS, ROUNDS, DIMENSIONS, SCALE = 40, 5, 64, 256
SEED_TEXT = "2:"
#: Sums travel in limbs, so that adding those of any number of tasks stays within a long.
LIMB_BITS = 32
COUNT, DISTANCE = -1, -2
LONG_MAX = (1 << 63) - 1
SUMS = "sums array<struct<cluster int, place int, limb int, total long>>"


def whole(x: float, scale: int) -> int:
    """floor(scale * x), exact for every finite x; the scale is a power of two."""
    product = scale * x
    return math.floor(product) if math.isfinite(product) else int(x) * scale


class Arithmetic:
    """Exact integer arithmetic in the fastest type that holds every sum there can be.

    ``top`` bounds the components, ``terms`` is the number of them.
    """

    def __init__(self, top: int, terms: int):
        largest = 4 * max(terms, 1) * max(top, 1) ** 2
        self.in_doubles = largest < 1 << 53
        self.wide = largest >= 1 << 62
        self.type = "string" if self.wide else "long"

    def matrix(self, column: pa.Array, width: int) -> np.ndarray:
        flat = column.flatten()
        values = np.array([int(x) for x in flat.to_pylist()], object) if self.wide else flat.to_numpy(zero_copy_only=False)
        return values.reshape(-1, width)

    def column(self, matrix: np.ndarray) -> pa.Array:
        flat = matrix.reshape(-1)
        values = pa.array([str(x) for x in flat], pa.string()) if self.wide else pa.array(flat, pa.int64())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]), values)

    def number(self, values: np.ndarray) -> pa.Array:
        return pa.array([str(x) for x in values], pa.string()) if self.wide else pa.array(values, pa.int64())

    def integers(self, rows: list[list[int]]) -> np.ndarray:
        return np.array(rows, object if self.wide else np.int64)

    def components(self, doubles: np.ndarray, scale: int) -> np.ndarray:
        if self.wide:
            return np.array([whole(x, scale) for x in doubles.reshape(-1).tolist()], object).reshape(doubles.shape)
        return np.floor(doubles * scale).astype(np.int64)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Doubles are used only where every partial sum is a whole number that they hold."""
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64) if self.in_doubles else a @ b


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(limb, signed digit) of an integer of any size; zero has none."""
    sign, rest, limb = (1, value, 0) if value >= 0 else (-1, -value, 0)
    while rest:
        if digit := rest & ((1 << LIMB_BITS) - 1):
            yield limb, sign * digit
        rest >>= LIMB_BITS
        limb += 1


class Totals:
    """Sums by cluster of one task: components, vectors, distances."""

    def __init__(self, clusters: int, width: int):
        self.width = width
        self.sums = np.zeros((clusters, width + 2), object)

    def add(self, vectors: np.ndarray, cluster: np.ndarray, distance: np.ndarray) -> None:
        if not len(cluster):
            return
        order = np.argsort(cluster, kind="stable")
        found, first, count = np.unique(cluster[order], return_index=True, return_counts=True)
        self.sums[found, : self.width] += np.add.reduceat(vectors[order], first, axis=0).astype(object)
        self.sums[found, self.width] += count.astype(object)
        self.sums[found, self.width + 1] += np.add.reduceat(distance[order].astype(object), first)

    def row(self) -> list[dict]:
        places = [*range(self.width), COUNT, DISTANCE]
        return [
            {"cluster": c, "place": places[j], "limb": limb, "total": digit}
            for c, j in zip(*np.nonzero(self.sums), strict=True)
            for limb, digit in limbs(int(self.sums[c, j]))
        ]


def added_up(state: DataFrame, clusters: int, width: int) -> np.ndarray:
    """Components, vectors and distances of each cluster over all tasks: ``clusters`` x ``width + 2`` integers."""
    parts = state.filter("sums IS NOT NULL").select(F.explode("sums").alias("s")).select("s.*")
    total = np.zeros((clusters, width + 2), object)
    for r in parts.groupBy("cluster", "place", "limb").agg(F.sum("total").alias("total")).collect():
        total[r.cluster, {COUNT: width, DISTANCE: width + 1}.get(r.place, r.place)] += r.total << LIMB_BITS * r.limb
    return total


def centroid_clusters(
    vectors: DataFrame,
    clusters: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed_text: str = SEED_TEXT,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_size``, ``cluster_inertia``, ``inertia`` and ``centroid`` of each vector.

    Kept are vectors of exactly ``dimensions`` components, none null or
    non-finite; the others have no row. A component x becomes floor(scale * x);
    ``scale`` is a power of two. The first centroids are the kept vectors whose
    key has the smallest SHA-256 behind ``seed_text``; equal keys go by their
    components, null keys come last. With fewer vectors than ``clusters`` each
    is a centroid. After ``rounds`` rounds of assigning all vectors and moving
    every centroid that has any to the floor of their mean, all are assigned
    once more. Distances are squared and exact for components of any size; one
    beyond 64 bits is null, as are sums of them. Rows with a repeated or null
    key are vectors of their own. Equal vectors are assigned alike. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    kept = vectors.select(F.col(key).alias("k"), values.alias("v")).filter((F.size(values) == dimensions) & finite)
    order = [F.sha2(F.concat(F.lit(seed_text), F.col("k").cast("string")), 256).asc_nulls_last(), "v"]
    seeds = kept.orderBy(*order).limit(clusters).collect()
    top = kept.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    math_of = Arithmetic(abs(whole(-top, scale)), dimensions)
    centroid = [[whole(x, scale) for x in r.v] for r in seeds]
    n = len(centroid)
    columns = f"k {kind}, components array<{math_of.type}>, products array<{math_of.type}>, cluster int, distance {math_of.type}, {SUMS}"
    names = ["k", "components", "products", "cluster", "distance", "sums"]

    def a_round(table: DataFrame, now: list[list[int]], before: list[list[int]] | None, last: bool) -> DataFrame:
        """Products brought up to date, nearest centroids, and the sums of each task."""

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            center = math_of.integers(now)
            lengths = (center * center).sum(1)
            change = None if before is None else center - math_of.integers(before)
            totals, sum_type = Totals(n, dimensions), pa.list_(pa.struct([("cluster", pa.int32()), ("place", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())]))
            key_type = None
            for part in parts:
                key_type = part.column(0).type
                if change is None:
                    doubles = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
                    data = math_of.components(doubles, scale)
                    products = math_of.products(data, center.T)
                else:
                    data = math_of.matrix(part.column(1), dimensions)
                    products = math_of.matrix(part.column(2), n).copy()
                    for c in np.flatnonzero((change != 0).any(1)):
                        moved = np.flatnonzero(change[c])
                        products[:, c] += math_of.products(data[:, moved], change[c, moved])
                score = lengths - 2 * products
                cluster = score.argmin(1).astype(np.int32)
                distance = (data * data).sum(1) + score[np.arange(len(data)), cluster]
                totals.add(data, cluster, distance)
                rows = len(data)
                arrays = [part.column(0), None, None, pa.array(cluster), math_of.number(distance), pa.nulls(rows, sum_type)]
                item = pa.string() if math_of.wide else pa.int64()
                arrays[1:3] = [pa.nulls(rows, pa.list_(item))] * 2 if last else [math_of.column(data), math_of.column(products)]
                yield pa.record_batch(arrays, names=names)
            if key_type is not None:
                item = pa.string() if math_of.wide else pa.int64()
                yield pa.record_batch(
                    [pa.nulls(1, key_type), pa.nulls(1, pa.list_(item)), pa.nulls(1, pa.list_(item)), pa.nulls(1, pa.int32()), pa.nulls(1, item), pa.array([totals.row()], sum_type)],
                    names=names,
                )

        return table.mapInArrow(run, columns)

    shown = f"`{key}` {kind}, cluster int, distance long, cluster_size long, cluster_inertia long, inertia long, centroid array<string>"
    if not n:
        return spark.createDataFrame([], shown)
    state, before, folder = kept, None, None
    for turn in range(rounds + 1):
        last = turn == rounds
        new = shared_folder(spark, "centroids")
        a_round(state, centroid, before, last).write.option("compression", "zstd").parquet(new)
        if folder:  # the new table is whole: nothing reads the old one again
            discard(spark, folder)
        folder, stored = new, spark.read.schema(columns).parquet(new)
        total = added_up(stored, n, dimensions)
        state = stored.filter("cluster IS NOT NULL").select("k", "components", "products")
        if not last:
            before = centroid
            centroid = [[int(s) // int(row[dimensions]) for s in row[:dimensions]] if row[dimensions] else centroid[c] for c, row in enumerate(total)]

    def fitting(value: int) -> int | None:
        return int(value) if value <= LONG_MAX else None

    whole_inertia = fitting(sum(total[:, dimensions + 1]))
    facts = [(c, int(total[c, dimensions]), fitting(total[c, dimensions + 1]), whole_inertia, [str(x) for x in centroid[c]]) for c in range(n)]
    about = spark.createDataFrame(facts, "cluster int, cluster_size long, cluster_inertia long, inertia long, centroid array<string>")
    assigned = stored.filter("cluster IS NOT NULL").select(F.col("k").alias(key), "cluster", F.col("distance").try_cast("long").alias("distance"))
    # one row of each centroid
    return assigned.join(F.broadcast(about), "cluster").select(key, "cluster", "distance", "cluster_size", "cluster_inertia", "inertia", "centroid")



def clusters_sql(clusters: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed_text: str = SEED_TEXT) -> str:
    """The registered query in SQL: all vectors against all centroids in every round, for tables of some thousand vectors."""
    square = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: CAST(p[1] - p[2] AS HUGEINT) * (p[1] - p[2])))"
    steps = [
        f"""v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed_text}' || vec_id)) - 1 AS number, e
            FROM (SELECT * FROM v ORDER BY sha256('{seed_text}' || vec_id) LIMIT {clusters})
        )""",
    ]
    for turn in range(rounds + 1):
        steps.append(
            f"""a{turn} AS MATERIALIZED (
            SELECT v.vec_id, any_value(v.e) AS e, min(struct_pack(d := {square}, c := c.number)) AS best FROM v CROSS JOIN c{turn} c GROUP BY v.vec_id
        )"""
        )
        if turn < rounds:
            steps.append(
                f"""s{turn} AS (
            SELECT best.c AS number, j, sum(e[j]) AS s, count(*) AS n FROM a{turn}, range(1, {dimensions + 1}) r(j) GROUP BY ALL
        ),
        m{turn} AS (SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM s{turn} GROUP BY number),
        c{turn + 1} AS MATERIALIZED (SELECT c.number, coalesce(m.e, c.e) AS e FROM c{turn} c LEFT JOIN m{turn} m USING (number))"""
            )
    return f"""
        WITH {", ".join(steps)}
        SELECT a.vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
               CAST(count(*) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_size,
               CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON c.number = best.c
    """
