"""Integer centroids against all distances in plain Python integers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm.centroids import Arithmetic, centroid_clusters, limbs

ROWS = "vec_id long, embedding array<double>, label int"


def plain(rows, clusters, rounds, dimensions, scale=256):
    """{(key, vector): (cluster, distance)} and inertia, by the definition."""
    kept = [(k, v) for k, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(k, [math.floor(scale * x) if math.isfinite(scale * x) else int(x) * scale for x in v], v) for k, v in kept]
    order = sorted(whole, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[2]))
    centers = [v for _, v, _ in order[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centers)) for _, v, _ in whole]

    for _ in range(rounds):
        best = assign()
        for c in range(len(centers)):
            members = [v for (_, v, _), (_, i) in zip(whole, best, strict=True) if i == c]
            if members:
                centers[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    best = assign()
    return sorted((str(k), i, d if d < 1 << 63 else None) for (k, _, _), (d, i) in zip(whole, best, strict=True)), sum(d for d, _ in best)


def found(df):
    return sorted((str(r.vec_id), r.cluster, r.distance) for r in df.collect())


@pytest.mark.parametrize("spread", [1.0, 1e5, 1e9, 1e30, 1e300])
def test_equals_all_distances_at_every_size_of_number(spark, spread):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1) * spread for _ in range(4)]) for i in range(60)]
    rows += [(60, rows[0][1]), (60, rows[1][1]), (None, rows[2][1]), (61, [0.0] * 4), (62, [-0.001] * 4)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], ROWS).repartition(5)
    out = centroid_clusters(frame, clusters=7, rounds=3, dimensions=4)
    expected, inertia = plain(rows, 7, 3, 4)
    assert found(out) == expected
    assert {r.inertia for r in out.collect()} == {inertia if inertia < 1 << 63 else None}


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    # equal seeds: the second of them never wins and stays empty
    rows = [(i, [1.0, 1.0]) for i in range(6)] + [(9, [3.0, 5.0])]
    out = centroid_clusters(spark.createDataFrame([(*r, 0) for r in rows], ROWS), clusters=7, rounds=4, dimensions=2)
    expected, _ = plain(rows, 7, 4, 2)
    assert found(out) == expected
    assert len({r.cluster for r in out.collect()}) == 2


def test_odd_vectors_have_no_row(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [0.0, 0.0])]
    clash = "cluster string, k string, v string, distance string, sums int, place int, inertia string"
    frame = spark.createDataFrame([(*r, 0) for r in rows], ROWS).selectExpr("*", *[f"cast(null AS {c.split()[1]}) AS {c.split()[0]}" for c in clash.split(", ")])
    out = centroid_clusters(frame, clusters=40, rounds=5, dimensions=2)
    assert found(out) == plain(rows, 40, 5, 2)[0]
    assert out.count() == 3
    assert centroid_clusters(frame.filter("1 = 0"), dimensions=2).collect() == []
    assert centroid_clusters(frame, dimensions=3).collect() == []


def test_sizes_and_inertia(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(200)]
    out = centroid_clusters(spark.createDataFrame([(*r, 0) for r in rows], ROWS).repartition(8), clusters=4, rounds=2, dimensions=2).cache()
    by = out.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("d"), F.max("cluster_size").alias("size"), F.max("cluster_inertia").alias("inertia"))
    assert all(r.n == r["size"] and r.d == r.inertia for r in by.collect())
    assert out.filter(F.size("centroid") != 2).count() == 0


def test_limbs_add_up():
    for value in (0, 1, -1, 2**32, -(2**32) - 5, 3**200, -(3**200)):
        assert sum(d << 32 * i for i, d in limbs(value)) == value
    assert Arithmetic(256, 64).in_doubles and not Arithmetic(1 << 26, 64).in_doubles and Arithmetic(1 << 40, 64).wide
