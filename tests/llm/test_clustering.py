"""Centroid clustering against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import clustering
from footfall.llm.clustering import VantageTree, cluster_vectors


def brute(rows, k=16, rounds=3):
    """The clustering of (vec_id, vector) rows by comparing every vector with every centroid."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(64 * float(x)) for x in v]))
    mark = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=mark)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        for i, vs in members.items():
            centroids[i] = [sum(column) // len(vs) for column in zip(*vs)]
    found = [(vec_id, *near(v)) for vec_id, v in kept]
    spread = {}
    for _, d, i in found:
        spread[i] = spread.get(i, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((vec_id, i, d, spread[i], sum(spread.values()), sha[i]) for vec_id, d, i in found), key=repr)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def vectors(n, seed=3, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, 64).astype(np.float32)]) for i in range(n)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equals_brute_force(spark, kind):
    rows = vectors(150)
    rows += [(200 + i, rows[i % 5][1]) for i in range(40)]  # copies
    rows += [(7, rows[90][1]), (7, rows[91][1]), (None, rows[3][1]), (None, rows[4][1])]  # repeated and missing ids
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [None] * 64), (304, [math.nan] + [0.0] * 63), (305, [math.inf] * 64), (306, [0.0] * 64)]
    got = sorted(map(tuple, cluster_vectors(table(spark, rows, kind).repartition(5)).collect()), key=repr)
    assert got == brute(rows)


def test_few_vectors_ties_and_clashing_columns(spark):
    rows = [(i, [float(i % 3)] * 64) for i in range(12)]
    assert sorted(map(tuple, cluster_vectors(table(spark, rows)).collect()), key=repr) == brute(rows)
    few = rows[:2]
    extra = table(spark, few).withColumn("v", F.lit("x")).withColumn("cluster", F.lit(1)).withColumn("distance", F.lit(1))
    assert sorted(map(tuple, cluster_vectors(extra).collect()), key=repr) == brute(few)
    assert cluster_vectors(table(spark, [])).collect() == []
    assert cluster_vectors(table(spark, [(1, None)])).collect() == []
    assert cluster_vectors(table(spark, [(1, [1e30] * 64), (2, [1.0] * 64)])).select("vec_id").collect() == [(2,)]


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    top = clustering.component_limit(64) / 64
    rows = [(i, [rng.uniform(-top, top) for _ in range(64)]) for i in range(30)]
    got = {r.vec_id: (r.cluster, r.distance) for r in cluster_vectors(table(spark, rows, "double")).collect()}
    assert got == {r[0]: (r[1], r[2]) for r in brute(rows)}


@pytest.mark.parametrize("k", [1, 2, 4, 5, 17, 300])
def test_tree_finds_the_nearest_with_the_smallest_number(k):
    rng = np.random.default_rng(k)
    centroids = rng.integers(-3, 4, (k, 5))
    centroids[k // 2 :] = centroids[: k - k // 2]  # equal centroids
    x = rng.integers(-4, 5, (500, 5))
    number, distance = VantageTree(centroids).nearest(x)
    apart = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()


def test_tree_skips_most_of_well_separated_centroids(monkeypatch):
    rng = np.random.default_rng(1)
    centroids = rng.integers(-1000, 1000, (256, 2))
    x = centroids[rng.integers(0, 256, 200)] + rng.integers(-2, 3, (200, 2))
    compared, compare = [], VantageTree._compare
    monkeypatch.setattr(VantageTree, "_compare", lambda self, x, rows, numbers, *rest: compared.append(len(rows) * len(numbers)) or compare(self, x, rows, numbers, *rest))
    VantageTree(centroids).nearest(x)
    assert sum(compared) < 200 * 256 / 4


def test_too_many_centroids_to_broadcast(spark):
    with pytest.raises(ValueError, match="too many to broadcast"):
        cluster_vectors(table(spark, []), k=1_000_000)
