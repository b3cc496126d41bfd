"""Centroid clustering: Lloyd's rounds whose assignments search a vantage-point tree over the centroids.

Vectors are turned into integers once and staged. Every round builds a vantage-point tree over the
current centroids on the driver and broadcasts it; its size is k x dimensions, checked against
``TREE_BYTES``. A node holds one centroid as vantage point and the ranges of squared distances from it
to the centroids of its two halves. Each vector walks the tree best first: of the nodes it has not
opened yet the one with the smallest lower bound comes next, and the walk ends when that bound lies
beyond the nearest centroid found. A bound equal to it is still opened (the radius is inclusive), so
that ties are seen, and bounds are lowered by more than rounding can take; what decides is the exact
integer distance. Ties go to the smaller centroid number. The vectors of a batch walk in step, each along
its own path.

Tasks add up their vectors per centroid before anything is shuffled, so k x dimensions rows per task
travel, however many vectors one centroid draws. Means are floors of exact integer quotients. A
centroid without vectors stays where it is.

Vectors that are null, of another length, or hold a null or non-finite component take no part. Nor
do those with a scaled component beyond ``component_limit`` (1.9e8 for 64 dimensions), whose
squared distances would not fit 64 bits. A vector with a null id takes part, and starts a centroid only
if too few others are there. Repeated ids are separate vectors; among equal ids the smaller vector starts
first. With fewer vectors than k there are as many centroids as vectors; equal centroids may start,
then the smaller number draws. An empty table gives no rows. Sums of distances beyond 64 bits are null.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.common import stage

DIMENSIONS, SCALE, K, ROUNDS, SEED = 64, 64, 16, 3, 1
#: Centroids in a leaf of the tree, entries of the table of bounds of vectors that walk in step, and the
#: largest set of centroids that is broadcast.
LEAF, BOUNDS, TREE_BYTES = 4, 1 << 20, 256 << 20
_FAR = np.iinfo(np.int64).max


def component_limit(dimensions):
    """The largest component for which all squared distances fit a signed 64-bit number."""
    return math.isqrt(_FAR // (4 * dimensions))


def squared_distances(x, y):
    """Exact squared distances of every row of ``x`` to every row of ``y`` (integers)."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1)


class VantageTree:
    """A vantage-point tree over the rows of an integer matrix."""

    def __init__(self, centroids):
        self.centroids = np.asarray(centroids, np.int64)
        #: Per node: its vantage point (none in leaves), members (of leaves), and children as (node, lo, hi), where
        #: lo and hi are the smallest and largest distance of the child's centroids from the vantage point.
        self.vantage, self.members, self.children = [], [], []
        self._grow(np.arange(len(self.centroids)))

    def _grow(self, numbers):
        node = len(self.vantage)
        for column in (self.vantage, self.members, self.children):
            column.append(None)
        if len(numbers) <= LEAF:
            self.members[node] = numbers
            return node
        from_first = squared_distances(self.centroids[numbers], self.centroids[numbers[:1]])[:, 0]
        at = int(from_first.argmax())
        self.vantage[node] = int(numbers[at])
        rest = np.delete(numbers, at)
        apart = squared_distances(self.centroids[rest], self.centroids[numbers[at]][None])[:, 0]
        order = np.argsort(apart, kind="stable")
        halves = np.split(order, [(len(order) + 1) // 2])
        self.children[node] = [
            (self._grow(rest[half]), math.sqrt(apart[half[0]]), math.sqrt(apart[half[-1]])) for half in halves
        ]
        return node

    def nearest(self, x):
        """(number, squared distance) of the nearest centroid of every row of ``x``."""
        step = max(1, BOUNDS // max(1, len(self.vantage)))
        found = [self._walk(x[i : i + step]) for i in range(0, len(x), step)]
        empty = [np.empty(0, np.int64)]
        return np.concatenate([f[0] for f in found] or empty), np.concatenate([f[1] for f in found] or empty)

    def _walk(self, x):
        best, who = np.full(len(x), _FAR), np.full(len(x), _FAR)
        bound = np.full((len(x), len(self.vantage)), np.inf)
        bound[:, 0] = 0.0
        walking = np.arange(len(x))
        while len(walking):
            node = bound[walking].argmin(axis=1)
            low = bound[walking, node]
            open_ = low <= np.sqrt(best[walking].astype(np.float64))
            walking, node, low = walking[open_], node[open_], low[open_]
            bound[walking, node] = np.inf
            for number in np.unique(node):
                here = node == number
                self._open(int(number), x, walking[here], low[here], best, who, bound)
        return who, best

    def _open(self, node, x, rows, low, best, who, bound):
        if self.vantage[node] is None:
            self._compare(x, rows, self.members[node], best, who)
            return
        apart = self._compare(x, rows, np.array([self.vantage[node]]), best, who)
        away = np.sqrt(apart.astype(np.float64))
        for child, lo, hi in self.children[node]:
            nearer = np.maximum(low, np.maximum(lo - away, away - hi))
            bound[rows, child] = nearer - 1e-9 * (away + hi + 1.0)

    def _compare(self, x, rows, numbers, best, who):
        for number in numbers:
            apart = ((x[rows] - self.centroids[number]) ** 2).sum(axis=1)
            better = (apart < best[rows]) | (apart == best[rows]) & (number < who[rows])
            best[rows[better]], who[rows[better]] = apart[better], number
        return apart


def _matrix(column, dimensions):
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def integer_vectors(vectors, id_col="vec_id", vector_col="embedding", dimensions=DIMENSIONS, scale=SCALE):
    """(vec_id, v): the vectors that take part, components as integers floor(scale * x)."""
    limit = component_limit(dimensions)
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("int"))
    usable = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) <= limit))
    whole = (F.size(vector_col) == dimensions) & usable
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col(id_col).alias("vec_id"), scaled.alias("v"))


def starting_centroids(vectors, k=K, seed=SEED):
    """The ``k`` vectors whose ids have the smallest SHA-256, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(mark.alias("mark"), "v").orderBy(F.asc_nulls_last("mark"), "v").limit(k)
    return [r.v for r in first.collect()]


def _sums(vectors, tree, dimensions):
    """(cluster, dim, total, n) of every centroid that draws vectors; one set of rows per task is shuffled."""

    def of_batches(batches):
        centroids = tree.value.centroids
        total, n = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            cluster = tree.value.nearest(x)[0]
            order = np.argsort(cluster, kind="stable")
            numbers, at = np.unique(cluster[order], return_index=True)
            if len(numbers):
                total[numbers] += np.add.reduceat(x[order], at, axis=0)
                n[numbers] += np.diff([*at, len(order)])
        drawn = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(drawn, dimensions).astype(np.int32)),
                pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(drawn))),
                pa.array(total[drawn].ravel()),
                pa.array(np.repeat(n[drawn], dimensions)),
            ],
            names=["cluster", "dim", "total", "n"],
        )

    partial = vectors.select("v").mapInArrow(of_batches, "cluster int, dim int, total bigint, n bigint")
    exact = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("total", "n")]
    return partial.groupBy("cluster", "dim").agg(*exact)


def _assigned(vectors, tree, dimensions):
    """(vec_id, cluster, distance) of every vector."""

    def of_batches(batches):
        for batch in batches:
            cluster, distance = tree.value.nearest(_matrix(batch.column(1), dimensions))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.select("vec_id", "v").mapInArrow(of_batches, f"vec_id {kind}, cluster int, distance bigint")


def _sha256(centroid):
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    vectors, k=K, rounds=ROUNDS, seed=SEED, id_col="vec_id", vector_col="embedding", dimensions=DIMENSIONS, scale=SCALE
):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    if k * dimensions * 8 > TREE_BYTES:
        raise ValueError(f"{k} centroids of {dimensions} components are too many to broadcast")
    spark = vectors.sparkSession
    points = stage(integer_vectors(vectors, id_col, vector_col, dimensions, scale), "integer_vectors")
    centroids = starting_centroids(points, k, seed)
    for _ in range(rounds if centroids else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        means = _sums(points, tree, dimensions).collect()  # k x dimensions rows at most
        moved = [list(c) for c in centroids]
        for r in means:
            moved[r.cluster][r.dim] = int(r.total) // int(r.n)
        tree.unpersist()
        centroids = moved
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    placed = stage(_assigned(points, tree, dimensions), "assigned")
    tree.unpersist()
    spread = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("spread")).collect()
    whole = sum(int(r.spread) for r in spread)
    fits = lambda n: n if n <= _FAR else None
    facts = [(r.cluster, fits(int(r.spread)), fits(whole), _sha256(centroids[r.cluster])) for r in spread]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(  # k rows at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
