"""Approximate nearest neighbours by multi-index hashing.

Vectors are coded in 128 bits: two rotations of the space, learned on a bounded sample so that signs
of the rotated coordinates lose little (iterative quantization), give one bit per coordinate each,
repeated until there are enough. A code is cut into 16 substrings of 8 bits, each indexed on its own.
If two codes differ in r bits or fewer, some substring pair differs in few bits (pigeonhole), so
probing every substring's near values retrieves every code within radius r. Those within r are
reranked by distance on the original vectors.

r is set from the sample: the radius within which the sample's own nearest neighbours lie for a
share ``target`` of the pairs. A query that finds fewer than k neighbours within r is searched again
with the whole code length as radius, which retrieves everything, so every query gets k if there are k.

The index is cut into blocks of bounded size and so is the stated set of queries; every block of
queries visits every block of the index. Each pair of blocks returns k rows per query.

Vectors that are null, of another length than most, zero, or hold null or non-finite components take
no part, neither as query nor as candidate; the same goes for null ids. Equal vectors are indexed
like others. Ties go to the smaller id; repeated ids are the same vector to a query, which never
finds its own id, and each id is returned once at its nearest row. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from footfall.llm.common import stage

BITS, SUBSTRING = 128, 8
#: Vectors to learn on (a documented bound), index rows and query rows in one block.
SAMPLE, INDEX_BLOCK, QUERY_BLOCK = 8_000, 8_192, 128
TARGET = 0.95


# -- learning on the sample


def learn_rotations(x, bits=BITS, rounds=30, seed=7):
    """(mean, projection) whose signs code a vector: ITQ rotations of ``x``, one after another."""
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    centred = x - mean
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)]
    dims, blocks = x.shape[1], []
    while sum(b.shape[1] for b in blocks) < bits:
        keep = min(dims, bits - sum(b.shape[1] for b in blocks))
        y = centred @ axes[:, :keep]
        rotation = np.linalg.qr(rng.normal(size=(keep, keep)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(y @ rotation).T @ y)
            rotation = (u @ v).T
        blocks.append(axes[:, :keep] @ rotation)
    return mean, np.concatenate(blocks, axis=1)


def codes(x, mean, projection):
    return np.packbits((x - mean) @ projection > 0, axis=1)


def learn_radius(x, mean, projection, k, target):
    """Hamming radius that holds a share ``target`` of the pairs (vector, one of its k nearest)."""
    some = x[:: max(1, len(x) // 200)][:200]
    distance = ((some**2).sum(1)[:, None] - 2 * some @ x.T) + (x**2).sum(1)[None]
    near = np.argsort(distance, axis=1)[:, 1 : k + 1]
    c, s = codes(x, mean, projection), codes(some, mean, projection)
    apart = np.bitwise_count(c[near] ^ s[:, None, :]).sum(axis=2)
    return int(np.quantile(apart, target)) if apart.size else 0


# -- searching one block


def _neighbours_of_byte():
    """For every radius and byte value, the values within that radius."""
    apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None])
    return [[np.flatnonzero(apart[v] <= r) for v in range(256)] for r in range(SUBSTRING + 1)]


class MultiIndex:
    """Substring tables over the codes of one block."""

    def __init__(self, code):
        self.code = code
        self.order = [np.argsort(code[:, m], kind="stable") for m in range(code.shape[1])]
        self.start = [np.searchsorted(code[:, m][o], np.arange(257)) for m, o in enumerate(self.order)]

    def within(self, query, radius, near):
        """Places of all codes within ``radius`` of ``query``."""
        parts = self.code.shape[1]
        # r = parts * q + rest: one of the first rest + 1 substrings is within q, or a later one within q - 1.
        q, rest = divmod(radius, parts)
        seen = np.zeros(len(self.code), bool)
        for m in range(parts):
            reach = min(q if m <= rest else q - 1, SUBSTRING)
            if reach < 0:
                continue
            order, start = self.order[m], self.start[m]
            for value in near[reach][query[m]]:
                seen[order[start[value] : start[value + 1]]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.code[found] ^ query).sum(axis=1) <= radius]


def _nearest(ids, x, own, query, k):
    """(ids, distances) of the k nearest, by exact distance in double precision, then by id."""
    keep = ids != own
    ids, x = ids[keep], x[keep]
    distance = np.sqrt(((x - query) ** 2).sum(axis=1))
    order = np.lexsort((ids, distance))
    ids, distance = ids[order], distance[order]
    first = np.sort(np.unique(ids[: 4 * k], return_index=True)[1])
    if len(first) < k < len(ids):
        first = np.sort(np.unique(ids, return_index=True)[1])
    return ids[first[:k]], distance[first[:k]]


def _search(mean, projection, radius, k):
    def of_batches(batches):
        near = _neighbours_of_byte()
        for batch in batches:
            for n in range(batch.num_rows):
                ids, x, own, queries = (batch.column(i)[n].as_py() for i in range(4))
                ids, own = np.frombuffer(ids, np.int64), np.frombuffer(own, np.int64)
                x = np.frombuffer(x).reshape(len(ids), -1)
                queries = np.frombuffer(queries).reshape(len(own), -1)
                index = MultiIndex(codes(x, mean, projection))
                out = ([], [], [])
                for i, (q, code) in enumerate(zip(queries, codes(queries, mean, projection))):
                    places = index.within(code, radius, near)
                    got, distance = _nearest(ids[places], x[places], own[i], q, k)
                    for column, v in zip(out, (np.full(len(got), own[i]), got, distance)):
                        column.append(v)
                columns = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return of_batches


def _blocks(rows, dims, names):
    """Rows (id, vector) packed into rows of two binary columns."""

    def of_batches(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), dims)
            for i in range(0, len(ids), rows):
                pair = [[ids[i : i + rows].astype(np.int64).tobytes()], [x[i : i + rows].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in pair], names=names)

    return of_batches


def usable(vectors, id_col="vec_id", vector_col="embedding"):
    """(vec_id, v): the vectors that take part, of the length most vectors have."""
    v = F.col(vector_col).cast("array<double>")
    good = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
        & F.exists("v", lambda c: c != 0)
    )
    lengths = good.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return (good.filter(F.size("v") == lengths.dims), lengths.dims) if lengths else (good, 0)


def nearest(vectors, is_query, k=10, target=TARGET, id_col="vec_id", vector_col="embedding"):
    """The k nearest found of every row where ``is_query`` (a condition on vec_id) holds.

    Returns (query_id, rank, vec_id, score).
    """
    spark = vectors.sparkSession
    good, dims = usable(vectors, id_col, vector_col)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not dims:
        return empty
    # Sampled by hash, so every run learns the same rotations.
    learned = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    x = np.stack(learned.to_numpy()).astype(float)
    mean, projection = learn_rotations(x)
    radius = learn_radius(x, mean, projection, k, target)
    names, schema_of = [["ids", "x"], ["own", "queries"]], ["ids binary, x binary", "own binary, queries binary"]
    blocks = stage(good.repartition(_block_count(good, INDEX_BLOCK)).mapInArrow(_blocks(INDEX_BLOCK, dims, names[0]), schema_of[0]), "index")
    asked = good.filter(is_query)
    queries = stage(asked.repartition(_block_count(asked)).mapInArrow(_blocks(QUERY_BLOCK, dims, names[1]), schema_of[1]), "query_blocks")

    def search(pairs, r):
        return pairs.mapInArrow(_search(mean, projection, r, k), "query_id bigint, vec_id bigint, score double")

    # The stated queries against all rows, in blocks.
    found = stage(search(blocks.crossJoin(queries), radius), "found")
    counts = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n"))
    enough = stage(counts.filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id")), "enough")
    few = good.filter(is_query).join(enough, "vec_id", "left_anti")
    if not few.isEmpty():
        few = stage(few.repartition(_block_count(few)).mapInArrow(_blocks(QUERY_BLOCK, dims, names[1]), schema_of[1]), "query_blocks")
        found = found.join(enough.select(F.col("vec_id").alias("query_id")), "query_id", "left_semi")
        found = found.unionByName(search(blocks.crossJoin(few), BITS))
    return _ranked(found, k)


def _block_count(rows, size=QUERY_BLOCK):
    return max(1, -(-rows.count() // size))


def _ranked(found, k):
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
