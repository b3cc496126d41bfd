"""Near-duplicates by SimHash, found with a hierarchical index in Gray order.

A text's fingerprint has 64 bits, each the majority over the XXH64 values of its three-word
shingles. Two fingerprints link if they differ in at most two bits; linked documents and everything
reachable from them form a component.

Distinct fingerprints are sorted by Gray rank, the order in which a binary trie is walked with
every second branch reflected, so neighbours share leading bits and mostly more. A range exchange on
the rank cuts them into parts. A part is an upper node: the bits all its fingerprints share are
factored out as (mask, pattern), and a fingerprint that differs from the pattern in more than two
masked bits skips the whole part. Inside a part the sorted run is halved down to leaves; every node
factors the bits its run shares beyond its parent's, differences add up on the way down, and a
subtree is dropped as soon as they exceed two. Only fingerprints travel, never documents, and each
ball of radius two holds at most 2080 others, so links grow in proportion to the input.

Nulls and empty texts have no words and the fingerprint 0, linked like any other; fewer than three
words are one shingle. Repeated rows are kept. A null doc_id takes no part in choosing the smallest
id of a component. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from footfall.llm.common import stage
from footfall.llm.graph import components

SHINGLE = 3
RADIUS = 2
#: Fingerprints in one part of the index, and items in one leaf of a tree.
PART_ROWS, LEAF_ROWS = 2_048, 8
#: Upper bound of the number of parts; beyond 134 million fingerprints the parts grow instead.
MAX_PARTS = 65_536
QUERIES_AT_ONCE = 4_096


def shingle_hashes(text, shingle=SHINGLE):
    """The XXH64 value of every run of ``shingle`` words; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    runs = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words] if words else []
    return np.array([xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs], np.uint64)


def fingerprint(text, shingle=SHINGLE):
    return majority(shingle_hashes(text, shingle))


def majority(h):
    """The 64 bits that more than half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 8192):
        part = h[i : i + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs, id_col="doc_id", text_col="text", carry=()):
    """(doc_id, *carry, fp): the fingerprint of every row as a signed 64-bit number."""
    chosen = docs.select(F.col(id_col).alias("doc_id"), *carry, F.col(text_col).alias("text"))

    def of_batches(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            columns = [*batch.columns[:-1], pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "fp"])

    schema = ", ".join(f"{name} {kind}" for name, kind in chosen.dtypes[:-1])
    return chosen.mapInArrow(of_batches, f"{schema}, fp bigint")


def _rank_of_gray(col):
    """Position of a 64-bit word in Gray order, as a signed number that sorts like the unsigned one."""
    rank = col
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


# -- the tree


def build_tree(ones, some):
    """Levels of the index over items in Gray order, root first.

    An item is a fingerprint, or a part: ``ones`` holds the AND and ``some`` the OR of its
    fingerprints (uint64). A level is (first, last, mask, bits): the run of every node, and the bits
    that its run shares and its parent's does not share already.
    """
    levels, first, last = [], np.array([0]), np.array([len(ones)])
    outer = np.zeros(1, np.uint64)
    while True:
        starts = np.minimum(first, len(ones) - 1)
        shared_ones = np.bitwise_and.reduceat(ones, starts)
        shared = ~(shared_ones ^ np.bitwise_or.reduceat(some, starts))
        levels.append((first, last, shared & ~outer, shared_ones))
        if (last - first).max() <= LEAF_ROWS:
            return levels
        middle = (first + last) // 2
        first = np.stack([first, middle], 1).ravel()
        last = np.stack([middle, last], 1).ravel()
        outer = np.repeat(shared, 2)


def probe(ones, some, queries, radius=RADIUS):
    """Pairs (query number, item) where no more than ``radius`` of the bits the item fixes differ."""
    levels, fixed, found = build_tree(ones, some), ~(ones ^ some), []
    for begin in range(0, len(queries), QUERIES_AT_ONCE):
        batch = queries[begin : begin + QUERIES_AT_ONCE]
        who, node = np.arange(len(batch)), np.zeros(len(batch), np.int64)
        spent = np.zeros(len(batch), np.int64)
        for depth, (first, last, mask, bits) in enumerate(levels):
            spent = spent + np.bitwise_count((batch[who] ^ bits[node]) & mask[node])
            alive = spent <= radius
            who, node, spent = who[alive], node[alive], spent[alive]
            if depth + 1 < len(levels):
                who, spent = np.repeat(who, 2), np.repeat(spent, 2)
                node = np.stack([2 * node, 2 * node + 1], 1).ravel()
        first, last = levels[-1][:2]
        for step in range(int((last - first).max())):
            place = first[node] + step
            inside = place < last[node]
            q, place = who[inside], place[inside]
            near = np.bitwise_count((batch[q] ^ ones[place]) & fixed[place]) <= radius
            found.append(np.stack([q[near] + begin, place[near]]))
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


def spanning_links(a, b):
    """The pairs (a, b) reduced to one edge per vertex: to the smallest vertex of its component."""
    names, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(names))
    return names[moved], names[label[moved]]


def _search_part(index, probes):
    """Links between the fingerprints of one part and those sent to it."""
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not index.num_rows or not probes.num_rows:
        return none
    fps = index.column("fp").to_numpy()[np.argsort(index.column("rank").to_numpy())].view(np.uint64)
    queries = np.frombuffer(b"".join(probes.column("probes").to_pylist()), np.uint64)
    q, place = probe(fps, fps, queries)
    a, b = queries[q].view(np.int64), fps[place].view(np.int64)
    a, b = spanning_links(a[a != b], b[a != b])
    return pa.table({"a": a, "b": b})


def links(prints):
    """Edges (a, b) between fingerprints, enough to connect all of ``prints`` (fp) that link."""
    return _index(prints.select("fp"), RADIUS, PART_ROWS, _search_part)


def _index(prints, radius, part_rows, search):
    """Edges (a, b) that ``search`` finds in the parts of the index over ``prints`` (fp, ...).

    Every fingerprint is sent, with the other columns (64 bits each), to the parts within ``radius``.
    """
    carried = prints.columns
    ranked = stage(prints.select(*carried, _rank_of_gray(F.col("fp")).alias("rank")), "ranked")
    parts = min(max(1, -(-ranked.count() // part_rows)), MAX_PARTS)
    ranged = ranked.repartitionByRange(parts, "rank").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "gray_parts")
    # One row per part, MAX_PARTS at most whatever the number of fingerprints: 1.5 MB.
    upper = ranged.groupBy("part").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("some"))
    upper = sorted(upper.collect())
    numbers = np.array([r.part for r in upper], np.int64)
    ones = np.array([r.ones for r in upper], np.int64).view(np.uint64)
    some = np.array([r.some for r in upper], np.int64).view(np.uint64)

    def route(batches):
        for batch in batches:
            part, rows = batch.column(0).to_numpy(), np.stack([c.to_numpy() for c in batch.columns[1:]], 1)
            fp = np.ascontiguousarray(rows[:, 0])
            who, item = probe(ones, some, fp.view(np.uint64), radius)
            own, to = part[who], numbers[item]
            # A pair of parts is searched from one side only, and every part from as many as it searches.
            send = (own == to) | ((own < to) == ((own + to) % 2 == 0)) & (own != to)
            to, who = to[send], who[send]
            order = np.argsort(to, kind="stable")
            targets, at = np.unique(to[order], return_index=True)
            bulk = [rows[who[order[a:b]]].tobytes() for a, b in zip(at, [*at[1:], len(order)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(targets.astype(np.int32)), pa.array(bulk, pa.binary())], names=["to", "probes"]
            )

    # Fingerprints travel in bulk, one row per batch and part.
    sent = ranged.select("part", *carried).mapInArrow(route, "to int, probes binary")
    return ranged.groupBy("part").cogroup(sent.groupBy("to")).applyInArrow(search, "a bigint, b bigint")


# -- components and their representatives


def _row_hashes(docs):
    """Two 64-bit hashes over all columns of a row; nulls are told apart from absent values."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    cols += [c.isNull() for c in cols]
    return F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(1), *cols).alias("h2")


def _classes(prints):
    """(fp, component, component_id) of the fingerprints in ``prints`` (doc_id, fp)."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "distinct_prints")
    joined = stage(components(links(distinct.select("fp"))), "components")
    named = distinct.join(joined, distinct["fp"] == joined["vertex"], "left").select(
        "fp", "smallest", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    return stage(named.join(smallest, "component").select("fp", "component", "component_id"), "classes")


def simhash_components(docs, id_col="doc_id", text_col="text"):
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    prints = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    # Both sides are plain tables, so adaptive execution can split a fingerprint many rows share.
    return prints.join(_classes(prints).drop("component"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_each(docs, id_col="doc_id", text_col="text"):
    """One row of ``docs`` for every component: that with its smallest doc_id.

    Rows are told apart by a 128-bit hash of all their columns. Of several rows with the smallest id
    the one with the smallest hash is kept; rows without an id come last. Rows equal in all columns
    are one row repeated, and stand in one component.
    """
    prints = stage(fingerprints(docs, id_col, text_col, _row_hashes(docs)), "fingerprints")
    classes = _classes(prints).select("fp", "component")
    return _representatives(docs, prints.join(classes, "fp"))


def _representatives(docs, named):
    """The first row of ``docs`` of every component in ``named`` (doc_id, h1, h2, component)."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h1", "h2")).alias("first")
    keep = stage(named.groupBy("component").agg(first).select("first.h1", "first.h2"), "representatives")
    # Half the corpus or more is kept: the list outgrows any broadcast, so the same join serves every size.
    h1, h2 = _row_hashes(docs)
    known = docs.select("*", h1.alias("__h1"), h2.alias("__h2"))
    kept = known.join(keep.hint("merge"), (known["__h1"] == keep["h1"]) & (known["__h2"] == keep["h2"]))
    return kept.dropDuplicates(["__h1", "__h2"]).select(*[known[f"`{c}`"] for c in docs.columns])
