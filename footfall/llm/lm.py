"""Language-model scoring: bigrams mixed by deleted interpolation.

The probability of a word after another is a mixture of maximum-likelihood estimates, of the bigram,
the unigram and a floor, with weights that depend on how often the context was seen (buckets by
powers of two). The weights are learned by expectation-maximisation on one tenth of the training
documents, scored with counts from which that tenth has been taken out again (deleted).

Counts need every token of the corpus but not one row per token. Documents are packed into blocks of
a few megabytes, compressed and staged. A block's distinct words and bigrams are hashed, sorted and
cut into shards by the leading bits of the hash; a shard adds up the counts of all blocks and answers
each block in the order it asked. A block then scores its documents from the answers. Frequent
words cost one entry per block, and the number of shards grows with the corpus. The deleted tenth has blocks of
its own, so that learning the weights reads no others.

Every text ends with an end token. Nulls are empty texts, the end alone. Null ids count as the id
"" in the split. Repeated rows are counted and scored as often as they occur. An empty table gives no
rows.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from footfall.llm.common import mix, shuffle_partitions, stage, word_hashes

#: Text of one block, distinct entries of one shard.
BLOCK_BYTES, SHARD_ENTRIES = 4 << 20, 2_000_000
#: Keys of a shard added up at once, blocks answered in one Arrow batch.
ADDED_AT_ONCE, ANSWERS_AT_ONCE = 300_000, 64
#: Blocks scored by one task; pairs of shard and kind added up by one.
BLOCKS_A_TASK, SHARDS_A_TASK = 2, 2
#: Context buckets: unseen, then 1, 2-3, 4-7, ... up to this many.
BUCKETS = 20
END_HASH = np.uint64(0x5DEECE66D2545F49)
ALPHA = 0.1


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def deleted_part(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 1


# -- blocks


def _pack(batches):
    """Rows (block, deleted, ids, lengths, data): documents packed up to ``BLOCK_BYTES`` of lower-cased text.

    Documents of the deleted part have blocks of their own.
    """
    import pyspark

    part, number = pyspark.TaskContext.get().partitionId(), 0
    open_ = {False: ([], []), True: ([], [])}
    size = {False: 0, True: 0}

    def block(deleted):
        ids, texts = open_[deleted]
        data = b"".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 32) + number], pa.int64()),
                pa.array([deleted]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([lengths.tobytes()], pa.binary()),
                pa.array([pa.compress(data, "zstd", asbytes=True) if data else b""], pa.binary()),
            ],
            names=["block", "deleted", "ids", "lengths", "data"],
        )

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            deleted = deleted_part(doc)
            open_[deleted][0].append(doc)
            open_[deleted][1].append(data)
            size[deleted] += len(data)
            if size[deleted] >= BLOCK_BYTES:
                yield block(deleted)
                open_[deleted], size[deleted], number = ([], []), 0, number + 1
    for deleted, (ids, _) in open_.items():
        if ids:
            yield block(deleted)
            number += 1


def _tokens(ids, lengths, data):
    """(word hashes with an end after every document, document number, first token of each)."""
    lengths = np.frombuffer(lengths, np.int64)
    total = int(lengths.sum())
    raw = pa.decompress(data, total, "zstd", asbytes=True) if total else b""
    view, at, words = memoryview(raw), 0, []
    for n in lengths.tolist():
        words.append(word_hashes(bytes(view[at : at + n])))
        words.append(np.array([END_HASH]))
        at += n
    counts = np.array([len(w) for w in words]).reshape(-1, 2).sum(axis=1)
    tokens = np.concatenate(words)
    return tokens, np.repeat(np.arange(len(ids)), counts), np.concatenate([[0], np.cumsum(counts)[:-1]])


def _bigrams(tokens, first):
    """Hash of every token with the one before; a document's first token follows the end token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = END_HASH
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens)), before


def _entries(ids, lengths, data):
    """Distinct words and bigrams of a block (sorted), where each token is among them, and roles."""
    tokens, doc, first = _tokens(ids, lengths, data)
    pairs, before = _bigrams(tokens, first)
    words, word_at = np.unique(tokens, return_inverse=True)
    grams, gram_at = np.unique(pairs, return_inverse=True)
    return words, word_at, grams, gram_at, doc, first


def _count(size, at, weight):
    return np.bincount(at[weight], minlength=size).astype(np.uint32)


def _ask(shards):
    """Per block and shard: sorted keys with their counts, in training and in the deleted part."""
    shift = np.uint64(64 - (shards - 1).bit_length()) if shards > 1 else None

    def of_batches(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                block, deleted, ids, lengths, data = (c[n].as_py() for c in batch.columns)
                words, word_at, grams, gram_at, doc, _ = _entries(ids, lengths, data)
                train = np.array([not held_out(i) for i in ids])[doc]
                gone = np.full(len(doc), deleted)
                out = []
                for kind, keys, at in ((1, words, word_at), (2, grams, gram_at)):
                    counts = [_count(len(keys), at, w) for w in (train, gone)]
                    where = (keys >> shift).astype(np.int64) if shift is not None else np.zeros(len(keys), np.int64)
                    cut = np.searchsorted(where, np.arange(shards + 1))
                    for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
                        a, b = cut[s], cut[s + 1]
                        out.append((s, kind, block, keys[a:b].tobytes(), counts[0][a:b].tobytes(), counts[1][a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3])],
                    names=["shard", "kind", "block", "keys", "train", "gone"],
                )

    return of_batches


ASK_SCHEMA = "shard int, kind int, block bigint, keys binary, train binary, gone binary"
ANSWER_SCHEMA = "shard int, kind int, block bigint, train binary, gone binary, total bigint, distinct bigint, gone_total bigint"


def _column(table, name, kind):
    """All values of a binary column in one array, without a copy where it is one chunk, and the size of each row in bytes."""
    column = table.column(name)
    column = column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()
    sizes = pc.binary_length(column).to_numpy()
    begin = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], kind, int(sizes.sum()) // kind().itemsize, begin), sizes


def _binary(values, lengths):
    """A binary column over one array of 64-bit values, ``lengths`` of them in each row; no longer than the keys' column."""
    offsets = np.concatenate([[0], np.cumsum(lengths * 8)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _add_up(table):
    """Counts of one kind and shard over all blocks, returned to each block in its order.

    Counts in the deleted part are returned to its own blocks only; others get an empty answer. The shard's keys are added up by ranges of ``ADDED_AT_ONCE``, so that beside the rows themselves little is held.
    """
    keys, sizes = _column(table, "keys", np.uint64)
    counts = [_column(table, name, np.uint32)[0] for name in ("train", "gone")]
    sums, totals, distinct = [np.empty(len(keys), np.int64) for _ in counts], [0, 0], 0
    low, ranges = keys.min(), -(-len(keys) // ADDED_AT_ONCE)
    width = np.maximum((keys.max() - low) // np.uint64(ranges), np.uint64(1))
    of_range = np.minimum((keys - low) // width, np.uint64(ranges - 1)).astype(np.int32)
    for number in range(ranges):
        chosen = np.flatnonzero(of_range == number)
        joint, at = np.unique(keys[chosen], return_inverse=True)
        for j, count in enumerate(counts):
            # Exact: a double holds whole numbers up to 2^53.
            added = np.bincount(at, weights=count[chosen], minlength=len(joint)).astype(np.int64)
            sums[j][chosen] = added[at]
            totals[j] += int(added.sum())
            if j == 0:
                distinct += int(np.count_nonzero(added))
    n, lengths = len(sizes), sizes // 8
    within = np.maximum.reduceat(counts[1], np.cumsum(lengths) - lengths) > 0
    # Totals stand on one answer of every shard.
    once = lambda x: [x] + [0] * (n - 1)
    out = pa.table({
        "shard": table.column("shard"), "kind": table.column("kind"), "block": table.column("block"),
        "train": _binary(sums[0], lengths), "gone": _binary(sums[1][np.repeat(within, lengths)], lengths * within),
        "total": once(totals[0]), "distinct": once(distinct), "gone_total": once(totals[1]),
    })
    return pa.Table.from_batches(out.to_batches(max_chunksize=ANSWERS_AT_ONCE))


def _answers_of(answers):
    """Counts in the order of the block's sorted keys: those of words, then those of bigrams, by the columns given."""
    ordered = sorted(answers, key=lambda a: (a["kind"], a["shard"]))
    out = []
    for kind in (1, 2):
        for name in ("train", "gone"):
            parts = [np.frombuffer(a[name], np.int64) for a in ordered if a["kind"] == kind and name in a]
            out.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
    return out


# -- the model


def bucket(count):
    """Context bucket of a count: 0 for unseen, else 1 + floor(log2), at most BUCKETS - 1."""
    return np.where(count > 0, np.minimum(np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, BUCKETS - 1), 0)


def estimates(c_pair, c_context, c_word, total, distinct):
    """The three estimates that are mixed: bigram, unigram, and the add-``ALPHA`` unigram as floor."""
    two = np.where(c_context > 0, c_pair / np.maximum(c_context, 1), 0.0)
    one = c_word / max(total, 1)
    floor = (c_word + ALPHA) / (total + ALPHA * (distinct + 1))
    return two, one, floor


def learn_weights(cells, total, distinct, iterations=30):
    """Mixture weights per bucket from ``cells`` (bucket, pair, context, word, n), by EM.

    ``cells`` is a table: the tokens of the deleted part counted by what the model knows of them. Every
    iteration is one aggregation to at most BUCKETS rows. A bucket without tokens keeps the start.
    """
    two = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    one = F.col("word") / F.lit(float(max(total, 1)))
    floor = (F.col("word") + ALPHA) / F.lit(total + ALPHA * (distinct + 1))
    cells = stage(cells.select("bucket", "n", two.alias("p2"), one.alias("p1"), floor.alias("p0")), "cells")
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    for _ in range(iterations):
        at = lambda j: F.element_at(F.array(*[F.lit(float(w)) for w in weights[:, j]]), F.col("bucket") + 1)
        shares = [at(0) * F.col("p2"), at(1) * F.col("p1"), at(2) * F.col("p0")]
        p = shares[0] + shares[1] + shares[2]
        sums = cells.groupBy("bucket").agg(*[F.sum(F.col("n") * s / p).alias(f"s{j}") for j, s in enumerate(shares)]).collect()
        new = weights.copy()
        for r in sums:
            got = np.array([r.s0, r.s1, r.s2]) + 1e-3
            new[r.bucket] = got / got.sum()
        moved = np.abs(new - weights).max()
        weights = new
        if moved < 1e-3:
            break
    return weights


def _rows(batch):
    """The rows of a batch one at a time: each holds a block and its answers."""
    for n in range(batch.num_rows):
        yield batch.slice(n, 1).to_pylist()[0]


def _cells(totals):
    """The tokens of a block of the deleted part, counted by (bucket, pair, context, word) without that part."""

    def of_batches(batches):
        for batch in batches:
            for row in _rows(batch):
                words, word_at, grams, gram_at, doc, first = _entries(row["ids"], row["lengths"], row["data"])
                wt, wg, gt, gg = _answers_of(row["answers"])
                w, g = wt - wg, gt - gg
                context = _contexts(w, word_at, first, totals["kept_ends"])
                cell = np.stack([bucket(context), g[gram_at], context, w[word_at]], axis=1)
                cell, n = np.unique(cell, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (cell[:, 0].astype(np.int32), *cell[:, 1:].T, n)], names=["bucket", "pair", "context", "word", "n"]
                )

    return of_batches


def _contexts(counts, word_at, first, ends):
    """Count of the token before each token; before a document's first stands the end token."""
    context = np.empty(len(word_at), np.int64)
    context[1:] = counts[word_at[:-1]]
    context[first] = ends
    return context


def _scores(totals, weights):
    total, distinct = totals["total"], totals["distinct"]

    def of_batches(batches):
        for batch in batches:
            for row in _rows(batch):
                words, word_at, grams, gram_at, doc, first = _entries(row["ids"], row["lengths"], row["data"])
                w, _, g, _ = _answers_of(row["answers"])
                c, n = w[word_at], len(row["ids"])
                context = _contexts(w, word_at, first, totals["ends"])
                two, one, floor = estimates(g[gram_at], context, c, total, distinct)
                mixed = weights[bucket(context)]
                p = mixed[:, 0] * two + mixed[:, 1] * one + mixed[:, 2] * floor
                sums = [np.bincount(doc, weights=x, minlength=n) for x in (np.log10(p), np.log10(floor), c > 0)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()),
                        pa.array([held_out(i) for i in row["ids"]]),
                        pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                        pa.array(sums[2].astype(np.int64)),
                        pa.array(np.full(n, total, np.int64)),
                        pa.array(sums[1]),
                        pa.array(sums[0]),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return of_batches


SCORE_SCHEMA = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def score(docs, id_col="doc_id", text_col="text"):
    """One row per document with its base score and its score under the model."""
    picked = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    packed = "block bigint, deleted boolean, ids array<bigint>, lengths binary, data binary"
    blocks = stage(picked.mapInArrow(_pack, packed), "blocks")
    facts = blocks.agg(
        F.sum(F.length("data")).alias("bytes"), F.count("*").alias("blocks"), F.count_if("deleted").alias("deleted")
    ).first()
    if not facts.blocks:
        return docs.sparkSession.createDataFrame([], SCORE_SCHEMA)
    # Compressed text has about one distinct bigram per four bytes in a block.
    shards = 1 << max(0, (facts.bytes // 4 // SHARD_ENTRIES).bit_length() + 2)
    # As many tasks as the shards need, however large the corpus.
    adders = max(shuffle_partitions(docs.sparkSession), 2 * shards // SHARDS_A_TASK)
    asked = blocks.mapInArrow(_ask(shards), ASK_SCHEMA).repartition(adders, "kind", "shard")
    answers = stage(asked.groupBy("kind", "shard").applyInArrow(_add_up, ANSWER_SCHEMA), "answers")
    totals = _totals(answers, docs, id_col)
    told = answers.filter(F.length("gone") > 0)
    deleted = _with_answers(blocks.filter("deleted"), told, facts.deleted, "kind", "shard", "train", "gone")
    weights = learn_weights(
        deleted.mapInArrow(_cells(totals), "bucket int, pair bigint, context bigint, word bigint, n bigint")
        .groupBy("bucket", "pair", "context", "word").agg(F.sum("n").alias("n")),
        totals["total"] - totals["gone"],
        totals["distinct"],
    )
    every = _with_answers(blocks, answers, facts.blocks, "kind", "shard", "train")
    return every.mapInArrow(_scores(totals, weights), SCORE_SCHEMA)


def _with_answers(blocks, answers, number, *fields):
    """``blocks``, ``number`` of them, each with the list of its answers."""
    # As many tasks as hold BLOCKS_A_TASK blocks each, however large the corpus: one partitioning serves both sides.
    tasks = max(shuffle_partitions(blocks.sparkSession), -(-number // BLOCKS_A_TASK))
    listed = answers.repartition(tasks, "block").groupBy("block").agg(F.collect_list(F.struct(*fields)).alias("answers"))
    return blocks.repartition(tasks, "block").join(listed.hint("merge"), "block")


def _totals(answers, docs, id_col):
    """Training tokens, distinct ones, those of the deleted part, and the documents that end each."""
    words = answers.filter("kind = 1").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"), F.sum("gone_total").alias("gone")).first()
    rest = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary")), F.lit(10))
    ends = docs.agg(F.count_if(rest != 0).alias("ends"), F.count_if(rest > 1).alias("kept")).first()
    return {"total": words.total, "distinct": words.distinct, "gone": words.gone, "ends": ends.ends, "kept_ends": ends.kept}
