"""Substring deduplication on a compacted De Bruijn graph of words.

The edges of the graph are the 50-word windows (token k-mers); consecutive windows of a document
follow each other. Runs of edges that share a minimizer are compacted where they arise, as they
never branch inside a document. A Spark join on the minimizer keeps runs that recur; where all runs
of a minimizer hold the same words the graph does not branch and the run stays one path, elsewhere
runs are taken apart and matched edge by edge (see ``repeats``). Every repeated path carries its
source coordinates, the place of its first occurrence by doc_id. Paths that follow each other both in
a document and in its source are joined to long spans; digests of all their words have verified them.

A word goes if a window that covers it also starts in a document with a smaller doc_id. Null texts
have no words. Copies under one doc_id do not remove each other. A null doc_id counts as larger
than any other. An empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from footfall.llm.common import stage
from footfall.llm.repeats import Units, merged, repeated_spans, with_spans

WORDS = Units(words=True, window=50, kmer=10)


def compacted_paths(docs, id_col="doc_id", text_col="text"):
    """Long repeated spans, (row, doc, first, last, src_doc, src_row, src_first) in windows.

    A path continues another if it starts where the other ends, in the document and in the source.
    Heads, which continue none, are found by a self-join; a running count of heads along each
    diagonal of (document, source) then numbers the compacted paths.
    """
    paths = repeated_spans(docs, WORDS, True, id_col, text_col).distinct()
    paths = stage(paths.withColumn("diagonal", F.col("first") - F.col("src_first")), "paths")
    ends = paths.select("row", "src_row", "diagonal", (F.col("last") + 1).alias("first"), F.lit(1).alias("continues")).distinct()
    linked = paths.join(ends, ["row", "src_row", "diagonal", "first"], "left")
    along = Window.partitionBy("row", "src_row", "diagonal").orderBy("first")
    numbered = linked.withColumn("path", F.sum(F.when(F.col("continues").isNull(), 1).otherwise(0)).over(along))
    return numbered.groupBy("row", "src_row", "diagonal", "path").agg(
        F.min("doc").alias("doc"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min("src_doc").alias("src_doc"),
        F.min("src_first").alias("src_first"),
    ).select("row", "doc", "first", "last", "src_doc", "src_row", "src_first")


def cut_words(words, spans, window=WORDS.window):
    """The words that stay."""
    if not spans:
        return words
    start, end = merged(np.array([s["first"] for s in spans]), np.array([s["last"] for s in spans]), window)
    edges = np.concatenate([[0], np.stack([start, end], 1).ravel(), [len(words)]]).tolist()
    return [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]


def removal_report(docs, id_col="doc_id", text_col="text"):
    """One row per document: words before, words removed, SHA-256 of the words left, joined by spaces."""
    paths = compacted_paths(docs, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]

    def of_batches(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                kept = cut_words(words, spans.as_py())
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string()])]],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    listed = with_spans(docs.select(id_col, text_col), paths, id_col, text_col)
    return listed.mapInArrow(of_batches, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string")
