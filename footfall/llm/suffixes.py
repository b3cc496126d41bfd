"""Suffix-array deduplication: bytes covered by a 200-byte string that starts anywhere else.

The suffixes compared are those that start a run of windows bundled by a shared minimizer; sampled
splitters range-partition them by their leading bytes, every bucket is sorted by multikey quicksort,
and the groups at bucket borders are compared across buckets (see ``repeats``).

Nulls are empty texts. Repeated rows repeat each other: from 200 bytes on they are removed whole.
Texts under 200 bytes are never touched. An empty table gives no rows.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm.repeats import Units, merged, repeated_spans, with_spans

BYTES = Units(words=False, window=200, kmer=32)


def cut_bytes(data, spans, window=BYTES.window):
    """(remaining bytes, number removed, number of maximal removed ranges)."""
    if not spans:
        return data, 0, 0
    first = np.array([s["first"] for s in spans])
    last = np.array([s["last"] for s in spans])
    start, end = merged(first, last, window)
    edges = np.concatenate([[0], np.stack([start, end], 1).ravel(), [len(data)]]).tolist()
    rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return rest, len(data) - len(rest), len(start)


def removal_report(docs, id_col="doc_id", text_col="text"):
    """One row per document: bytes before, bytes and ranges removed, SHA-256 of what is left."""
    spans = repeated_spans(docs, BYTES, False, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]

    def of_batches(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                rest, removed, ranges = cut_bytes(data, spans.as_py())
                out.append((len(data), removed, ranges, hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out)) or [[]] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    listed = with_spans(docs.select(id_col, text_col), spans, id_col, text_col)
    return listed.mapInArrow(
        of_batches, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def remove_repeats(docs, id_col="doc_id", text_col="text", chars_col="n_chars", keep_first=False):
    """``docs`` without the repeated bytes; a character cut in the middle goes as a whole.

    With ``keep_first`` a passage stays where it stands under the smallest doc_id: only bytes covered by a
    200-byte string that also starts under a smaller one go. A null doc_id counts as larger than any other;
    repeats within one document, and those that only rows of one id share, then stay.

    ``chars_col``, where the table has it, is counted anew. Texts without a repeat stay as they are.
    """
    spans = repeated_spans(docs, BYTES, keep_first, id_col, text_col)
    names = docs.columns
    at = names.index(text_col)

    def of_batches(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(at), batch.column(len(names))):
                text, spans = text.as_py(), spans.as_py()
                if spans:
                    rest = cut_bytes(text.encode("utf-8", "surrogatepass"), spans)[0]
                    text = rest.decode("utf-8", "ignore")
                out.append(text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    listed = with_spans(docs, spans, id_col, text_col)
    out = listed.mapInArrow(of_batches, docs.schema)
    if chars_col in names:
        kind = dict(docs.dtypes)[chars_col]
        out = out.withColumn(chars_col, F.length(text_col).cast(kind))
    return out
