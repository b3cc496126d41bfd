"""Divergence of the word use of sources within a language.

Documents are counted with Arrow's own kernels inside ``mapInArrow``: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by``. A task merges the counts of its
batches and hands on (lang, source, term, occurrences, documents) rows, so a language, source or term
that most documents share is a few rows per task. These partial counts are merged by one exchange on
(lang, term), which serves the sums per source and the number of documents per language alike.
Terms kept are dealt in columnar shards of bounded size; every shard fills blocks of a matrix source x
term with exact shares and adds up the differences of all pairs of sources and its own best terms
per source. The sums and the best of the shards' best are the result.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z lower-cased. A language keeps the
terms found in at least ``min_docs`` of its documents. The share of a term is
1 + floor(10^9 (n + 5) / (N + 5 V)) in exact integers, where N sums the counts n of the V kept terms of the
group, or of the language.

Null texts, languages and sources are ''. Every row is a document, so repeated rows count again. A group
without terms has N = 0 and takes part in all pairs; in a language that keeps no term all pairs have the
value 0. Ties go to the smaller item by its UTF-8 bytes. An empty table gives no rows. A text is
split whole; very long ones are counted one at a time.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.llm.common import shuffle_partitions, stage

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, PRIOR, UNIT, BEST = 30, 5, 10**9, 50
#: Bytes of text split at once, rows of partial counts a task merges before it hands them on, rows of a
#: shard on average, and numbers in one block of its matrix.
SLICE_BYTES, PARTIAL_ROWS, SHARD_ROWS, BLOCK = 8 << 20, 400_000, 100_000, 1 << 20


# -- counting


def _slices(batch):
    """Runs of rows of ``batch`` with about ``SLICE_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def term_counts(batch):
    """Table (lang, source, term, n, docs) of a batch (lang, source, text).

    Every (lang, source) also has one row with a null term.
    """
    lang, source, text = (pc.fill_null(batch.column(c), "") for c in ("lang", "source", "text"))
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    width = max(1, len(sources.dictionary))
    group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()

    words = pc.split_pattern_regex(pc.ascii_lower(text), NO_TERM)
    doc, word = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(word, "")
    doc, terms = doc.filter(real), word.filter(real).dictionary_encode()
    said = pa.table({"doc": doc, "term": terms.indices})
    said = said.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    per_doc = pa.table({
        "group": group[said.column("doc").to_numpy()],
        "term": said.column("term"),
        "n": said.column("count_all"),
    })
    merged = per_doc.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])

    places = np.unique(group)
    which = pa.chunked_array([merged.column("group").combine_chunks(), pa.array(places)]).to_numpy()
    none = pa.nulls(len(places), terms.dictionary.type)
    zero = pa.array(np.zeros(len(places), np.int64))
    return pa.table({
        "lang": langs.dictionary.take(pa.array(which // width)),
        "source": sources.dictionary.take(pa.array(which % width)),
        "term": pa.chunked_array([terms.dictionary.take(merged.column("term").combine_chunks()), none]),
        "n": pa.chunked_array([merged.column("n_sum").combine_chunks(), zero]),
        "docs": pa.chunked_array([merged.column("count_all").combine_chunks(), zero]),
    })


def _merged(tables):
    keys = ["lang", "source", "term"]
    out = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def _partial_counts(batches):
    held, rows, fresh = [], 0, 0
    for batch in batches:
        for part in _slices(batch):
            held.append(term_counts(part))
            fresh += held[-1].num_rows
            if fresh < PARTIAL_ROWS:
                continue
            held, fresh = [_merged(held)], 0
            rows = held[0].num_rows
            if rows >= PARTIAL_ROWS:
                yield from held[0].combine_chunks().to_batches()
                held = []
    if held:
        yield from _merged(held).combine_chunks().to_batches()


COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def _kept_counts(docs, min_docs):
    """(lang, source, term, n, first): counts of the kept terms, and a row with a null term for every group.

    ``first`` marks one row of every term of a language.
    """
    partial = docs.mapInArrow(_partial_counts, COUNTS)
    # Partitioned by language and term, the sums per source and the documents per language need no other exchange.
    dealt = partial.repartition(shuffle_partitions(docs.sparkSession), "lang", "term")
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = Window.partitionBy("lang", "term")
    seen = counts.withColumn("in_lang", F.sum("docs").over(of_lang)).withColumn(
        "first", F.row_number().over(of_lang.orderBy("source")) == 1
    )
    kept = seen.filter(F.col("term").isNull() | (F.col("in_lang") >= min_docs))
    return kept.select("lang", "source", "term", "n", "first")


# -- comparing


def shares(n, total):
    """floor(10^9 (n + 5) / total) + 1, exactly, for totals up to 9.2e15; ``total`` is N + 5 V of n's group."""
    rest, out = n + PRIOR, np.zeros_like(n)
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _sorted_best(found):
    """The ``BEST`` rows of every source in the table (source, item, value)."""
    order = pc.sort_indices(found, sort_keys=[("source", "ascending"), ("value", "descending"), ("item", "ascending")])
    found = found.take(order)
    source = found.column("source").to_numpy()
    first = np.searchsorted(source, source, side="left")
    return found.filter(pa.array(np.arange(len(source)) - first < BEST))


def _compare(counts, groups):
    """Sums of differences of all pairs of sources, and the best terms of each, over one shard of a language."""
    groups = groups.sort_by("source")
    names = groups.column("source").combine_chunks()
    n_groups, lang = len(names), groups.column("lang")[0]
    vocabulary, lang_total = groups.column("v")[0].as_py(), groups.column("lang_n")[0].as_py()
    total = groups.column("n").to_numpy() + PRIOR * vocabulary
    lead = groups.column("shard")[0].as_py() == 0
    pairs, best = np.zeros((n_groups, n_groups), np.int64), []
    if counts.num_rows:
        terms = counts.column("term").combine_chunks().dictionary_encode()
        row = pc.index_in(counts.column("source").combine_chunks(), value_set=names).to_numpy(zero_copy_only=False)
        column, n = terms.indices.to_numpy(), counts.column("n").to_numpy()
        order = np.argsort(column, kind="stable")
        row, column, n = row[order], column[order], n[order]
        width = max(1, BLOCK // n_groups)
        for begin in range(0, len(terms.dictionary), width):
            end = min(begin + width, len(terms.dictionary))
            a, b = np.searchsorted(column, [begin, end])
            block = np.zeros((n_groups, end - begin), np.int64)
            block[row[a:b], column[a:b] - begin] = n[a:b]
            p = shares(block, total[:, None])
            q = shares(block.sum(axis=0), lang_total + PRIOR * vocabulary)
            for i in range(n_groups - 1):
                apart = np.abs(p[i + 1 :] - p[i]).sum(axis=1)
                pairs[i, i + 1 :] += apart
                pairs[i + 1 :, i] += apart
            at = np.nonzero((block > 0) & (p > q))
            best.append(pa.table({
                "source": at[0],
                "item": terms.dictionary.take(pa.array(at[1] + begin)),
                "value": (p - q)[at],
            }))
    a, b = np.nonzero(~np.eye(n_groups, dtype=bool)) if lead or counts.num_rows else (np.empty(0, np.int64),) * 2
    found = pa.table({"source": a, "item": names.take(pa.array(b)), "value": pairs[a, b]})
    parts = [("pair", found)] + ([("term", _sorted_best(pa.concat_tables(best)))] if best else [])
    return pa.concat_tables([
        pa.table({
            "lang": pa.array([lang.as_py()] * t.num_rows, pa.string()),
            "source": names.take(t.column("source").combine_chunks()).cast(pa.string()),
            "part": pa.array([part] * t.num_rows, pa.string()),
            "item": t.column("item").combine_chunks().cast(pa.string()),
            "value": t.column("value"),
        })
        for part, t in parts
    ])


def source_divergence(docs, min_docs=MIN_DOCS, text_col="text", lang_col="lang", source_col="source"):
    """(lang, source, part, item, value, rank): how far the sources of every language are apart, and on what terms."""
    spark = docs.sparkSession
    names = {"lang": lang_col, "source": source_col, "text": text_col}
    chosen = docs.select(*[F.col(c).cast("string").alias(name) for name, c in names.items()])
    kept = stage(_kept_counts(chosen, min_docs), "term_counts")
    shards = max(1, min(kept.count() // SHARD_ROWS + 1, 100_000))
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("v"))
    of_lang = Window.partitionBy("lang")  # one row per source, after sums
    groups = groups.select(
        "lang", "source", "n", F.sum("n").over(of_lang).alias("lang_n"), F.sum("v").over(of_lang).alias("v")
    )
    # Every shard of a language meets all its groups, also those it holds no term of.
    groups = stage(groups, "groups").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    terms = kept.filter(F.col("term").isNotNull()).withColumn(
        "shard", F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int")
    )
    found = terms.groupBy("lang", "shard").cogroup(groups.groupBy("lang", "shard")).applyInArrow(
        _compare, "lang string, source string, part string, item string, value bigint"
    )
    key = ["lang", "source", "part"]
    # A term stands in one shard only, so the sum merges pairs and leaves terms as they are.
    summed = found.groupBy(*key, "item").agg(F.sum("value").alias("value"))
    ranked = summed.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("value"), "item")))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= BEST)).select(*key, "item", "value", "rank")
