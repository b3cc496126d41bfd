"""The corpus operators as named queries ``(spark, folder) -> DataFrame`` over whole tables."""

import os

from pyspark.sql import functions as F

from footfall.llm import (
    ann, clustering, divergence, extraction, lm, mixing, packing, quality, sharding, simhash, substring, suffixes, warc,
)
from footfall.llm.sql import DIVERGENCE, clustering_sql

#: Folder of the public tokenizers' files; a parameter of the packing operator.
TOKENIZERS = os.environ.get("FOOTFALL_TOKENIZERS", "/opt/tokenizers")


def tokenizer():
    return f"{TOKENIZERS}/byte_bpe_50k.json"


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark, folder):
    return quality.judge(_table(spark, folder, "documents"))


def op2_warc(spark, folder):
    records = warc.archived(_table(spark, folder, "pages")).filter("record_type IS NOT NULL")
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op3_best_fit_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents"), tokenizer())


def op4_substring_dedup(spark, folder):
    return substring.removal_report(_table(spark, folder, "documents"))


def op5_poisson_mixing(spark, folder):
    return mixing.poisson_mix(_table(spark, folder, "documents"))


def op6_simhash(spark, folder):
    return simhash.simhash_components(_table(spark, folder, "documents"))


def op7_suffix_array_dedup(spark, folder):
    return suffixes.removal_report(_table(spark, folder, "documents"))


def op8_multi_index_hashing(spark, folder):
    return ann.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_deleted_interpolation(spark, folder):
    return lm.score(_table(spark, folder, "documents"))


def op10_prefix_sum_shards(spark, folder):
    return sharding.balanced_shards(_table(spark, folder, "documents"), shards=16)


def op11_source_divergence(spark, folder):
    return divergence.source_divergence(_table(spark, folder, "documents"))


def op12_html_extraction(spark, folder):
    return extraction.main_text(_table(spark, folder, "pages"))


def op13_centroid_clustering(spark, folder):
    return clustering.cluster_vectors(_table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_warc,
        op3_best_fit_packing,
        op4_substring_dedup,
        op5_poisson_mixing,
        op6_simhash,
        op7_suffix_array_dedup,
        op8_multi_index_hashing,
        op9_deleted_interpolation,
        op10_prefix_sum_shards,
        op11_source_divergence,
        op12_html_extraction,
        op13_centroid_clustering,
    )
}

#: The draw of every document, its rate from exact byte sizes, and its copies.
_MIXING_SQL = """
WITH RECURSIVE sized AS (SELECT *, coalesce(strlen(text), 0) AS size FROM documents),
sources AS (
    SELECT source, sum(size)::DOUBLE AS size, pow(sum(size)::DOUBLE, 0.7) AS weight FROM sized GROUP BY source),
rates AS (
    SELECT source,
           weight / sum(weight) OVER () * sum(size) OVER () / size AS rate
    FROM sources),
drawn AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.rate,
           ('0x' || substr(md5('1|' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
steps AS (
    SELECT source, rate, 0 AS k, -rate AS logp, exp(-rate) AS cdf FROM rates
    UNION ALL
    SELECT source, rate, k + 1, logp + ln(rate) - ln(k + 1.0), cdf + exp(logp + ln(rate) - ln(k + 1.0))
    FROM steps WHERE k < ceil(rate + 12 * sqrt(rate) + 40))
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, (s.k)::INTEGER AS copy
FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source AND s.cdf <= d.u
"""

#: The other operators hash, learn, tokenize or iterate in ways SQL has no words for.
ORACLE = {
    "op5_poisson_mixing": _MIXING_SQL,
    "op11_source_divergence": DIVERGENCE,
    "op13_centroid_clustering": clustering_sql(),
}
