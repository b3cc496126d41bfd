"""From raw documents to packed training sequences.

Every stage takes what its predecessor kept, calls one corpus operator and returns documents; the last
returns the pieces of the packed sequences. Between two stages the documents are written as Parquet
to the shared folder and read again.
"""

from footfall.llm import mixing, packing, quality, simhash, suffixes
from footfall.llm.common import new_folder
from footfall.llm.queries import tokenizer


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or are more likely bad than good go."""
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """Of documents whose fingerprints of three-word shingles link within two bits, the smallest id stays."""
    return simhash.keep_one_each(docs)


def repeated_passages(spark, docs, sf_dir):
    """Bytes covered by a 200-byte string that also starts under a smaller doc_id go; the documents stay."""
    return suffixes.remove_repeats(docs, keep_first=True)


def target_weights(spark, docs, sf_dir):
    """Documents are repeated by their Poisson draws, so that sources reach their target weights."""
    return mixing.poisson_mix(docs).select(*docs.columns)


def packing_into_sequences(spark, docs, sf_dir):
    """Every copy is cut into pieces and the pieces are packed."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", target_weights),
    ("best-fit packing", packing_into_sequences),
]

#: Learning, graph iterations and tokenizing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = new_folder(spark, f"pipeline-{number}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
