"""The registered corpus queries: names, SQL, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import attach, compare
from footfall.llm import quality, simhash

FOLDER = "/root/testdata/sf0.001"


def test_names():
    names = queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(q for q in oracle_sql() if q.startswith("op")))
def test_query_equals_its_sql(spark, name):
    got, want, same = compare(spark, attach(FOLDER), FOLDER, name)
    assert len(got) and len(got) == len(want) and same


def test_stages_keep_the_columns_and_their_decisions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, before = docs.columns, docs
    verdict = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, FOLDER).cache()
    assert good.columns == names and {r.doc_id for r in good.collect()} == verdict
    distinct = stages["simhash near-dedup"](spark, good, FOLDER).cache()
    found = simhash.simhash_components(good).collect()
    assert {r.doc_id for r in distinct.collect()} == {r.component_id for r in found}
    cut = stages["suffix-array dedup"](spark, distinct, FOLDER).cache()
    assert cut.columns == names and cut.count() == distinct.count() <= before.count()
    mixed = stages["mixing to target weights"](spark, cut, FOLDER).cache()
    assert mixed.columns == names
    packed = stages["best-fit packing"](spark, mixed, FOLDER)
    assert packed.filter("piece = 0").count() == mixed.count()
