"""Registered queries: with SQL against it, the others for a row per input row."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from scanledger.llm import queries
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op8_best_fit_packing"}))
def test_a_row_for_each_row(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    source, key = ("pages", "page_id") if "page_id" in df.columns else ("documents", "doc_id")
    want = spark.read.parquet(f"{SF_DIR}/{source}.parquet").select(key)
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in want.collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        if name != "best_fit_packing":
            assert docs.columns == columns
            docs = docs.cache()
            seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    assert docs.select("doc_id").distinct().count() == seen[-1]


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
