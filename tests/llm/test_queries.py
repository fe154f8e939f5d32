"""Registered corpus queries: whole tables in, SQL where there is some, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from check_oracle import _bag, open_oracle
from rowmill.llm.queries import ORACLES, QUERIES
from rowmill.session import settle

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark):
    result = entry_module.queries()[name](spark, SF_DIR)
    answer = open_oracle(SF_DIR).execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert _bag(result.columns, [tuple(r) for r in result.collect()]) == _bag(names, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_url_filter", "op6_decontamination", "op10_chat", "op12_hard_negatives"}))
def test_query_has_a_row_per_document(name, spark):
    ids = sorted(r[0] for r in duckdb.sql(f"SELECT doc_id FROM read_parquet('{SF_DIR}/documents.parquet')").fetchall())
    assert sorted(r.doc_id for r in entry_module.queries()[name](spark, SF_DIR).select("doc_id").collect()) == ids


def test_pipeline_stages_chain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF_DIR), f"test-{name}")
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == before
    same = docs.select("doc_id", F.sha2("text", 256).alias("own")).join(last, "doc_id")
    assert same.where("own != decoded_sha256").count() == 0


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "alone"), (2, ""), (3, "some words of a text"), (3, "some words of a text")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, score string")
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF_DIR), f"odd-{name}")
        if name == "near_duplicates":
            assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == [(1, None), (3, "some words of a text"), (None, "alone")]
    assert docs.count() == 3
    for _, stage in corpus_pipeline.STAGES:
        none = settle(stage(spark, spark.createDataFrame([], "doc_id long, text string"), SF_DIR), "none")
        assert none.count() == 0
