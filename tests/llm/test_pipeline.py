"""The registered queries and the pipeline over the small tables."""

import os
import sys

import pytest
from compare import connect, difference

import __spark_entry__ as driver
import corpus_pipeline
from khodat.llm.common import stored, table
from khodat.llm.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_what_its_sql_gives(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES if k != "pipeline"}
    assert set(QUERIES) <= set(driver.queries()) and driver.queries()["pipeline"] is corpus_pipeline.run


def test_stages_keep_the_columns_and_whole_documents(spark):
    docs = table(spark, SF, "documents")
    columns, texts = docs.columns, {r.text for r in docs.select("text").collect()}
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        counts.append(docs.count())
        assert {r.text for r in docs.select("text").collect()} <= texts
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == counts[4] == corpus_pipeline.run(spark, SF).count()
    assert all(4 * r.n_tokens == len(r.ids) for r in last.collect())


def test_stages_take_odd_documents(spark, odd, documents):
    for docs in (odd, documents([])):
        for _, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, SF)
            assert got.count() <= 3 * docs.count()
    assert sys.modules["corpus_pipeline"].ORACLE_SQL is None
