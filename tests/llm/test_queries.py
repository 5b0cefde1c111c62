"""Registered queries and the pipeline on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from marketlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_matches_sql(spark, name):
    query, sql = QUERIES[name]
    problem, _, _ = compare(spark, connect(FOLDER), FOLDER, name, query, sql)
    assert problem is None


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline(spark):
    docs = entry.queries()["op1_near_dedup"](spark, FOLDER)
    columns, n = spark.read.parquet(f"{FOLDER}/documents.parquet").columns, docs.count()
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, frame, FOLDER)
        assert after.columns == columns
        kept = [r["doc_id"] for r in after.collect()]
        assert 0 < len(kept) <= n and len(kept) == len(set(kept))
        frame, n = spark.createDataFrame(after.collect(), after.schema), len(kept)
    words = sum(len(r["text"].split()) for r in frame.collect())
    mixed = corpus_pipeline.STAGES[3][1](spark, frame, FOLDER)
    assert abs(sum(len(r["text"].split()) for r in mixed.collect()) - 1.5 * words) <= 0.02 * words
    result = corpus_pipeline.run(spark, FOLDER)
    assert result.agg({"length": "sum"}).first()[0] > words
