import os

import pytest

import corpus_pipeline
from riverframe.llm import langid, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "12345", "en", "s", 5), (10**6 + 1, None, "en", "s", 0), (None, None, None, None, None)], docs.schema)
    docs = docs.unionAll(extra)
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] <= sizes[0] - 3 and sizes[3] < sizes[2]
    plan = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in plan.collect()} == {r["doc_id"] for r in docs.collect()}


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert 0 < found.count() < 200 and "slot" in found.columns


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES if k.startswith("op")}
    assert set(queries.QUERIES) <= set(entry.queries()) and langid.UNKNOWN == "und"
