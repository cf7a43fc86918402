"""Registered corpus queries against their SQL, and the pipeline's stages against their promises."""

import pytest
from oracle import compare, connect

import corpus_pipeline
from simsearch.llm import decontaminate, registered, secrets, simhash
from simsearch.llm.common import table
from simsearch.session import ship_package

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.ORACLE))
def test_query_equals_its_sql(spark, name):
    ship_package(spark)
    assert compare(spark, connect(FOLDER), FOLDER, registered.QUERIES[name], registered.ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.ORACLE)))
def test_query_returns_every_document(spark, name):
    ship_package(spark)
    got = registered.QUERIES[name](spark, FOLDER)
    key, source = ("vec_id", "embeddings") if "vec_id" in got.columns else ("doc_id", "documents")
    assert got.select(key).distinct().count() == table(spark, FOLDER, source).count()


@pytest.mark.parametrize("name", ["op7_kd_sharding", "op9_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = registered.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline_stages_take_effect(spark, tmp_path):
    ship_package(spark)
    docs = table(spark, FOLDER, "documents")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert sorted(after.columns) == sorted(docs.columns) and after.join(docs, "doc_id", "left_anti").count() == 0
        docs = after
    assert simhash.near_duplicates(docs).where("doc_id <> component_id").count() == 0
    assert decontaminate.contamination(docs, table(spark, FOLDER, "benchmark"), "doc_id").where("n_hit > 0").count() == 0
    assert secrets.scan(docs).where("n_assign + n_access + n_hex > 0").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == pieces.count()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_pipeline_stages_bear_odd_rows(spark, stage):
    ship_package(spark)
    rows = [(1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "x " * 5000, "en", "s", 10000), (2, "x " * 5000, "en", "s", 10000), (3, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert stage(spark, docs, FOLDER).count() >= 0
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
