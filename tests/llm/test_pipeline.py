"""Registered queries against their SQL, and the pipeline on given and on odd tables."""

import os

import pytest

import corpus_pipeline
import tests.compare as compare
from strataflow.llm import queries
from strataflow.llm.decontaminate import find_leaks
from strataflow.llm.simhash import near_duplicates
from strataflow.session import shared_folder


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_and_sql(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr(compare, "UNWANTED", ("CartesianProduct",))
    con = compare.connect(sf_dir)
    assert compare.difference(spark, sf_dir, name, queries.QUERIES[name], queries.ORACLES[name], con) is None


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


NATIVE = ["op2_mixing", "op4_url_filter", "op5_secrets"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if name != "sharding":
            assert docs.columns == before.columns
        if name == "simhash_near_dedup":
            groups = near_duplicates(before).collect()
            assert ids == {r["component_id"] for r in groups} and docs.count() == len(ids)
        if name == "benchmark_decontamination":
            benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            assert find_leaks(docs, benchmark).count() == 0
            leaked = {r["doc_id"] for r in find_leaks(before, benchmark).collect()}
            assert ids == {r[0] for r in before.select("doc_id").collect()} - leaked
        if name == "source_mixing":
            assert ids == {r[0] for r in before.select("doc_id").collect()}
    shared = shared_folder(spark).removeprefix("file:")
    folders = set(os.listdir(shared))
    whole = corpus_pipeline.run(spark, sf_dir)
    # Of what the run wrote only its result stays.
    assert {f.rsplit("-", 1)[0] for f in set(os.listdir(shared)) - folders} == {"pipeline-sharding"}
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_on_odd_tables(spark, odd, labels, tmp_path):
    for rows, folder in ((odd, "odd"), (odd.limit(0), "empty")):
        sf = str(tmp_path / folder)
        rows.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        benchmark = spark.createDataFrame([(1, "same id and another text"), (None, None)], "item_id long, text string")
        benchmark.write.parquet(f"{sf}/benchmark.parquet")
        got = corpus_pipeline.run(spark, sf)
        assert set(odd.columns) <= set(got.columns) and {"shard", "slot"} <= set(got.columns)
        assert (got.count() > 0) == (folder == "odd")


def test_mixing_stage_is_in_schedule_order(spark):
    docs = spark.range(960).selectExpr("id AS doc_id", "concat('s', id % 3) AS source")
    sources = [r["source"] for r in corpus_pipeline.mixing(spark, docs, "").collect()]
    blocks = [sources[at : at + 16] for at in range(0, len(sources), 16)]
    assert all(len(set(block)) == 1 for block in blocks)
    assert all(len({block[0] for block in blocks[at : at + 3]}) == 3 for at in range(0, len(blocks), 3))
