"""The corpus pipeline stage by stage, and the queries against their DuckDB twins."""

import collections
import os
import sys

import pytest

import corpus_pipeline
from heliolake.llm import decision_list, line_dedup, minhash
from heliolake.llm.oracle import LLM_ORACLE
from heliolake.llm.queries import LLM_QUERIES
from heliolake.llm.shared import table, written

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import compare
    found = compare(LLM_QUERIES[name](spark, SF).toPandas(), duck.sql(LLM_ORACLE[name]).df())
    assert found["columns_match"] and found["exact"], found


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, done)
        docs = done
    return out


def test_columns_stay_documents_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_stage_decisions_take_effect(spark, stages):
    before, after = stages["quality_rules"]
    kept = decision_list.judge_quality(before, table(spark, SF, "labels")).filter("kept")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in kept.collect()}

    before, after = stages["line_dedup"]
    want = {r.doc_id: r.text for r in line_dedup.dedup_lines(before).collect()
            if r.n_lines == 0 or r.n_exact + r.n_near < r.n_lines}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = stages["minhash_near_dedup"]
    want = {r.component_id for r in minhash.near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == want

    before, after = stages["mixing"]
    times = collections.Counter(r.doc_id for r in after.collect())
    assert set(times) <= {r.doc_id for r in before.collect()} and max(times.values()) <= 2

    before, after = stages["packing"]
    assert after.selectExpr("count(distinct doc_id)").first()[0] == before.select("doc_id").distinct().count()


def test_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
