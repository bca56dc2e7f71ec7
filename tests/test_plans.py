"""What the plans must and must not hold."""

import os

import pytest

from chunkloom.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")

IN_JVM = ["license_gate", "corpus_quality_asserts", "normalize_text", "chunk_id_md5", "chunk_int64", "token_count_bounds", "token_windows", "clean_doc_first_sentence", "assign_query_priority", "repo_bucket_split", "split_leakage_check", "dedupe_keep_first", "duplicate_count", "pending_shards", "resume_remaining", "union_runs", "queries_view", "qrels_view", "corpus_view_gated", "mrl_truncate_normalize"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", IN_JVM)
def test_no_python_and_no_cross_join(spark, name):
    p = plan(QUERIES[name](spark, SMALL))
    assert not any(x in p for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas"))


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["language_scan"](spark, SMALL))
    assert "EqualTo(language,python)" in p and "ReadSchema: struct<chunk_id:string,language:string,license:string>" in p


def test_copies_shrink_before_the_shuffle(spark):
    p = plan(QUERIES["dedupe_keep_first"](spark, SMALL))
    assert p.count("Exchange") == 1 and "partial_min_by" in p


def test_caps_keep_few_rows_a_task(spark):
    assert "WindowGroupLimit" in plan(QUERIES["corpus_cap_per_lang"](spark, SMALL))
