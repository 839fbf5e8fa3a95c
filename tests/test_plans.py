"""Physical-plan properties the scale design relies on."""

import pytest

from support import SF_SMALL

from tessera.plans.registry import QUERIES, load_all

load_all()

# queries that write files or train models while being defined are planned elsewhere
SIDE_EFFECTS = {
    "stream_rate", "stream_quota", "stream_dedupe", "stream_resume", "train_head", "regression_suite", "hybrid_predict",
    "train_metadata", "catalog_scan", "catalog_table", "archive_entries", "jsonl_roundtrip", "failure_log", "balance",
    "ingest_generated", "index_build", "catalog_audit", "top_up",
}
PYTHON_NODES = ("MapInPandas", "MapInArrow", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")
VECTOR_QUERIES = {"topk_vectors", "top1_threshold", "tfidf_vectors"}


def _plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SIDE_EFFECTS))
def test_no_cartesian_and_python_only_in_vectors(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in VECTOR_QUERIES:
        assert not any(p in plan for p in PYTHON_NODES), name


@pytest.mark.parametrize("name", ["cap_per_label", "balance_downsample", "build_training_set", "augment"])
def test_capped_samples_are_cut_off_where_they_are_read(spark, name):
    """Ranks of whole labels are never taken: a window runs over an edge bucket (behind a filter on it) or over one bucket of a
    finished sample, and no row is shuffled by its text."""
    import re

    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    ranks = re.findall(r"Window \[row_number\(\) windowspecdefinition\(([^,]+), ([^,]+),", plan)
    assert ranks and "_edge" in plan
    for label, then in ranks:
        assert "label" in label and ("_h" in then or "_bucket" in then)
    physical = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for keys in re.findall(r"hashpartitioning\((.*?), \d+\)", physical):
        assert not re.search(r"\b(text|item)#", keys), keys



def test_flagship_scan_is_pruned(spark):
    df = QUERIES["clean_dedupe_documents"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan
    assert "source" not in plan.split("ReadSchema")[1].split("\n")[0]
