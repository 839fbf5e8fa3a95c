"""Sinks of generation and review on small hand-made inputs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans.artefacts import audit_rows, review_tree
from tessera.plans.jobs import parsed_effects, parsed_templates
from tessera.session import scratch_path
from tessera.sources import artefacts as AR
from tessera.sources import files as FS

META = {"id": "a-v1", "level": "site", "category": "site", "subcategory": "x", "placeholders": {"scalar": ["name"], "repeating": {}}}


def _response(**change):
    return json.dumps({"meta": META, "html": "<h1>{{name}}</h1>", "css": "h1{}", **change})


def _ingest(spark, rows, root, run):
    df = spark.createDataFrame(rows, "spec_id string, category string, attempt int, raw string")
    out = AR.ingest(spark, parsed_templates, df, root, run, "category", AR.TEMPLATE_FILES, 4, lambda e: F.concat(F.lit("gave up: "), e))
    return {r.spec_id: (r.status, r.attempt_used, r.error) for r in out.collect()}


def test_ingest_commits_once_and_resumes(spark, tmp_path):
    root = str(tmp_path / "generated")
    rows = [
        ("a", "site", 1, "{broken"), ("a", "site", 2, _response(html="<p>{{name}} é</p>")), ("a", "site", 3, _response()), ("a", "site", 2, _response(html="<p>{{name}} é</p>")),
        ("b", "site", 1, "[]"), ("b", "site", 2, None), ("b", "site", 5, _response()),
        ("c", "law", 1, _response(css=None)), ("c", "law", 2, json.dumps({"meta": META, "html": "x"})),
        (None, "law", 1, _response()),
    ]
    got = _ingest(spark, rows, root, "one")
    top = "Missing required top-level keys (meta/html/css)"
    assert got == {"a": ("saved", 2, None), "b": ("failed", None, "gave up: Invalid JSON"), "c": ("failed", None, "gave up: " + top)}
    assert open(f"{root}/site/a/index.html", encoding="utf-8").read() == "<p>{{name}} é</p>"
    assert open(f"{root}/site/a/meta.json").read() == json.dumps(META, indent=2)
    assert sorted(os.listdir(f"{root}/site/a")) == ["index.html", "meta.json", "style.css"]
    before = os.stat(f"{root}/site/a/meta.json").st_mtime_ns
    assert set(_ingest(spark, rows, root, "two")) == {"b", "c"}  # what is saved is left out
    assert os.stat(f"{root}/site/a/meta.json").st_mtime_ns == before
    # a repeated run of one name replaces its own log rows
    _ingest(spark, rows, root, "two")
    failures = AR.read_runs(spark, f"{root}/_failures", "id string, error string, timestamp timestamp")
    assert sorted((r.run, r.id) for r in failures.collect()) == [("one", "b"), ("one", "c"), ("two", "b"), ("two", "c")]
    # a spec committed by an attempt whose progress was lost is not written again
    lost = spark.createDataFrame([("a", "site", "{}", "other", "other")], "spec_id string, category string, meta string, html string, css string")
    assert [r.written for r in AR.commit_tree(lost, root, "category").collect()] == [False]
    assert _ingest(spark, [], str(tmp_path / "none"), "one") == {}


def test_effect_responses(spark):
    meta = {"id": "e", "type": "effect", "trigger": "hover", "name": "n", "category": "c", "css_class": "fx-e", "requires_js": False, "requires_shared_js": None}
    css = ".fx-e:hover{} @media (prefers-reduced-motion: reduce) {}"
    rows = [
        (0, json.dumps({"meta": meta, "css": css})), (1, json.dumps({"meta": meta})), (2, json.dumps({"css": css})), (3, "nope"), (4, None),
        (5, "```json\n" + json.dumps({"meta": {**meta, "css_class": None}, "css": css}) + "\n```"), (6, json.dumps({"meta": meta, "css": None})),
        (7, json.dumps({"meta": {**meta, "trigger": "onload"}, "css": css})),
    ]
    df = spark.createDataFrame([(i, "hover", r) for i, r in rows], "i int, trigger string, raw string")
    top = "Missing required top-level keys (meta/css)"
    assert [r.err for r in parsed_effects(df).orderBy("i").collect()] == [
        None, top, top, "Invalid JSON", "Invalid JSON", "css_class must start with 'fx-', got: None", "css_class 'fx-e' declared in meta but not found in css",
        "trigger mismatch: expected 'hover', got 'onload'",
    ]


def test_set_member_keeps_the_rest(spark):
    texts = ['{"b": 1.50, "reviewed": "true", "a": {"z": [1, null], "é": "ü"}}', '{"x": 1}', "[1]", "{bad", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, m string")
    got = [r.n for r in df.select("i", AR.set_member("m", "reviewed", True).alias("n")).orderBy("i").collect()]
    assert got[2:] == [None] * 4
    assert list(json.loads(got[0]).items()) == [("b", 1.5), ("reviewed", True), ("a", {"z": [1, None], "é": "ü"})]
    assert got[1] == json.dumps({"x": 1, "reviewed": True}, indent=2)


def test_review_of_a_tree(spark, tmp_path):
    root = str(tmp_path / "tree")
    good = ("<h1>{{name}}</h1>", "h1{}")
    rows = [
        ("site", "ok", json.dumps({**META, "id": "ok", "extra": {"k": 1}}), *good), ("site", "done", json.dumps({**META, "reviewed": True}), *good),
        ("site", "text", json.dumps({**META, "reviewed": "true"}), *good), ("law", "nocss", json.dumps(META), "x", None),
        ("law", "bad", json.dumps(META), "<h1>{{other}}</h1>", "h1{}"),
    ]
    df = spark.createDataFrame(rows, "category string, spec_id string, meta string, html string, css string")
    FS.write_catalogue_tree(df, root).write.parquet(f"{tmp_path}/written")
    statuses = lambda v: {r.path: r.status for r in v.collect()}
    first = statuses(review_tree(spark, root, scratch_path(spark, "review")))
    assert first == {"site/ok": "marked_reviewed", "site/done": "already_reviewed", "site/text": "marked_reviewed", "law/nocss": "missing_files", "law/bad": "failed_validation"}
    assert open(f"{root}/site/ok/meta.json").read() == json.dumps({**META, "id": "ok", "extra": {"k": 1}, "reviewed": True}, indent=2)
    assert open(f"{root}/law/bad/meta.json").read() == json.dumps(META)  # left as it was
    work = scratch_path(spark, "review")
    second = statuses(review_tree(spark, root, work))
    assert second == {p: "already_reviewed" if s == "marked_reviewed" else s for p, s in first.items()}
    assert [(r.list, r.id) for r in spark.read.json(f"{work}/failures").orderBy("list").collect()] == [("failed_validation", "a-v1"), ("missing_files", "a-v1")]


def test_audit_lists(spark, tmp_path):
    expected = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    found = spark.createDataFrame([("b", True), ("b", True), ("c", False), (None, True), ("d", None)], "id string, issue boolean")
    want = [("extra_ids", "c"), ("extra_ids", "d"), ("missing_file_issues", "b"), ("missing_file_issues", "b"), ("missing_ids", "a")]
    FS.write_lists(audit_rows(expected, found), f"{tmp_path}/report", ["list", "id"])
    parts = sorted(p for p in os.listdir(f"{tmp_path}/report") if p.startswith("part-"))
    lines = [json.loads(line) for p in parts for line in open(f"{tmp_path}/report/{p}")]
    assert [(x["list"], x["id"]) for x in lines] == want  # sorted over the parts
    assert audit_rows(expected.limit(0), found.limit(0)).count() == 0


@pytest.mark.parametrize("unit", [1_000_000, 20_000_000, 60_000_000])
def test_trailing_count_of_a_hot_key(spark, unit):
    import random

    from tessera.operators import quota as Q

    rng = random.Random(7)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 4 else "cold", None if i % 97 == 0 else rng.choice([0, 1, 59_999_999, 60_000_000]) + rng.randrange(200) * 1_000_000) for i in range(1, 900)]
    df = spark.createDataFrame(rows, "_us_id int, k string, us long").select("_us_id", "k", F.timestamp_micros("us").alias("ts"), F.lit(1).alias("_unit"))
    out = Q.trailing_count(df, "k", "ts", unit_us=unit)
    assert out.columns == ["_us_id", "k", "ts", "_unit", "n_window"]
    got = {r._us_id: r.n_window for r in out.collect()}
    same = lambda a, b: (a is None) == (b is None) and (a is None or 0 <= a - b < 60_000_000)
    assert got == {i: sum(1 for _, k2, t2 in rows if k2 == k and same(t, t2)) for i, k, t in rows}
    with pytest.raises(ValueError):
        Q.trailing_count(df, "k", "ts", unit_us=7)


def test_trailing_count_spreads_a_key(spark):
    """One key with all rows: its groups are seconds, so that rows of more than one second never meet in a group."""
    import re

    from tessera.operators import quota as Q

    df = spark.range(2000).select(F.lit("u").alias("k"), F.timestamp_micros(F.col("id") * 100_000).alias("ts"))
    plan = Q.trailing_count(df, "k", "ts")._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert keys and all("_unit" in k or "_slab" in k for k in keys)


def test_effect_specs_are_dealt_over_tasks(spark, monkeypatch):
    """A small table is one partition of its file; its responses are built and checked in several tasks."""
    from tessera.plans import artefacts as PA

    monkeypatch.setattr(PA, "SPECS_A_TASK", 50)
    dealt = PA.effect_responses(spark, "/root/testdata/sf0.001")
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 800
