"""Pipeline semantics on tiny hand-written inputs (expected values by reading
the reference's rules, independent of the oracle SQL)."""

import json

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.dedupe import append_if_absent, first_wins, ordered_union
from tessera.plans.dataset import build_training_set, downsample_label, stratified_split_df
from tessera.plans.jobs import response_error
from tessera.plans.responses import parse_string_batch
from tessera.operators.evaluate import classification_report


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_build_training_set_new_wins_and_cleans(spark):
    new = spark.createDataFrame([("  'hello   world\" ", "code", 1), ("ok then", "direct", 2)], "text string, label string, seq long")
    old = spark.createDataFrame([("Hello world", "terminal", 1), ("zz", "code", 2), ("12345", "code", 3)], "text string, label string, seq long")
    out = build_training_set(new, old)
    # the new row wins the shared key; too-short and letter-less rows are dropped; cleaning capitalises
    assert _rows(out, "text", "label") == [("Hello world", "code"), ("Ok then", "direct")]


def test_augment_order_existing_wins_raw_key(spark):
    old = spark.createDataFrame([(" Same ", "terminal", 1)], "text string, label string, seq long")
    new = spark.createDataFrame([("same", "code", 1), ("'same'", "code", 2)], "text string, label string, seq long")
    u = ordered_union(old, new)
    out = first_wins(u, T.dedup_key("text"), ["src_rank", "seq"])
    # raw key (no cleaning): the quoted variant is a different key
    assert _rows(out, "text", "label") == [(" Same ", "terminal"), ("'same'", "code")]


def test_append_if_absent_collapses_repeats(spark):
    collected = spark.createDataFrame([("a", "x", 1)], "text string, label string, seq long")
    existing = spark.createDataFrame([("a", "x", 5), ("b", "x", 6), ("b", "x", 7), ("a", "y", 8)], "text string, label string, seq long")
    add = append_if_absent(collected, existing, ["text", "label"], ["seq"])
    assert _rows(add, "text", "label", "seq") == [("a", "y", 8), ("b", "x", 6)]


def test_batch_parse_rules(spark):
    raws = [
        '```json\n["  one ", 2, {"a": 1}, "", "two"]\n```',
        '["three"] trailing',
        '{"not": "a list"}',
        "not json",
        '  ["four"]  ',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "batch_id long, raw string")
    got = _rows(parse_string_batch(df), "batch_id", "item")
    assert got == [(0, "one"), (0, "two"), (4, "four")]


def test_generated_response_errors(spark):
    meta = {"id": "t", "level": "l", "category": "c", "subcategory": "s", "placeholders": {"scalar": ["a"], "repeating": {}}}
    good = json.dumps({"meta": meta, "html": "{{a}}", "css": ""})
    cases = [
        ("```json\n" + good + "\n```", None),
        (good[:-1], "Invalid JSON"),
        (json.dumps({"meta": meta, "html": "{{a}}"}), "Missing required top-level keys (meta/html/css)"),
        (json.dumps({"meta": meta, "html": "{{b}}", "css": ""}), "Placeholders used but not declared in meta: {'b'}"),
    ]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(cases)], "i int, raw string")
    got = [r[0] for r in df.orderBy("i").select(response_error("raw")).collect()]
    assert got == [e for _, e in cases]


def test_downsample_and_split_quotas(spark):
    rows = [(i, "big" if i < 70 else ("mid" if i < 95 else "small")) for i in range(100)]
    df = spark.createDataFrame(rows, "seq long, label string")
    d = {r.label: r.n for r in downsample_label(df, "big", 20, 42).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert d == {"big": 20, "mid": 25, "small": 5}
    s = stratified_split_df(df, 15, 42)
    q = {r.label: r.n for r in s.where("split = 'val'").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # n_val = 15; floors 10/3/0 (remainders 50/75/75 of 100) -> the two largest remainders get one more
    assert q == {"big": 10, "mid": 4, "small": 1}


def test_classification_report_zero_division(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "expected string, got string")
    rep = {r["class"]: r for r in classification_report(pairs).collect()}
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0 and rep["c"].f1 == 0.0 and rep["c"].support == 1
    assert rep["b"].precision == round(1 / 3, 6) and rep["b"].recall == 1.0
    assert rep["accuracy"].f1 == 0.5 and rep["accuracy"].precision is None
    assert rep["macro avg"].recall == round((0.5 + 1 + 0) / 3, 6)
