"""Sources and sinks on small hand-made inputs."""

import hashlib
import json
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import archive as A
from tessera.sources import files as FS


def test_tree_scan_joins_siblings(spark):
    root = tempfile.mkdtemp(prefix="tree-")
    layout = {
        "site/a-v1": {"meta.json": json.dumps({"id": "a-v1"}), "index.html": "<p>a</p>", "style.css": "p{}"},
        "site/b-v1": {"meta.json": json.dumps({"level": "x"}), "index.html": "<p>b</p>"},  # no id, no css
        "components/deep/c-v1": {"meta.json": "{}", "index.html": "c", "style.css": "c"},
        "stray": {"index.html": "no meta here", "notes.txt": "ignored"},
    }
    for folder, files in layout.items():
        os.makedirs(os.path.join(root, folder), exist_ok=True)
        for name, content in files.items():
            with open(os.path.join(root, folder, name), "w") as f:
                f.write(content)
    rows = {r.path: r for r in FS.scan_catalogue_tree(spark, root).collect()}
    assert set(rows) == {"site/a-v1", "site/b-v1", "components/deep/c-v1"}
    assert rows["site/a-v1"].html == "<p>a</p>" and rows["site/b-v1"].css is None


def test_tree_roundtrip(spark):
    df = spark.createDataFrame(
        [("site", "x-v1", '{"id": "x-v1"}', "<p>x</p>", None), ("site", "y-v1", "{}", "y", "y{}")],
        "category string, spec_id string, meta string, html string, css string",
    )
    root = scratch_path(spark, "tree")
    assert sorted(r.n_files for r in FS.write_catalogue_tree(df, root).collect()) == [2, 3]
    back = {r.path: (r.meta, r.html, r.css) for r in FS.scan_catalogue_tree(spark, root).collect()}
    assert back == {"site/x-v1": ('{"id": "x-v1"}', "<p>x</p>", None), "site/y-v1": ("{}", "y", "y{}")}


def test_archives_are_bounded_and_errors_show(spark, tmp_path):
    rows = [(f"d{i}/", None) if i % 7 == 0 else (f"d/{i}.html", f"text é {i} " * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "entry string, content string").coalesce(1)
    archives = A.write_archives(df, str(tmp_path / "zips"), max_bytes=100).select("archive").collect()
    assert len({r.archive for r in archives}) == len(archives) > 5  # one task, many archives
    archives = spark.createDataFrame(archives, "archive string")
    listed = A.list_entries(archives)
    assert sorted(r.entry for r in listed.collect()) == sorted(e for e, _ in rows)
    want = {e: (len((c or "").encode()), hashlib.md5((c or "").encode()).hexdigest()) for e, c in rows if not e.endswith("/")}
    assert {r.entry: (r.n_bytes, r.content_md5) for r in A.read_entries(listed, strict=True).collect()} == want
    assert A.write_archives(df.repartition(3).limit(0), str(tmp_path / "none")).count() == 0
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    assert A.list_entries(spark.createDataFrame([(str(tmp_path / "empty.zip"),)], "archive string")).count() == 0
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    bad = spark.createDataFrame([(str(tmp_path / "bad.zip"),)], "archive string")
    with pytest.raises(Exception, match="Corrupt zip file"):
        A.list_entries(bad, strict=True).collect()
    entry = bad.selectExpr("archive", "0L AS idx", "'x' AS entry", "false AS is_dir", "0L AS size", "CAST(NULL AS STRING) AS error")
    with pytest.raises(Exception, match="Corrupt zip file"):
        A.read_entries(entry, strict=True).collect()


def test_archive_corrupt_and_directories(spark):
    d = tempfile.mkdtemp(prefix="zips-")
    good = os.path.join(d, "good.zip")
    with zipfile.ZipFile(good, "w") as z:
        z.writestr(zipfile.ZipInfo("folder/"), b"")
        z.writestr("folder/a.txt", b"hello")
        z.writestr("other/a.txt", b"same base name")
    bad = os.path.join(d, "bad.zip")
    with open(bad, "wb") as f:
        f.write(b"not a zip")
    archives = spark.createDataFrame([(good,), (bad,)], "archive string")
    entries = A.list_entries(archives).collect()
    assert sum(1 for e in entries if e.error) == 1 and sum(1 for e in entries if e.is_dir) == 1
    got = A.read_entries(A.list_entries(archives)).collect()
    assert sorted((g.entry, g.n_bytes) for g in got) == [("folder/a.txt", 5), ("other/a.txt", 14)]
    assert {g.base_name for g in got} == {"a.txt"}


def test_missing_jsonl_is_empty(spark):
    assert FS.read_labelled(spark, scratch_path(spark, "absent")).count() == 0


def test_dataset_card_format(spark):
    df = spark.createDataFrame([("a", "x")] * 1200 + [("b", "y")], "text string, label string")
    card = FS.dataset_card(df, "2024-01-01_00-00-00").first().card
    assert card.startswith("# Classifier Training Data\n\n## Overview\n- Total: 1,201\n- Generated: 2024-01-01_00-00-00\n")
    assert "- **x:** 1,200\n- **y:** 1\n" in card and card.endswith("```\n")


def test_explode_nested_specs(spark):
    from tessera.plans.catalog import explode_specs

    nested = spark.createDataFrame(
        [("restaurant", [("Fine Dining!", "g1"), ("Food-truck  menu", "g2")]), ("law", [("Solo practice", "g3")])],
        "category string, variants array<struct<variant: string, guidance: string>>",
    )
    got = sorted((r.category, r.pos, r.spec_id) for r in explode_specs(nested).collect())
    assert got == [("law", 0, "law-solo-practice-v1"), ("restaurant", 0, "restaurant-fine-dining-v1"), ("restaurant", 1, "restaurant-food-truck-menu-v1")]


def test_encoder_plugin(spark):
    from tessera.operators.embed import encoder_udf

    def load():
        import numpy as np

        def encode(texts):
            v = np.array([[len(t), t.count("a"), 1.0] for t in texts], dtype=float)
            return (v / np.linalg.norm(v, axis=1, keepdims=True)).tolist()

        return encode

    df = spark.createDataFrame([("banana",), ("",)], "text string")
    out = df.select(encoder_udf(load, 3)("text").alias("e")).collect()
    assert all(abs(sum(x * x for x in r.e) - 1) < 1e-6 for r in out)


def test_tree_is_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Any depth, hidden names left out, bytes as they are; the plan holds no list of files."""
    monkeypatch.setattr(FS, "FOLDERS_A_TASK", 2)
    made = {"a/x/meta.json": b"{}", "a/x/index.html": b"<p>\xc3\xa9</p>", "a/y/deep/meta.json": b"", "b/meta.json": b"[1]", "b/in/meta.json": b"2", "b/in/style.css": b"c", "c/index.html": b"no meta",
            "_log/z/meta.json": b"{}", "a/.hid/meta.json": b"{}", "a/x/.meta.json.1": b"half"}
    for name, content in made.items():
        (tmp_path / "t" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / name).write_bytes(content)
    tree = FS.scan_catalogue_tree(spark, str(tmp_path / "t"))
    want = {("a/x", "{}", "<p>é</p>", None), ("a/y/deep", "", None, None), ("b", "[1]", None, None), ("b/in", "2", None, "c")}
    assert {tuple(r) for r in tree.collect()} == want
    assert not [f for f in tree.inputFiles() if f.endswith("meta.json")]
    (tmp_path / "empty").mkdir()
    assert FS.scan_catalogue_tree(spark, "file:" + str(tmp_path / "empty"), {"css": "e.css", "meta": "meta.json"}).count() == 0
