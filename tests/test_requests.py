"""Request handling and default data on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import render as R
from tessera.operators.textindex import TextIndex
from tessera.plans.requests import default_sites, handle

META = {"id": "bakery-v1", "placeholders": {"scalar": ["business_name", "accent_color", "motto"], "repeating": {"items": {"fields": ["item_name", "size"]}}}}
HTML = "<h1>{{business_name}}</h1>{{motto}}<!-- REPEAT:items --><li>{{item_name}} {{size}}</li><!-- END:items -->"


@pytest.fixture()
def templates(spark):
    rows = [
        ("site/bakery", json.dumps(META), HTML, "a{color:{{accent_color}}}"), ("site/law", json.dumps({"id": "law-v1", "placeholders": {}}), "law", None),
        ("site/bare", "{}", "bare {{x}}", "b"), ("site/none", None, None, None),
    ]
    return spark.createDataFrame(rows, "path string, meta string, html string, css string")


def test_default_sites(spark, templates):
    got = {r.path: (r.error, r.site_html, r.site_css) for r in default_sites(templates).collect()}
    assert got["site/bakery"] == (None, "<h1>Riverside Bakery</h1>Please fill: motto<li>Sourdough Loaf Please fill: size</li>", "a{color:#d2a679}")
    assert got["site/law"] == ("Missing index.html or style.css", None, None) == got["site/none"]
    assert got["site/bare"] == (None, "bare {{x}}", "b")


def test_every_branch(spark, templates, tmp_path):
    records = spark.createDataFrame(
        [("bakery-v1", "site/bakery", "bread bakery shop"), ("law-v1", "site/law", "law office advice"), ("other-v1", "site/bare", "yoga studio")], "id string, path string, body string"
    )
    index = TextIndex.build(records, str(tmp_path / "index"), "id", "body")
    rows = [
        ("w1", "website", "a bakery shop for bread", None, None), ("w2", "website", "the law office", None, None), ("w3", "website", "nothing known", None, None),
        ("w4", "website", None, None, None), ("w5", "website", "yoga", None, None), ("t1", "terminal", "x", '"rm -rf /"', None), ("t2", "terminal", "x", "ls", None),
        ("c1", "code", "x", None, "Here:\n```python\nprint(1)\n```\nand ```\nb\n```"), ("d1", "direct", "x", None, "  hello "), ("n1", None, "x", None, None),
    ]
    req = spark.createDataFrame(rows, "request_id string, category string, text string, command string, answer string").withColumn("extra", F.lit(1))
    got = {r.request_id: r for r in handle(req, index, templates).collect()}
    assert len(got) == len(rows)
    assert [got[f"w{i}"].status for i in range(1, 6)] == ["success", "error", "no_match", "no_match", "success"]
    assert got["w1"].template_used == "bakery-v1" and got["w1"].site_html.startswith("<h1>Riverside") and 0.4 <= got["w1"].match_score <= 1
    assert got["w2"].error == "Missing index.html or style.css" and got["w5"].site_html == "bare {{x}}"
    assert (got["t1"].status, got["t1"].proposed_command, got["t1"].confirm_level) == ("awaiting_confirmation", "rm -rf /", "strict")
    assert got["t1"].danger_reason and got["t2"].danger_reason is None
    assert [(b.language, b.code) for b in got["c1"].code_blocks] == [("python", "print(1)"), ("text", "b")] and got["c1"].explanation == "Here:\n\nand"
    assert got["d1"].response == "hello" and got["d1"].status == "success" and got["n1"].status == "success" and got["w1"].extra == 1
    assert handle(req.limit(0), index, templates).count() == 0


def test_a_shared_template_is_rendered_once(spark, templates, tmp_path):
    """The rendering stands below the join with the requests."""
    records = spark.createDataFrame([("bakery-v1", "site/bakery", "bread bakery"), ("b", "site/bare", "law")], "id string, path string, body string")
    index = TextIndex.build(records, str(tmp_path / "index"), "id", "body")
    req = spark.range(50).selectExpr("CAST(id AS STRING) AS request_id", "'website' AS category", "'bakery' AS text", "'' AS command", "'' AS answer")
    out = handle(req, index, templates)
    assert {(r.template_used, r.status) for r in out.collect()} == {("bakery-v1", "success")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("aggregate(map_keys(repeating") and "LeftSemi" in plan


def test_default_data_v1(spark):
    df = spark.createDataFrame([(["business_type", "twitter_handle", "primary_color", "accent_colour"],)], "s array<string>")
    m = df.select(R.default_scalars_v1("s").alias("m")).first().m
    assert m == {"business_type": "bakery", "twitter_handle": "@riversidebakery", "primary_color": "#8b5a2b", "accent_colour": "{{ accent_colour }}"}
    rows = [("menu_items", ["item_name", "price", "x"]), ("products", ["product_description"]), ("team_members", ["name", "role", "age"]), ("other", ["name"]), ("other", [])]
    df = spark.createDataFrame(rows, "b string, f array<string>")
    got = [r.i for r in df.select(R.default_items_v1("b", "f").alias("i")).collect()]
    assert got == [
        [{"item_name": "Sourdough Loaf", "price": "$7", "x": "{{ x }}"}, {"item_name": "Cinnamon Roll", "price": "$4", "x": "{{ x }}"}],
        [{"product_description": "Naturally leavened, 24hr ferment"}, {"product_description": "Fresh baked, glazed"}],
        [{"name": "Sarah Miller", "role": "Head Baker", "age": "{{ age }}"}, {"name": "James Chen", "role": "Pastry Chef", "age": "{{ age }}"}],
        [{"name": "{{ name }}"}], [{}],
    ]
