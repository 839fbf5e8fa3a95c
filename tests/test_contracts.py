"""Golden artefacts (our own texts) and one mutation per contract rule."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions import render as R

META = {
    "id": "t-v1", "level": "whole-site", "category": "site", "subcategory": "s",
    "placeholders": {"scalar": ["name", "color"],
                     "repeating": {"items": {"container_marker": "items", "fields": ["title", "price"]}}},
}
HTML = "<h1>{{name}}</h1><ul><!-- REPEAT:items --><li>{{title}} {{price}}</li><!-- END:items --></ul>"
CSS = "h1{color:{{color}}}"


def _err(spark, meta, html, css):
    df = spark.createDataFrame([(json.dumps(meta), html, css)], "meta string, html string, css string")
    return df.select(K.template_error("meta", "html", "css")).first()[0]


def test_template_valid(spark):
    assert _err(spark, META, HTML, CSS) is None
    # the other END spelling, unused block fields and undeclared blocks are fine
    assert _err(spark, META, HTML.replace("<!-- END:items -->", "<!--END:items-->").replace(" {{price}}", "") + "<!-- REPEAT:x -->", CSS) is None


@pytest.mark.parametrize(
    "mutate,expected",
    [
        (lambda m, h, c: ({k: v for k, v in m.items() if k != "level"}, h, c), "meta.json missing required field: level"),
        (lambda m, h, c: (m, h + "{{zeta}}{{alpha}}", c), "Placeholders used but not declared in meta: {'alpha', 'zeta'}"),
        (lambda m, h, c: ({**m, "placeholders": {**m["placeholders"], "scalar": ["name", "color", "extra"]}}, h, c),
         "Scalar placeholders declared but never used: {'extra'}"),
        (lambda m, h, c: (m, h.replace("<!-- REPEAT:items -->", ""), c), "Declared repeating block 'items' not found in html"),
        (lambda m, h, c: (m, h.replace("<!-- END:items -->", "<!--  END:items -->"), c), "Repeating block 'items' missing matching END marker"),
    ],
)
def test_template_rules(spark, mutate, expected):
    assert _err(spark, *mutate(META, HTML, CSS)) == expected


def _effect(trigger, **over):
    meta = {"id": "e-v1", "type": "effect", "trigger": trigger, "name": "E", "category": "c", "css_class": "fx-glow",
            "requires_js": trigger == "onscroll", "requires_shared_js": "scroll-reveal-observer-v1" if trigger == "onscroll" else None}
    meta.update(over)
    css = ".fx-glow{} @media (prefers-reduced-motion: reduce){}"
    css += {"onload": " @keyframes k{}", "hover": " .fx-glow:hover{}", "onscroll": " .fx-scroll-target.fx-in-view{}"}[trigger]
    return meta, css


def _eff_err(spark, meta, css, trigger):
    df = spark.createDataFrame([(json.dumps(meta), css, trigger)], "meta string, css string, t string")
    return df.select(K.effect_error("meta", "css", "t")).first()[0]


@pytest.mark.parametrize("trigger", ["onload", "hover", "onscroll"])
def test_effect_valid(spark, trigger):
    assert _eff_err(spark, *_effect(trigger), trigger) is None


def test_effect_rules(spark):
    m, c = _effect("hover")
    assert _eff_err(spark, {k: v for k, v in m.items() if k != "requires_shared_js"}, c, "hover") == \
        "meta.json missing required field: requires_shared_js"
    assert _eff_err(spark, {**m, "trigger": "onload"}, c, "hover") == "trigger mismatch: expected 'hover', got 'onload'"
    assert _eff_err(spark, {**m, "css_class": "glow"}, c, "hover") == "css_class must start with 'fx-', got: glow"
    assert _eff_err(spark, m, c.replace("prefers-reduced-motion", "x"), "hover") == \
        "Missing required @media (prefers-reduced-motion: reduce) block"
    # strict booleans: the string "false" is not False
    assert _eff_err(spark, {**m, "requires_js": "false"}, c, "hover") == "hover effect must have requires_js: false"
    assert _eff_err(spark, {**m, "requires_shared_js": "x"}, c, "hover") == "hover effect must have requires_shared_js: null"
    assert _eff_err(spark, m, c.replace(":hover", ""), "hover") == "hover effect css must include a :hover selector"
    m2, c2 = _effect("onscroll")
    assert _eff_err(spark, {**m2, "requires_js": 1}, c2, "onscroll") == "onscroll effect must have requires_js: true"
    assert _eff_err(spark, m2, c2.replace(".fx-scroll-target", ""), "onscroll") == \
        "onscroll effect css must reference fx-scroll-target class"
    m3, c3 = _effect("onload")
    assert _eff_err(spark, m3, c3.replace("@keyframes", ""), "onload") == "onload effect should use a @keyframes animation"


def test_strict_reviewed(spark):
    vals = ['{"reviewed": true}', '{"reviewed": "true"}', '{"reviewed": 1}', '{"reviewed": null}', "{}", '{"reviewed": false}']
    df = spark.createDataFrame([(v,) for v in vals], "meta string")
    assert [r[0] for r in df.select(K.strictly_reviewed("meta")).collect()] == [True, False, False, False, False, False]


def test_hex_colour(spark):
    df = spark.createDataFrame([(v,) for v in ["#abc", "#abcd", "#abcdef", "#ABCDEF", "abc", "#ab"]], "c string")
    assert [r[0] for r in df.select(K.hex_color("c")).collect()] == [True, False, True, True, False, False]


def _bd_df(spark):
    return spark.createDataFrame(
        [(["name", "tag", "color"], ["items"], {"name": "A $1 \\1", "tag": "{{color}}!", "color": "#fff"},
          {"items": [{"title": "T1", "price": "$2"}, {"title": "T2"}]})],
        "scalar array<string>, blocks_decl array<string>, sc map<string,string>, bl map<string,array<map<string,string>>>",
    )


def test_business_problems(spark):
    df = spark.createDataFrame(
        [(["name", "main_color", "x"], ["items", "gallery"], {"name": "n", "main_color": "red"}, {"items": []})],
        "s array<string>, b array<string>, sc map<string,string>, bl map<string,array<map<string,string>>>",
    )
    got = df.select(R.business_data_problems("s", "b", "sc", "bl")).first()[0]
    assert got == "Bad color: main_color; Missing: x; Missing/empty repeating block: items; Missing/empty repeating block: gallery"


def test_patch_chain_and_expand(spark):
    df = _bd_df(spark)
    html = "<h1>{{name}}</h1><p>{{tag}}</p><!-- REPEAT:items --><li>{{title}} {{price}}</li><!--END:items--> tail"
    out = df.select(R.patch_scalars(F.lit(html), "scalar", "sc").alias("h")).first()[0]
    # values are literal ($1, \1 survive) and a later field inserted by an earlier one is replaced too
    assert out.startswith("<h1>A $1 \\1</h1><p>#fff!</p>")
    ex = df.select(R.expand_block(F.lit(html), F.lit("items"), F.col("bl")["items"], F.array(F.lit("title"), F.lit("price")))).first()[0]
    assert ex == "<h1>{{name}}</h1><p>{{tag}}</p><li>T1 $2</li><li>T2 {{price}}</li> tail"
    none = df.select(R.expand_block(F.lit("no block"), F.lit("items"), F.col("bl")["items"], F.array(F.lit("title")))).first()[0]
    assert none == "no block"


def test_default_business_data(spark):
    df = spark.createDataFrame([(["business_name", "accent_color", "brand_color", "foo"], ["item_name", "x"])], "s array<string>, f array<string>")
    row = df.select(R.map_text(R.default_scalars("s")), R.map_text(R.default_item("f"))).first()
    assert row[0] == "accent_color=#d2a679;brand_color=#8b5a2b;business_name=Riverside Bakery;foo=Please fill: foo"
    assert row[1] == "item_name=Sourdough Loaf;x=Please fill: x"


@pytest.mark.parametrize("meta,css,want", [
    ("{broken", "x", "MSG_BAD_META"), ("[1]", "x", "MSG_BAD_META"), ("null class", "ok", "css_class must start with 'fx-', got: None"), ("ok", None, "declared in meta but not found in css"),
])
def test_effect_rules_meet_nulls(spark, meta, css, want):
    """A null class or css, or a meta that is no object, is an error and never passes."""
    import json

    good = {f: "x" for f in K.EFFECT_REQUIRED} | {"trigger": "hover", "css_class": "fx-a", "requires_js": False, "requires_shared_js": None}
    meta = {"null class": json.dumps(good | {"css_class": None}), "ok": json.dumps(good)}.get(meta, meta)
    css = f".fx-a:hover {{ }} {K.CSS_REDUCED_MOTION}" if css == "ok" else css
    df = spark.createDataFrame([(meta, css, "hover")], "meta string, css string, t string")
    got = df.select(K.effect_error("meta", "css", "t")).first()[0]
    assert got is not None and getattr(K, want, want) in got
