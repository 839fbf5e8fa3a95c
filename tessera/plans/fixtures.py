"""Reference-shaped inputs derived from the driver tables (FIXTURES.md §3).

Each derivation is a list of SQL expressions valid in both Spark SQL and DuckDB
(no backslashes, ``||`` concat, CASE, ``%``), so the Spark job (``selectExpr``)
and the oracle read byte-identical inputs. The operators under test are then
written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.tables import table

# ---------------------------------------------------------------- templates (M5/M6)
# By page_id % 6: 0 valid, 1 undeclared placeholder, 2 unused scalar,
# 3 declared block missing from html, 4 END marker in a third spelling,
# 5 css file missing. 'id' is absent when page_id % 13 = 5 (path fallback),
# 'subcategory' absent when page_id % 7 = 3, reviewed is JSON true when
# page_id % 5 = 0 and the *string* "true" when page_id % 11 = 1.
_T1 = [
    "page_id",
    "page_id % 6 AS k",
    "'page-' || CAST(page_id AS STRING) || '-v1' AS spec_id",
    "translate(regexp_extract(html, '<title>(.*?)</title>', 1), '\"', '') AS title",
    "CASE WHEN page_id % 4 < 2 THEN '<!-- END:items -->' ELSE '<!--END:items-->' END AS end_ok",
    "html AS page_html",
]
_T2 = [
    "page_id",
    "spec_id",
    "'site/' || spec_id AS path",
    "'{' || CASE WHEN page_id % 13 = 5 THEN '' ELSE '\"id\": \"' || spec_id || '\", ' END"
    " || '\"level\": \"whole-site\", \"category\": \"site\", '"
    " || CASE WHEN page_id % 7 = 3 THEN '' ELSE '\"subcategory\": \"page-' || CAST(page_id % 4 AS STRING) || '\", ' END"
    " || '\"description\": \"' || title || '\", '"
    " || '\"reviewed\": ' || CASE WHEN page_id % 5 = 0 THEN 'true' WHEN page_id % 11 = 1 THEN '\"true\"' ELSE 'false' END || ', '"
    " || '\"placeholders\": {\"scalar\": [\"business_name\", \"tagline\", \"primary_color\"'"
    " || CASE WHEN k = 2 THEN ', \"about_text\"' ELSE '' END || '], '"
    " || '\"repeating\": {\"items\": {\"container_marker\": \"items\", \"fields\": [\"item_name\", \"item_price\"]}'"
    " || CASE WHEN k = 3 THEN ', \"gallery\": {\"container_marker\": \"gallery\", \"fields\": [\"image_url\"]}' ELSE '' END"
    " || '}}}' AS meta",
    "'<header><h1>{{business_name}}</h1><p>{{tagline}}</p></header><ul><!-- REPEAT:items --><li>{{item_name}} {{item_price}}</li>'"
    " || CASE WHEN k = 4 THEN '<!--  END:items -->' ELSE end_ok END || '</ul>'"
    " || CASE WHEN k = 1 THEN '<p>{{phone_number}}</p>' ELSE '' END || page_html AS html",
    "CASE WHEN k = 5 THEN NULL ELSE '.hero{color:{{primary_color}}} h1{margin:0}' END AS css",
]


def templates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").selectExpr(*_T1).selectExpr(*_T2)


TEMPLATES_SQL = f"(SELECT {', '.join(_T2)} FROM (SELECT {', '.join(_T1)} FROM pages))"

# ---------------------------------------------------------------- effects (M4/M7)
# trigger by p_partkey % 3; one rule broken by p_partkey % 7:
# 0 valid, 1 field missing, 2 trigger mismatch, 3 class without fx-,
# 4 no reduced-motion block, 5 requires_js as the string "false"/"true",
# 6 trigger-specific css feature missing.
_E1 = [
    "p_partkey",
    "p_partkey % 7 AS b",
    "CASE p_partkey % 3 WHEN 0 THEN 'onload' WHEN 1 THEN 'hover' ELSE 'onscroll' END AS trigger",
    "lower(translate(p_name, ' ', '-')) AS slug",
    "p_name",
    "p_type",
]
_E2 = [
    "p_partkey",
    "trigger AS expected_trigger",
    "slug || '-v1' AS effect_id",
    "'{\"id\": \"' || slug || '-v1\", \"type\": \"effect\", '"
    " || '\"trigger\": \"' || CASE WHEN b = 2 THEN 'hover-in' ELSE trigger END || '\", '"
    " || '\"name\": \"' || p_name || '\", \"category\": \"' || p_type || '\", '"
    " || '\"css_class\": \"' || CASE WHEN b = 3 THEN 'fxx-' ELSE 'fx-' END || slug || '\", '"
    " || '\"requires_js\": ' || CASE WHEN b = 5 THEN '\"' || CASE WHEN trigger = 'onscroll' THEN 'true' ELSE 'false' END || '\"'"
    "    WHEN trigger = 'onscroll' THEN 'true' ELSE 'false' END"
    " || CASE WHEN b = 1 THEN '' ELSE ', \"requires_shared_js\": ' || CASE WHEN trigger = 'onscroll' THEN '\"scroll-reveal-observer-v1\"' ELSE 'null' END END"
    " || ', \"reviewed\": false}' AS meta",
    "'.' || CASE WHEN b = 3 THEN 'fxx-' ELSE 'fx-' END || slug || ' { transition: all 0.3s; }'"
    " || CASE WHEN b = 4 THEN '' ELSE ' @media (prefers-reduced-motion: reduce) { * { animation: none; } }' END"
    " || CASE WHEN b = 6 THEN '' WHEN trigger = 'onload' THEN ' @keyframes fade { from { opacity: 0; } }'"
    "    WHEN trigger = 'hover' THEN ' .card:hover { opacity: 0.9; }'"
    "    ELSE ' .fx-scroll-target { opacity: 0; } .fx-scroll-target.fx-in-view { opacity: 1; }' END AS css",
]


def effects(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_E1).selectExpr(*_E2)


EFFECTS_SQL = f"(SELECT {', '.join(_E2)} FROM (SELECT {', '.join(_E1)} FROM part))"

# ---------------------------------------------------------------- specs (M2/M3)
# Site specs: category = p_type, variant = p_name + key. Component specs:
# component_type from the brand.
_SITE = [
    "p_partkey AS pos",
    "lower(p_type) AS category",
    "CAST(NULL AS STRING) AS component_type",
    "p_name || ' ' || CAST(p_partkey AS STRING) AS variant",
    "'Use the ' || p_brand || ' palette' AS guidance",
]
_COMP = [
    "p_partkey AS pos",
    "'components' AS category",
    "lower(translate(p_brand, '#', '-')) AS component_type",
    "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_name || ' ' || CAST(p_partkey AS STRING) END AS variant",
    "'Size ' || CAST(p_size AS STRING) AS guidance",
]


def site_specs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_SITE)


def component_specs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*_COMP)


SITE_SQL = f"(SELECT {', '.join(_SITE)} FROM part)"
COMP_SQL = f"(SELECT {', '.join(_COMP)} FROM part)"
