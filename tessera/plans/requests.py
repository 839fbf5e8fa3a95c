"""Request handling with the website branch (G10, D11) and the earlier default data.

Fixture: requests are the user turns of ``conversations``, classified, then followed by the B4 text of the page of the
same number where there is one; commands and answers as in ``plans.routing``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions import render as R
from tessera.functions import routing as RT
from tessera.functions import text as T
from tessera.operators.textindex import TextIndex, sql_query_vectors
from tessera.plans import fixtures as X
from tessera.plans import sql as S
from tessera.plans.catalog import embed_text_col, sql_embed_text
from tessera.plans.registry import register
from tessera.plans.render import _BLOCK_FIELDS, _sql_expand, _sql_patch, site_columns
from tessera.plans.responses import _ANSWER
from tessera.plans.routing import (
    _CMDS_SQL,
    _MODEL_SQL,
    COMMANDS,
    FIXTURE_KEYWORDS,
    _sql_danger,
    _sql_kw,
    _sql_paired,
    classify,
    commands_dim,
    fixture_model_label,
)
from tessera.plans.vectors import _INDEX_SQL, _REVIEWED_SQL, THRESHOLD, index_records
from tessera.session import scratch_path
from tessera.sources.tables import table

_NO_FIELDS = "array<string>"


def _declared(templates: DataFrame) -> DataFrame:
    """Templates with their distinct scalar fields and repeating blocks."""
    ph = K.placeholders_struct("meta")
    return templates.select(
        "*",
        F.array_distinct(F.coalesce(ph["scalar"], F.array().cast(_NO_FIELDS))).alias("scalar"),
        F.coalesce(ph["repeating"], F.create_map().cast(K.REPEATING_SCHEMA)).alias("repeating"),
    )


def default_sites(templates: DataFrame) -> DataFrame:
    """Every template (path, meta, html, css) as a site of default data (B20 -> B18/B19): (path, error, site_html, site_css);
    a template with a missing file has an error instead of a site."""
    t = _declared(templates).withColumn("scalars", R.default_scalars("scalar")).withColumn("blocks", R.default_blocks("repeating"))
    html, css = site_columns()
    error = F.when(K.files_missing("html", "css"), F.lit(K.MSG_MISSING_FILES))
    return t.select("path", error.alias("error"), F.when(error.isNull(), html).alias("site_html"), F.when(error.isNull(), css).alias("site_css"))


def handle(requests: DataFrame, index: TextIndex, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """G10 for classified requests (request_id, text, category, command, answer).

    website: the best template of the saved index with at least ``threshold`` (E5, E6), rendered with default data; without one
    ``no_match``, with a file missing ``error``. terminal: the drafted command, tagged (B27, B29, B30), waits for a confirmation. code:
    fenced blocks and the explanation (B21). direct: the stripped answer. Any other or null category is answered like
    direct. A site depends on its template alone, so each matched template is rendered once, however many
    requests ask for it. A null or empty text matches nothing; requests that repeat a ``request_id`` must be equal."""
    website = requests.where("category = 'website'")
    found = index.search(website, "request_id", "text", 1, threshold).drop("rank")
    paths = index.records.where("id IS NOT NULL").groupBy("id").agg(F.min("path").alias("path"))
    matched = found.join(paths, "id")
    sites = default_sites(templates.join(matched.select("path").distinct(), "path", "left_semi"))
    j = requests.join(matched.join(sites, "path").drop("path"), "request_id", "left")
    cat, drafted = F.col("category"), RT.draft_command("command")
    reason = RT.danger_reason(drafted)
    is_web, is_term, is_code = (F.coalesce(cat == c, F.lit(False)) for c in ("website", "terminal", "code"))
    status = (
        F.when(is_web & F.col("id").isNull(), "no_match").when(is_web & F.col("error").isNotNull(), "error").when(is_term, "awaiting_confirmation").otherwise("success")
    )
    blocks = T.code_blocks("answer")
    return j.select(
        *requests.columns,
        status.alias("status"),
        "error",
        F.col("id").alias("template_used"),
        F.col("score").alias("match_score"),
        "site_html",
        "site_css",
        F.when(is_term, drafted).alias("proposed_command"),
        F.when(is_term, RT.confirm_level(reason)).alias("confirm_level"),
        F.when(is_term, reason).alias("danger_reason"),
        F.when(is_code, blocks).alias("code_blocks"),
        F.when(is_code, T.code_explanation("answer")).alias("explanation"),
        F.when(~(is_web | is_term | is_code), T.py_strip("answer")).alias("response"),
    )


_REQUEST_ID = "CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING)"


def fixture_requests(spark, sf) -> DataFrame:
    conv = table(spark, sf, "conversations").where(F.col("role") == "user").selectExpr("*", _ANSWER[-1], f"{_REQUEST_ID} AS request_id")
    about = X.templates(spark, sf).select(F.col("page_id").alias("conv_id"), embed_text_col().alias("_about"))
    asked = classify(conv, fixture_model_label()).join(about, "conv_id", "left").withColumn("text", F.concat_ws(" ", "text", "_about"))
    commands = commands_dim(spark).withColumnRenamed("cmd", "command")
    r = asked.withColumn("idx", F.col("conv_id") % len(COMMANDS)).join(commands, "idx", "left")
    return r.select("request_id", "text", "category", "source", "command", "answer")


def _handled(spark, sf) -> DataFrame:
    path = scratch_path(spark, "request-index")
    TextIndex.build(index_records(spark, sf), path, "id", "embed_text")
    return handle(fixture_requests(spark, sf), TextIndex.load(spark, path), X.templates(spark, sf).select("path", "meta", "html", "css"))


def _sql_known(known: dict[str, str], f: str, unknown: str) -> str:
    names = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in known.items()) + "}" if known else None
    return f"coalesce({names}[{f}], {unknown})" if names else unknown


_SCALARS_SQL = "map(scalar, list_transform(scalar, lambda f: " + _sql_known(
    R.DEFAULT_FIELDS, "f", f"CASE WHEN contains(lower(f), '{R.COLOR_FIELD_MARK}') THEN '{R.DEFAULT_COLOR}' ELSE 'Please fill: ' || f END"
) + "))"
_ITEM_SQL = f"[map(list_distinct({_BLOCK_FIELDS}), list_transform(list_distinct({_BLOCK_FIELDS}), lambda f: " + _sql_known(R.DEFAULT_ITEM_FIELDS, "f", "'Please fill: ' || f") + "))]"
_DECLARED_SQL = f"""(SELECT page_id, path, meta, html, css, list_sort(list_distinct(coalesce(CAST(json_extract(meta, '$.placeholders.scalar') AS VARCHAR[]), []))) AS scalar,
  coalesce(json_keys(meta, '$.placeholders.repeating'), []) AS rep_keys FROM {X.TEMPLATES_SQL})"""
_SITES_SQL = f"""(SELECT path, html IS NULL OR css IS NULL AS broken, {_sql_patch("css")} AS site_css,
  list_reduce(rep_keys, lambda hacc, b: {_sql_expand('hacc', 'b', _ITEM_SQL, _BLOCK_FIELDS)}, {_sql_patch('html')}) AS site_html
 FROM (SELECT *, {_SCALARS_SQL} AS scalars FROM {_DECLARED_SQL}))"""
_P = T.CODE_BLOCK

_HANDLED_SQL = f"""(WITH asked AS (SELECT {_REQUEST_ID} AS request_id, conv_id, text AS said, concat_ws(' ', text, {sql_embed_text('t.meta')}) AS text, {_ANSWER[-1]}
   FROM conversations c LEFT JOIN {X.TEMPLATES_SQL} t ON t.page_id = c.conv_id WHERE role = 'user'),
 req AS (SELECT a.*, cmd, CASE WHEN {_sql_kw('said', FIXTURE_KEYWORDS)} THEN 'website' ELSE {_MODEL_SQL.replace('text', 'said')} END AS category,
     CASE WHEN {_sql_kw('said', FIXTURE_KEYWORDS)} THEN 'hard_rule' ELSE 'model' END AS source
   FROM asked a LEFT JOIN {_CMDS_SQL} k ON a.conv_id % {len(COMMANDS)} = k.idx),
 web AS (SELECT request_id, text FROM req WHERE category = 'website'),
 q AS {sql_query_vectors(_REVIEWED_SQL, 'id', 'embed_text', 'web', 'request_id', 'text')},
 v AS {_INDEX_SQL},
 s AS (SELECT q.id AS request_id, v.id, round(sum(q.w * v.w), 6) AS score FROM q JOIN v USING (term) GROUP BY q.id, v.id),
 best AS (SELECT request_id, id, score, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, id) AS rank FROM s WHERE score >= {THRESHOLD}),
 rec AS (SELECT id, min(path) AS path FROM {_REVIEWED_SQL} WHERE id IS NOT NULL GROUP BY id),
 m AS (SELECT best.request_id, best.id, best.score, sites.* FROM best JOIN rec USING (id) JOIN {_SITES_SQL} sites USING (path) WHERE rank = 1)
SELECT req.request_id, category, source,
  CASE WHEN category = 'website' THEN CASE WHEN m.id IS NULL THEN 'no_match' WHEN broken THEN 'error' ELSE 'success' END
       WHEN category = 'terminal' THEN 'awaiting_confirmation' ELSE 'success' END AS status,
  CASE WHEN broken THEN '{K.MSG_MISSING_FILES}' END AS error, m.id AS template_used, m.score AS match_score,
  CASE WHEN NOT broken THEN md5(site_html) END AS html_md5, CASE WHEN NOT broken THEN md5(site_css) END AS css_md5,
  CASE WHEN category = 'terminal' THEN {_sql_paired('cmd')} END AS proposed_command,
  CASE WHEN category = 'terminal' THEN CASE WHEN {_sql_danger(_sql_paired('cmd'))} IS NOT NULL THEN 'strict' ELSE 'confirm' END END AS confirm_level,
  CASE WHEN category = 'terminal' THEN {_sql_danger(_sql_paired('cmd'))} END AS danger_reason,
  CASE WHEN category = 'code' THEN array_to_string(list_transform(regexp_extract_all(answer, '{_P}', 1), lambda x: CASE WHEN x = '' THEN 'text' ELSE x END), ',') END AS languages,
  CASE WHEN category = 'code' THEN md5(array_to_string(list_transform(regexp_extract_all(answer, '{_P}', 2), lambda x: {S.strip('x')}), chr(10))) END AS code_md5,
  CASE WHEN category = 'code' THEN {S.strip(f"regexp_replace(answer, '{_P}', '', 'g')")} END AS explanation,
  CASE WHEN category = 'direct' THEN {S.strip('answer')} END AS response
FROM req LEFT JOIN m USING (request_id))"""


@register("handle_requests", f"SELECT * FROM {_HANDLED_SQL}")
def handle_requests(spark, sf):
    """Every request through its branch, the website branch by search in the saved index and a rendered site."""
    h = _handled(spark, sf)
    return h.select(
        "request_id", "category", "source", "status", "error", "template_used", "match_score", F.md5("site_html").alias("html_md5"), F.md5("site_css").alias("css_md5"),
        "proposed_command", "confirm_level", "danger_reason", F.array_join(F.col("code_blocks.language"), ",").alias("languages"),
        F.md5(F.array_join(F.col("code_blocks.code"), "\n")).alias("code_md5"), "explanation", "response",
    )


@register("failed_requests", f"SELECT request_id, category, status, error FROM {_HANDLED_SQL} WHERE status <> 'success'")
def failed_requests(spark, sf):
    """D11's list: one row per request that was no success."""
    return _handled(spark, sf).where("status <> 'success'").select("request_id", "category", "status", "error")


# --------------------------------------------------------------------------- B20, earlier form
def _sql_items_v1() -> str:
    fields = f"list_sort(list_distinct({_BLOCK_FIELDS}))"
    item = lambda known: f"array_to_string(list_transform({fields}, lambda f: f || '=' || " + _sql_known(known, "f", "'{{ ' || f || ' }}'") + "), ';')"
    rules = " ".join(f"WHEN b = '{name}' THEN " + " || '/' || ".join(item(s) for s in samples) for name, samples in R.DEFAULT_ITEMS_V1.items())
    return f"CASE {rules} ELSE {item({})} END"


@register(
    "default_business_data_v1",
    f"""SELECT page_id, array_to_string(list_transform(scalar, lambda f: f || '=' || {_sql_known(R.DEFAULT_FIELDS_V1, 'f', "'{{ ' || f || ' }}'")}), ';') AS scalars,
  array_to_string(list_transform(rep_keys, lambda b: b || ':' || {_sql_items_v1()}), '|') AS blocks
FROM (SELECT page_id, replace(replace(meta, '"items"', '"menu_items"'), '"gallery"', '"team_members"') AS meta,
  list_sort(list_distinct(coalesce(CAST(json_extract(meta, '$.placeholders.scalar') AS VARCHAR[]), []))) AS scalar,
  coalesce(json_keys(replace(replace(meta, '"items"', '"menu_items"'), '"gallery"', '"team_members"'), '$.placeholders.repeating'), []) AS rep_keys FROM {X.TEMPLATES_SQL})""",
)
def default_business_data_v1(spark, sf):
    """B20 in its earlier form; the fixture's blocks are called menu_items and team_members."""
    meta = F.replace(F.replace("meta", F.lit('"items"'), F.lit('"menu_items"')), F.lit('"gallery"'), F.lit('"team_members"'))
    t = _declared(X.templates(spark, sf).select("page_id", meta.alias("meta")))
    fields = lambda b: F.array_distinct(F.coalesce(F.col("repeating")[b]["fields"], F.array().cast(_NO_FIELDS)))
    items = lambda b: F.array_join(F.transform(R.default_items_v1(b, fields(b)), R.map_text), "/")
    blocks = F.transform(F.map_keys("repeating"), lambda b: F.concat(b, F.lit(":"), items(b)))
    return t.select("page_id", R.map_text(R.default_scalars_v1("scalar")).alias("scalars"), F.array_join(blocks, "|").alias("blocks"))
