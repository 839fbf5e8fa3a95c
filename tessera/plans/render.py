"""Rendering jobs: business-data checks, defaults, scalar patching, block
expansion and batch site rendering (B16-B20, C8, G11).

Fixture: business data from ``supplier ⋈ nation``; the template matched to a
supplier is the derived template of page ``page_id = s_suppkey`` (C8 lookup join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions import render as R
from tessera.functions.fmt import sql_fmt
from tessera.functions.text import WS
from tessera.plans import fixtures as X
from tessera.plans.registry import register
from tessera.sources.tables import table


def business_data(spark, sf) -> DataFrame:
    """supplier ⋈ nation -> (s_suppkey, scalars, blocks). Colours are valid or
    broken by s_suppkey % 4; tagline is absent for % 5 = 0 and, for % 3 = 1,
    itself holds ``{{primary_color}}`` (exercises sequential patching)."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    j = s.join(n, "s_nationkey")
    k = F.col("s_suppkey")
    color = F.element_at(F.array(F.lit("#8b5a2b"), F.lit("#AbC"), F.lit("#abcd"), F.lit("red")), (k % 4 + 1).cast("int"))
    tagline = (
        F.when(k % 5 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 1, F.concat(F.lit("Colour {{primary_color}} since "), k.cast("string")))
        .otherwise(F.concat(F.lit("Trusted since "), k.cast("string")))
    )
    entries = F.map_from_arrays(
        F.array(F.lit("business_name"), F.lit("address"), F.lit("primary_color"), F.lit("tagline")),
        F.array(F.col("s_name"), F.col("n_name"), color, tagline),
    )
    scalars = F.map_filter(entries, lambda _k, v: v.isNotNull())
    item1 = F.create_map(F.lit("item_name"), F.col("n_name"), F.lit("item_price"), F.concat(F.lit("$"), F.col("s_nationkey").cast("string")))
    item2 = F.create_map(F.lit("item_name"), F.col("s_name"))
    items = (
        F.when(k % 7 == 6, F.array().cast("array<map<string,string>>"))
        .when(k % 3 == 0, F.array(item1, item2))
        .otherwise(F.array(item1))
    )
    return j.select("s_suppkey", scalars.alias("scalars"), F.create_map(F.lit("items"), items).alias("blocks"))


_BD_SQL = """(SELECT s_suppkey,
  map_from_entries(list_filter([
     {'k': 'business_name', 'v': s_name}, {'k': 'address', 'v': n_name},
     {'k': 'primary_color', 'v': ['#8b5a2b', '#AbC', '#abcd', 'red'][s_suppkey % 4 + 1]},
     {'k': 'tagline', 'v': CASE WHEN s_suppkey % 5 = 0 THEN NULL
                                WHEN s_suppkey % 3 = 1 THEN 'Colour {{primary_color}} since ' || CAST(s_suppkey AS VARCHAR)
                                ELSE 'Trusted since ' || CAST(s_suppkey AS VARCHAR) END}], lambda e: e.v IS NOT NULL)) AS scalars,
  MAP {'items': CASE WHEN s_suppkey % 7 = 6 THEN []::MAP(VARCHAR, VARCHAR)[]
       WHEN s_suppkey % 3 = 0 THEN [MAP {'item_name': n_name, 'item_price': '$' || CAST(s_nationkey AS VARCHAR)}, MAP {'item_name': s_name}]
       ELSE [MAP {'item_name': n_name, 'item_price': '$' || CAST(s_nationkey AS VARCHAR)}] END} AS blocks
FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def matched(spark, sf) -> DataFrame:
    """Template artefact (meta, html, css) for each supplier's match, with the
    declared scalar list and repeating map parsed once."""
    t = X.templates(spark, sf)
    ph = K.placeholders_struct("meta")
    t = t.select(
        "page_id", "meta", "html", "css",
        F.coalesce(ph["scalar"], F.array().cast("array<string>")).alias("scalar"),
        F.coalesce(ph["repeating"], F.create_map().cast(K.REPEATING_SCHEMA)).alias("repeating"),
    )
    bd = business_data(spark, sf)
    return bd.join(t, bd["s_suppkey"] == t["page_id"])


_MATCHED_SQL = f"""(SELECT b.s_suppkey, t.page_id, t.meta, t.html, t.css, b.scalars, b.blocks,
   coalesce(CAST(json_extract(t.meta, '$.placeholders.scalar') AS VARCHAR[]), []) AS scalar,
   coalesce(json_keys(t.meta, '$.placeholders.repeating'), []) AS rep_keys
 FROM {_BD_SQL} b JOIN {X.TEMPLATES_SQL} t ON b.s_suppkey = t.page_id)"""


def _sql_problems():
    return f"""nullif(array_to_string(list_concat(
   list_filter(list_transform(scalar, lambda f: CASE WHEN NOT map_contains(scalars, f) THEN {sql_fmt(R.MSG_MISSING_SCALAR, field='f')}
        WHEN contains(lower(f), '{R.COLOR_FIELD_MARK}') AND NOT coalesce(regexp_matches(scalars[f], '{K.HEX_COLOR}'), false) THEN {sql_fmt(R.MSG_BAD_COLOR, field='f')} END),
        lambda x: x IS NOT NULL),
   list_filter(list_transform(rep_keys, lambda b: CASE WHEN NOT map_contains(blocks, b) OR coalesce(len(blocks[b]), 0) = 0
        THEN {sql_fmt(R.MSG_MISSING_BLOCK, block='b')} END), lambda x: x IS NOT NULL)), '{R.PROBLEM_SEPARATOR}'), '')"""


def _sql_patch(x):
    return f"list_reduce(scalar, lambda acc, f: CASE WHEN map_contains(scalars, f) THEN replace(acc, '{{{{' || f || '}}}}', scalars[f]) ELSE acc END, {x})"


def _sql_expand(html, name, items, fields):
    pat = f"'(?s)<!--{WS}*REPEAT:' || {name} || '{WS}*-->(.*?)<!--{WS}*END:' || {name} || '{WS}*-->'"
    whole = f"regexp_extract({html}, {pat}, 0)"
    body = f"regexp_extract({html}, {pat}, 1)"
    fill = f"list_reduce({fields}, lambda acc2, f: CASE WHEN map_contains(i, f) THEN replace(acc2, '{{{{' || f || '}}}}', i[f]) ELSE acc2 END, {body})"
    expanded = f"array_to_string(list_transform(coalesce({items}, []), lambda i: {fill}), '')"
    return (
        f"(CASE WHEN {whole} <> '' THEN substr({html}, 1, strpos({html}, {whole}) - 1) || {expanded} "
        f"|| substr({html}, strpos({html}, {whole}) + length({whole})) ELSE {html} END)"
    )


@register("business_data_check", f"SELECT s_suppkey, page_id, {_sql_problems()} AS problems FROM {_MATCHED_SQL}")
def business_data_check(spark, sf):
    m = matched(spark, sf)
    return m.select(
        "s_suppkey", "page_id", R.business_data_problems("scalar", F.map_keys("repeating"), "scalars", "blocks").alias("problems")
    )


def _sql_default_scalars():
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in R.DEFAULT_FIELDS.items()) + "}"
    return (
        f"array_to_string(list_transform(list_sort(list_distinct(scalar)), lambda f: f || '=' || coalesce({known}[f], "
        f"CASE WHEN contains(lower(f), '{R.COLOR_FIELD_MARK}') THEN '{R.DEFAULT_COLOR}' END, {sql_fmt(R.PLEASE_FILL, field='f')})), ';')"
    )


def _sql_default_blocks():
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in R.DEFAULT_ITEM_FIELDS.items()) + "}"
    fields = "coalesce(CAST(json_extract(meta, '$.placeholders.repeating.\"' || b || '\".fields') AS VARCHAR[]), [])"
    return (
        f"array_to_string(list_transform(rep_keys, lambda b: b || ':' || array_to_string(list_transform(list_sort(list_distinct({fields})), "
        f"lambda f: f || '=' || coalesce({known}[f], {sql_fmt(R.PLEASE_FILL, field='f')})), ';')), '|')"
    )


@register(
    "default_business_data",
    f"""SELECT page_id, {_sql_default_scalars()} AS scalars, {_sql_default_blocks()} AS blocks FROM
 (SELECT page_id, meta, coalesce(CAST(json_extract(meta, '$.placeholders.scalar') AS VARCHAR[]), []) AS scalar,
         coalesce(json_keys(meta, '$.placeholders.repeating'), []) AS rep_keys FROM {X.TEMPLATES_SQL})""",
)
def default_business_data(spark, sf):
    t = X.templates(spark, sf)
    ph = K.placeholders_struct("meta")
    t = t.select(
        "page_id",
        F.coalesce(ph["scalar"], F.array().cast("array<string>")).alias("scalar"),
        F.coalesce(ph["repeating"], F.create_map().cast(K.REPEATING_SCHEMA)).alias("rep"),
    )
    blocks = F.array_join(
        F.transform(F.map_keys("rep"), lambda b: F.concat(b, F.lit(":"), R.map_text(R.default_item(F.col("rep")[b]["fields"])))), "|"
    )
    return t.select("page_id", R.map_text(R.default_scalars(F.array_distinct("scalar"))).alias("scalars"), blocks.alias("blocks"))


@register(
    "patch_scalars",
    f"SELECT s_suppkey, page_id, md5({_sql_patch('html')}) AS html_md5, md5({_sql_patch('css')}) AS css_md5, "
    f"CAST(length({_sql_patch('html')}) AS BIGINT) AS html_len FROM {_MATCHED_SQL} WHERE css IS NOT NULL",
)
def patch_scalars(spark, sf):
    m = matched(spark, sf).where(F.col("css").isNotNull())
    h = R.patch_scalars("html", "scalar", "scalars")
    return m.select(
        "s_suppkey", "page_id", F.md5(h).alias("html_md5"), F.md5(R.patch_scalars("css", "scalar", "scalars")).alias("css_md5"),
        F.length(h).cast("long").alias("html_len"),
    )


@register(
    "expand_blocks",
    f"SELECT s_suppkey, page_id, md5({_sql_expand('html', chr(39) + 'items' + chr(39), 'blocks[' + chr(39) + 'items' + chr(39) + ']', 'CAST(json_extract(meta, ' + chr(39) + '$.placeholders.repeating.items.fields' + chr(39) + ') AS VARCHAR[])')}) AS html_md5 FROM {_MATCHED_SQL}",
)
def expand_blocks(spark, sf):
    """B19 for the 'items' block of each matched template."""
    m = matched(spark, sf)
    h = R.expand_block("html", F.lit("items"), F.col("blocks")["items"], F.col("repeating")["items"]["fields"])
    return m.select("s_suppkey", "page_id", F.md5(h).alias("html_md5"))


def site_columns() -> tuple[F.Column, F.Column]:
    """B18 + B19 over (html, css, scalar, repeating, scalars, blocks): scalars patched in html and css, then every declared
    block expanded in declaration order."""
    html = F.aggregate(
        F.map_keys("repeating"),
        R.patch_scalars("html", "scalar", "scalars"),
        lambda acc, b: R.expand_block(acc, b, F.col("blocks")[b], F.col("repeating")[b]["fields"]),
    )
    return html, R.patch_scalars(F.coalesce(F.col("css"), F.lit("")), "scalar", "scalars")


def render_sites_df(m: DataFrame) -> DataFrame:
    """Check data -> patch scalars in html and css -> expand every declared
    block in declaration order. Failed rows carry the problem text instead."""
    problems = R.business_data_problems("scalar", F.map_keys("repeating"), "scalars", "blocks")
    html, css = site_columns()
    out = m.select("s_suppkey", "page_id", problems.alias("error"), html.alias("h"), css.alias("c"))
    ok = F.col("error").isNull()
    return out.select(
        "s_suppkey",
        "page_id",
        F.when(ok, "success").otherwise("error").alias("status"),
        "error",
        F.when(ok, F.md5("h")).alias("html_md5"),
        F.when(ok, F.md5("c")).alias("css_md5"),
    )


_BLOCK_FIELDS = "coalesce(CAST(json_extract(meta, '$.placeholders.repeating.\"' || b || '\".fields') AS VARCHAR[]), [])"


@register(
    "render_sites",
    f"""SELECT s_suppkey, page_id, CASE WHEN problems IS NULL THEN 'success' ELSE 'error' END AS status, problems AS error,
  CASE WHEN problems IS NULL THEN md5(list_reduce(rep_keys, lambda hacc, b: {_sql_expand('hacc', 'b', 'blocks[b]', _BLOCK_FIELDS)}, {_sql_patch('html')})) END AS html_md5,
  CASE WHEN problems IS NULL THEN md5({_sql_patch("coalesce(css, '')")}) END AS css_md5
FROM (SELECT *, {_sql_problems()} AS problems FROM {_MATCHED_SQL})""",
)
def render_sites(spark, sf):
    return render_sites_df(matched(spark, sf))
