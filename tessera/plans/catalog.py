"""Catalogue jobs: specs and ids (B1-B4, C13), audit set algebra (C1-C4, D6, E8,
E13, B34), contracts (B11-B15, B35, B37, C10) and the review gate (G6, D5, G7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions import text as T
from tessera.functions.fmt import sql_fmt
from tessera.operators.ordering import range_rank
from tessera.plans import fixtures as X
from tessera.plans import sql as S
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.files import write_report
from tessera.sources.tables import table

# Prompt text pieces (rendered by concatenation, like str.format).
PROMPT_PIECES = ("Create a ", " website template, variant \"", "\". Guidance: ")
OLD_NAME = " old"  # fixture: a part returned more often than kept was generated under an older name
UPLOADED_PREFIX = "en/"


# --------------------------------------------------------------------------- specs
def effective_variant() -> F.Column:
    """B3 fallback: variant, else component_type, else ''."""
    return F.coalesce(F.col("variant"), F.col("component_type"), F.lit(""))


def spec_id() -> F.Column:
    """B2: ``{category}-{slug}-v1`` or ``component-{type}-{slug}-v1``."""
    s = T.slugify(effective_variant())
    return F.when(
        F.col("category") == "components", F.concat(F.lit("component-"), F.col("component_type"), F.lit("-"), s, F.lit("-v1"))
    ).otherwise(F.concat(F.col("category"), F.lit("-"), s, F.lit("-v1")))


_VAR_SQL = "coalesce(variant, component_type, '')"
_ID_SQL = (
    f"CASE WHEN category = 'components' THEN 'component-' || component_type || '-' || {S.slug(_VAR_SQL)} || '-v1' "
    f"ELSE category || '-' || {S.slug(_VAR_SQL)} || '-v1' END"
)


def explode_specs(nested: DataFrame, category_col: str = "category", variants_col: str = "variants") -> DataFrame:
    """C13 from the declaration shape: ``(category, array<struct<variant, guidance>>)``
    -> one spec row per variant, declaration position kept in ``pos``."""
    e = nested.select(category_col, F.posexplode(variants_col).alias("pos", "v"))
    out = e.select(
        "pos", category_col, F.lit(None).cast("string").alias("component_type"), F.col("v.variant").alias("variant"),
        F.col("v.guidance").alias("guidance"),
    )
    return out.withColumn("spec_id", spec_id())


def all_specs(spark: SparkSession, sf: str) -> DataFrame:
    """Site specs ∪ component specs with ids."""
    u = X.site_specs(spark, sf).unionByName(X.component_specs(spark, sf))
    return u.withColumn("spec_id", spec_id())


_NAME_KEY_SQL = "p_name || ' ' || CAST(p_partkey AS VARCHAR)"
_SPECS_SQL = f"(SELECT *, {_ID_SQL} AS spec_id FROM (SELECT * FROM {X.SITE_SQL} UNION ALL SELECT * FROM {X.COMP_SQL}))"


@register(
    "slug_ids",
    f"SELECT p_partkey, {S.slug('p_name')} AS name_slug, {S.slug('p_type')} AS type_slug, "
    f"lower(p_type) || '-' || {S.slug(_NAME_KEY_SQL)} || '-v1' AS spec_id FROM part",
)
def slug_ids(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey",
        T.slugify("p_name").alias("name_slug"),
        T.slugify("p_type").alias("type_slug"),
        F.concat(F.lower("p_type"), F.lit("-"), T.slugify(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))), F.lit("-v1")).alias(
            "spec_id"
        ),
    )


@register("spec_explode", f"SELECT pos, category, component_type, variant, spec_id FROM {_SPECS_SQL}")
def spec_explode(spark, sf):
    return all_specs(spark, sf).select("pos", "category", "component_type", "variant", "spec_id")


@register(
    "prompt_render",
    f"SELECT spec_id, '{PROMPT_PIECES[0]}' || category || '{PROMPT_PIECES[1]}' || {_VAR_SQL} || '{PROMPT_PIECES[2]}' || guidance AS prompt "
    f"FROM {_SPECS_SQL}",
)
def prompt_render(spark, sf):
    s = all_specs(spark, sf)
    a, b, c = PROMPT_PIECES
    return s.select("spec_id", F.concat(F.lit(a), "category", F.lit(b), effective_variant(), F.lit(c), "guidance").alias("prompt"))


def embed_text_col(meta: str = "meta") -> F.Column:
    """``f"{category} {subcategory}. {description}"`` with '' for absent keys."""
    g = lambda k: F.coalesce(F.get_json_object(F.col(meta), f"$.{k}"), F.lit(""))
    return F.concat(g("category"), F.lit(" "), g("subcategory"), F.lit(". "), g("description"))


def sql_embed_text(meta="meta"):
    g = lambda k: f"coalesce(json_extract_string({meta}, '$.{k}'), '')"
    return f"{g('category')} || ' ' || {g('subcategory')} || '. ' || {g('description')}"


@register(
    "embed_text",
    f"SELECT page_id, path, coalesce(json_extract_string(meta, '$.level'), 'whole-site') AS level, {sql_embed_text()} AS embed_text "
    f"FROM {X.TEMPLATES_SQL}",
)
def embed_text(spark, sf):
    t = X.templates(spark, sf)
    return t.select(
        "page_id", "path", F.coalesce(F.get_json_object("meta", "$.level"), F.lit("whole-site")).alias("level"), embed_text_col().alias("embed_text")
    )


# --------------------------------------------------------------------------- audit
def planned_specs(spark, sf) -> DataFrame:
    """Site specs of the catalogue plan: all parts."""
    return X.site_specs(spark, sf).withColumn("spec_id", spec_id())


def done_ids(spark, sf) -> DataFrame:
    """Ids already generated: one per sold part, over all line items; parts with more returned than open lines carry the
    id of an older name, which no plan holds."""
    flag = lambda x: F.count_if(F.col("l_returnflag") == x)
    sold = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg((flag("R") > flag("N")).alias("old"))
    p = table(spark, sf, "part").join(sold, "p_partkey")
    p = p.withColumn("p_name", F.concat("p_name", F.when(F.col("old"), OLD_NAME).otherwise("")))
    return p.selectExpr(*X._SITE).withColumn("spec_id", spec_id()).select("spec_id").distinct()


_PLANNED_SQL = f"(SELECT *, {_ID_SQL} AS spec_id FROM {X.SITE_SQL})"
_DONE_SQL = (
    f"(SELECT DISTINCT {_ID_SQL} AS spec_id FROM (SELECT {', '.join(X._SITE)} FROM (SELECT p.* REPLACE (p_name || CASE WHEN old THEN '{OLD_NAME}' ELSE '' END AS p_name) "
    "FROM part p JOIN (SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS old "
    "FROM lineitem GROUP BY l_partkey) l ON l_partkey = p_partkey)))"
)


@register("missing_ids", f"SELECT spec_id FROM {_PLANNED_SQL} EXCEPT SELECT spec_id FROM {_DONE_SQL} ORDER BY spec_id")
def missing_ids(spark, sf):
    """C3 + E8: expected − existing, sorted."""
    return planned_specs(spark, sf).select("spec_id").subtract(done_ids(spark, sf)).orderBy("spec_id")


@register("extra_ids", f"SELECT spec_id FROM {_DONE_SQL} EXCEPT SELECT spec_id FROM {_PLANNED_SQL} ORDER BY spec_id")
def extra_ids(spark, sf):
    """C4 + E8: existing − expected, sorted."""
    return done_ids(spark, sf).subtract(planned_specs(spark, sf).select("spec_id")).orderBy("spec_id")


@register(
    "audit_summary",
    f"""
SELECT (SELECT count(DISTINCT spec_id) FROM {_PLANNED_SQL}) AS expected_count,
       (SELECT count(*) FROM {_DONE_SQL}) AS found_count,
       (SELECT count(*) FROM (SELECT spec_id FROM {_PLANNED_SQL} EXCEPT SELECT spec_id FROM {_DONE_SQL})) AS n_missing,
       (SELECT count(*) FROM (SELECT spec_id FROM {_DONE_SQL} EXCEPT SELECT spec_id FROM {_PLANNED_SQL})) AS n_extra
""",
)
def audit_summary(spark, sf):
    """D6 counts. The sorted id lists are the missing_ids / extra_ids queries (one row
    per id) rather than arrays collected into a single row."""
    exp = planned_specs(spark, sf).select("spec_id").distinct().withColumn("e", F.lit(1))
    got = done_ids(spark, sf).withColumn("g", F.lit(1))
    j = exp.join(got, "spec_id", "full_outer")
    return j.agg(
        F.count("e").alias("expected_count"),
        F.count("g").alias("found_count"),
        F.count_if(F.col("g").isNull()).alias("n_missing"),
        F.count_if(F.col("e").isNull()).alias("n_extra"),
    )


def remaining_specs(spark, sf) -> DataFrame:
    """Planned specs whose id is not completed (hash anti-join)."""
    return planned_specs(spark, sf).join(done_ids(spark, sf), "spec_id", "left_anti")


_REMAIN_SQL = f"(SELECT * FROM {_PLANNED_SQL} WHERE spec_id NOT IN (SELECT spec_id FROM {_DONE_SQL}))"


@register("resume_remaining", f"SELECT pos, spec_id, category, variant FROM {_REMAIN_SQL}")
def resume_remaining(spark, sf):
    return remaining_specs(spark, sf).select("pos", "spec_id", "category", "variant")


@register(
    "numbered_remaining",
    f"""
SELECT pos, spec_id, row_number() OVER (ORDER BY pos) AS position, count(*) OVER () AS total,
       '[' || CAST(row_number() OVER (ORDER BY pos) AS VARCHAR) || '/' || CAST(count(*) OVER () AS VARCHAR) || ']' AS progress
FROM {_REMAIN_SQL}
""",
)
def numbered_remaining(spark, sf):
    """``[i/total]`` in declaration order, ranked without a one-task window."""
    r = range_rank(remaining_specs(spark, sf).select("pos", "spec_id"), "pos", rank_col="position", total_col="total")
    return r.withColumn(
        "progress", F.concat(F.lit("["), F.col("position").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit("]"))
    )


def archive_entries(pages: DataFrame) -> DataFrame:
    """B34 on URLs-as-paths: entry = path after the host, query/fragment dropped."""
    entry = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]+/", ""), "[?#].*$", "")
    e = pages.select("page_id", entry.alias("entry"))
    return e.withColumn("base_name", F.element_at(F.split("entry", "/"), -1))


_ENTRIES_SQL = (
    "(SELECT page_id, entry, split_part(entry, '/', -1) AS base_name FROM "
    "(SELECT page_id, regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '[?#].*$', '') AS entry FROM pages))"
)


@register(
    "manifest_diff",
    f"""
SELECT page_id, entry, base_name FROM {_ENTRIES_SQL} e
WHERE NOT ends_with(entry, '/') AND base_name NOT IN
  (SELECT base_name FROM {_ENTRIES_SQL} WHERE starts_with(entry, '{UPLOADED_PREFIX}') AND NOT ends_with(entry, '/'))
""",
)
def manifest_diff(spark, sf):
    """Entries (directories skipped) whose base name is not already uploaded
    under the prefix — same name in another folder collides, as in the reference."""
    e = archive_entries(table(spark, sf, "pages")).where(~F.col("entry").endswith("/"))
    uploaded = e.where(F.col("entry").startswith(UPLOADED_PREFIX)).select("base_name").distinct()
    return e.join(uploaded, "base_name", "left_anti").select("page_id", "entry", "base_name")


# --------------------------------------------------------------------------- contracts
def _sql_pyset(x):
    return f"('{{' || array_to_string(list_transform(list_sort({x}), lambda e: '''' || e || ''''), ', ') || '}}')"


def sql_template_error(src: str) -> str:
    """DuckDB twin of ``contracts.template_error`` over a relation with meta/html/css."""
    req = " ".join(
        f"WHEN NOT list_contains(keys, '{f}') THEN {sql_fmt(K.MSG_MISSING_FIELD, field=repr(f))}" for f in K.TEMPLATE_REQUIRED
    )
    ends = " OR ".join(f"contains(html, {sql_fmt(m, block='b')})" for m in K.END_MARKERS)
    return f"""
(WITH p AS (SELECT *, json_keys(meta) AS keys,
        coalesce(CAST(json_extract(meta, '$.placeholders.scalar') AS VARCHAR[]), []) AS scalar,
        coalesce(json_keys(meta, '$.placeholders.repeating'), []) AS rep_keys,
        list_distinct(list_concat({S.placeholders('html')}, {S.placeholders('css')})) AS used,
        {S.repeat_blocks('html')} AS blocks FROM {src}),
 q AS (SELECT *, flatten(list_transform(rep_keys, lambda b: coalesce(CAST(json_extract(meta, '$.placeholders.repeating."' || b || '".fields') AS VARCHAR[]), []))) AS rep_fields FROM p),
 r AS (SELECT *, list_distinct(list_filter(used, lambda e: NOT list_contains(list_concat(scalar, rep_fields), e))) AS undeclared,
              list_distinct(list_filter(scalar, lambda e: NOT list_contains(used, e))) AS unused,
              list_filter(rep_keys, lambda b: NOT list_contains(blocks, b) OR NOT ({ends}))[1] AS bad_block
       FROM q)
 SELECT *, CASE {req}
   WHEN len(undeclared) > 0 THEN {sql_fmt(K.MSG_UNDECLARED, names=_sql_pyset('undeclared'))}
   WHEN len(unused) > 0 THEN {sql_fmt(K.MSG_UNUSED, names=_sql_pyset('unused'))}
   WHEN bad_block IS NOT NULL THEN CASE WHEN NOT list_contains(blocks, bad_block)
        THEN {sql_fmt(K.MSG_NO_BLOCK, block='bad_block')}
        ELSE {sql_fmt(K.MSG_NO_END, block='bad_block')} END
   END AS error FROM r)"""


@register(
    "placeholder_sets",
    f"SELECT page_id, array_to_string(list_sort(list_distinct(list_concat({S.placeholders('html')}, coalesce({S.placeholders('css')}, [])))), ',') AS placeholders "
    f"FROM {X.TEMPLATES_SQL}",
)
def placeholder_sets(spark, sf):
    t = X.templates(spark, sf)
    u = F.array_union(T.placeholders("html"), F.coalesce(T.placeholders("css"), F.array().cast("array<string>")))
    return t.select("page_id", F.array_join(F.array_sort(u), ",").alias("placeholders"))


@register(
    "repeat_blocks",
    f"SELECT page_id, array_to_string(list_sort({S.repeat_blocks('html')}), ',') AS blocks FROM {X.TEMPLATES_SQL}",
)
def repeat_blocks(spark, sf):
    t = X.templates(spark, sf)
    return t.select("page_id", F.array_join(F.array_sort(T.repeat_blocks("html")), ",").alias("blocks"))


@register(
    "html_comment_markers",
    f"""
SELECT page_id, CAST(len(c) AS BIGINT) AS n_comments,
       array_to_string(list_sort(list_distinct(list_transform(c, lambda x: {S.strip('x')}))), '|') AS markers,
       array_to_string(list_sort({S.repeat_blocks('html')}), ',') AS repeat_blocks
FROM (SELECT page_id, html, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS c FROM pages)
""",
)
def html_comment_markers(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "html", F.regexp_extract_all("html", F.lit(r"(?s)<!--(.*?)-->"), 1).alias("c"))
    return p.select(
        "page_id",
        F.size("c").cast("long").alias("n_comments"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("c", lambda x: T.py_strip(x)))), "|").alias("markers"),
        F.array_join(F.array_sort(T.repeat_blocks("html")), ",").alias("repeat_blocks"),
    )


@register(
    "template_validation",
    f"SELECT page_id, spec_id, error FROM {sql_template_error(X.TEMPLATES_SQL + ' WHERE html IS NOT NULL AND css IS NOT NULL')}",
)
def template_validation(spark, sf):
    """B13 over every complete artefact (html and css present)."""
    t = X.templates(spark, sf).where(F.col("html").isNotNull() & F.col("css").isNotNull())
    return t.select("page_id", "spec_id", K.template_error("meta", "html", "css").alias("error"))


def _sql_effect_error():
    req = " ".join(
        f"WHEN NOT list_contains(json_keys(meta), '{f}') THEN {sql_fmt(K.MSG_MISSING_FIELD, field=repr(f))}" for f in K.EFFECT_REQUIRED
    )
    t, cc = "json_extract_string(meta, '$.trigger')", "json_extract_string(meta, '$.css_class')"
    js_t, js_v = "json_type(meta, '$.requires_js')", "json_extract_string(meta, '$.requires_js')"
    sh_t, sh_v = "json_type(meta, '$.requires_shared_js')", "json_extract_string(meta, '$.requires_shared_js')"
    is_true = f"({js_t} = 'BOOLEAN' AND {js_v} = 'true')"
    is_false = f"({js_t} = 'BOOLEAN' AND {js_v} = 'false')"
    q = lambda x: "'" + x.replace("'", "''") + "'"
    return f"""CASE {req}
  WHEN {t} IS DISTINCT FROM expected_trigger THEN {sql_fmt(K.MSG_TRIGGER, expected='expected_trigger', got=f"coalesce({t}, 'None')")}
  WHEN NOT starts_with({cc}, {q(K.EFFECT_CLASS_PREFIX)}) THEN {sql_fmt(K.MSG_PREFIX, css_class=cc)}
  WHEN NOT contains(css, {cc}) THEN {sql_fmt(K.MSG_CLASS_NOT_IN_CSS, css_class=cc)}
  WHEN NOT contains(css, {q(K.CSS_REDUCED_MOTION)}) THEN {q(K.MSG_REDUCED_MOTION)}
  WHEN expected_trigger = 'onscroll' AND NOT {is_true} THEN {q(K.MSG_SCROLL_JS)}
  WHEN expected_trigger = 'onscroll' AND NOT ({sh_t} = 'VARCHAR' AND {sh_v} = {q(K.SCROLL_HELPER_ID)}) THEN {q(K.MSG_SCROLL_SHARED)}
  WHEN expected_trigger = 'onscroll' AND NOT contains(css, {q(K.CSS_IN_VIEW)}) THEN {q(K.MSG_SCROLL_IN_VIEW)}
  WHEN expected_trigger = 'onscroll' AND NOT contains(css, {q(K.CSS_SCROLL_TARGET)}) THEN {q(K.MSG_SCROLL_TARGET)}
  WHEN expected_trigger <> 'onscroll' AND NOT {is_false} THEN {sql_fmt(K.MSG_NO_JS, trigger='expected_trigger')}
  WHEN expected_trigger <> 'onscroll' AND {sh_t} IS DISTINCT FROM 'NULL' THEN {sql_fmt(K.MSG_NO_SHARED, trigger='expected_trigger')}
  WHEN expected_trigger = 'onload' AND NOT contains(css, {q(K.CSS_KEYFRAMES)}) THEN {q(K.MSG_KEYFRAMES)}
  WHEN expected_trigger = 'hover' AND NOT contains(css, {q(K.CSS_HOVER)}) THEN {q(K.MSG_HOVER)}
END"""


@register("effect_validation", f"SELECT p_partkey, effect_id, expected_trigger, {_sql_effect_error()} AS error FROM {X.EFFECTS_SQL}")
def effect_validation(spark, sf):
    e = X.effects(spark, sf)
    return e.select("p_partkey", "effect_id", "expected_trigger", K.effect_error("meta", "css", "expected_trigger").alias("error"))


def review_gate_df(t: DataFrame, keep=("page_id",)) -> DataFrame:
    """Already reviewed -> missing files -> failed validation -> reviewed. ``keep``: more columns to return."""
    ident = F.coalesce(F.get_json_object("meta", "$.id"), F.col("path"))
    err = K.template_error("meta", "html", "css")
    status = (
        F.when(K.strictly_reviewed("meta"), "already_reviewed")
        .when(K.files_missing("html", "css"), "missing_files")
        .when(err.isNotNull(), "failed_validation")
        .otherwise("marked_reviewed")
    )
    out = t.select(*keep, ident.alias("id"), "path", status.alias("status"), err.alias("_err"))
    return out.select(
        *keep,
        "id",
        "path",
        "status",
        F.when(F.col("status") == "missing_files", F.lit(K.MSG_MISSING_FILES))
        .when(F.col("status") == "failed_validation", F.col("_err"))
        .alias("error"),
    )


_REVIEW_SQL = f"""(
SELECT page_id, coalesce(json_extract_string(meta, '$.id'), path) AS id, path,
  CASE WHEN json_type(meta, '$.reviewed') = 'BOOLEAN' AND json_extract_string(meta, '$.reviewed') = 'true' THEN 'already_reviewed'
       WHEN html IS NULL OR css IS NULL THEN 'missing_files'
       WHEN error IS NOT NULL THEN 'failed_validation' ELSE 'marked_reviewed' END AS status,
  CASE WHEN json_type(meta, '$.reviewed') = 'BOOLEAN' AND json_extract_string(meta, '$.reviewed') = 'true' THEN NULL
       WHEN html IS NULL OR css IS NULL THEN '{K.MSG_MISSING_FILES}'
       ELSE error END AS error
FROM {sql_template_error(X.TEMPLATES_SQL)})"""


@register("review_gate", f"SELECT page_id, id, path, status, error FROM {_REVIEW_SQL}")
def review_gate(spark, sf):
    return review_gate_df(X.templates(spark, sf))


@register("review_summary", f"SELECT status, count(*) AS n FROM {_REVIEW_SQL} GROUP BY status")
def review_summary(spark, sf):
    """D5."""
    return review_gate(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register(
    "catalog_audit",
    f"""
WITH ex AS (SELECT DISTINCT 'page-' || CAST(page_id AS VARCHAR) || '-v1' AS id FROM pages),
     found AS (SELECT DISTINCT coalesce(json_extract_string(meta, '$.id'), path) AS id FROM {X.TEMPLATES_SQL}),
     issues AS (SELECT coalesce(json_extract_string(meta, '$.id'), path) AS id FROM {X.TEMPLATES_SQL} WHERE html IS NULL OR css IS NULL)
SELECT (SELECT count(*) FROM ex) AS expected_count, (SELECT count(*) FROM found) AS found_count,
       (SELECT count(*) FROM (SELECT id FROM ex EXCEPT SELECT id FROM found)) AS n_missing,
       (SELECT count(*) FROM (SELECT id FROM found EXCEPT SELECT id FROM ex)) AS n_extra,
       (SELECT count(*) FROM issues) AS n_file_issues
""",
)
def catalog_audit(spark, sf):
    """Expected ids (one spec per page) vs the ids found in the catalogue
    (meta id, else folder path) plus artefacts with a missing file (not distinct)."""
    t = X.templates(spark, sf)
    ident = F.coalesce(F.get_json_object("meta", "$.id"), F.col("path"))
    ex = table(spark, sf, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit("-v1")).alias("id")).distinct()
    found = t.select(ident.alias("id"), K.files_missing("html", "css").alias("issue"))
    fid = found.groupBy("id").agg(F.count_if("issue").alias("issues"))
    j = ex.withColumn("e", F.lit(1)).join(fid.withColumn("g", F.lit(1)), "id", "full_outer")
    report = j.agg(
        F.count("e").alias("expected_count"),
        F.count("g").alias("found_count"),
        F.count_if(F.col("g").isNull()).alias("n_missing"),
        F.count_if(F.col("e").isNull()).alias("n_extra"),
        F.coalesce(F.sum("issues"), F.lit(0)).cast("long").alias("n_file_issues"),
    )
    # The one-row report as a JSON file, read back
    path = scratch_path(spark, "audit-report")
    write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@register(
    "catalog_audit_all",
    f"""WITH ex AS (SELECT DISTINCT 'page-' || CAST(page_id AS VARCHAR) || '-v1' AS id FROM pages),
     arts AS (SELECT coalesce(json_extract_string(meta, '$.id'), path) AS id, (html IS NULL OR css IS NULL) AS issue FROM {X.TEMPLATES_SQL}
              UNION ALL SELECT coalesce(json_extract_string(meta, '$.id'), 'effects/' || effect_id) AS id, true AS issue FROM {X.EFFECTS_SQL}),
     found AS (SELECT DISTINCT id FROM arts)
SELECT (SELECT count(*) FROM ex) AS expected_count, (SELECT count(*) FROM found) AS found_count,
       (SELECT count(*) FROM (SELECT id FROM ex EXCEPT SELECT id FROM found)) AS n_missing,
       (SELECT count(*) FROM (SELECT id FROM found EXCEPT SELECT id FROM ex)) AS n_extra,
       (SELECT count_if(issue) FROM arts) AS n_file_issues
""",
)
def catalog_audit_all(spark, sf):
    """G7 without the type filter: effect metas live in the same tree, carry no
    index.html, so they count as extra ids and as missing-file artefacts."""
    t = X.templates(spark, sf).select(
        F.coalesce(F.get_json_object("meta", "$.id"), F.col("path")).alias("id"), K.files_missing("html", "css").alias("issue")
    )
    e = X.effects(spark, sf).select(
        F.coalesce(F.get_json_object("meta", "$.id"), F.concat(F.lit("effects/"), "effect_id")).alias("id"),
        F.lit(True).alias("issue"),  # effects have no index.html
    )
    arts = t.unionByName(e)
    ex = table(spark, sf, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit("-v1")).alias("id")).distinct()
    fid = arts.groupBy("id").agg(F.count_if("issue").alias("issues"))
    j = ex.withColumn("e", F.lit(1)).join(fid.withColumn("g", F.lit(1)), "id", "full_outer")
    return j.agg(
        F.count("e").alias("expected_count"),
        F.count("g").alias("found_count"),
        F.count_if(F.col("g").isNull()).alias("n_missing"),
        F.count_if(F.col("e").isNull()).alias("n_extra"),
        F.coalesce(F.sum("issues"), F.lit(0)).cast("long").alias("n_file_issues"),
    )
