"""Generation and review with their sinks (G5, G6, G7; A3, A4, A7-A9, B14, B15): what is written is read back.

Fixtures: template responses as in ``plans.jobs``; effect responses from ``part`` (broken JSON on attempt 1 for
p_partkey % 4 = 1, the css key missing on 2, fenced on 3, plain on 4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions.fmt import fmt, sql_fmt
from tessera.plans import fixtures as X
from tessera.plans.catalog import _REVIEW_SQL, _sql_effect_error, review_gate_df, sql_template_error
from tessera.plans.jobs import (
    _PARSED_SQL,
    MAX_ATTEMPTS,
    MSG_GAVE_UP,
    MSG_INVALID_JSON,
    MSG_TOP_KEYS_OF,
    _json_str,
    _sql_response_error,
    parsed_effects,
    parsed_templates,
    responses,
)
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources import artefacts as AR
from tessera.sources import files as FS
from tessera.sources.tables import table


def _gave_up(error) -> F.Column:
    return fmt(MSG_GAVE_UP, attempts=MAX_ATTEMPTS, error=error)


_GAVE_UP_SQL = sql_fmt(MSG_GAVE_UP, attempts=str(MAX_ATTEMPTS), error="last_err")


def _keys(meta: str) -> F.Column:
    return F.array_join(F.json_object_keys(meta), ",")


def _two_runs(spark, parsed, resp: DataFrame, done: DataFrame, root: str, group: str, files) -> DataFrame:
    """Progress of an earlier run, then two runs over the same responses; logs and tree as read back, with how many
    artefacts the second run wrote for a spec."""
    AR.write_run(done, f"{root}/_progress", "earlier")
    for run in ("first", "second"):
        AR.ingest(spark, parsed, resp, root, run, group, files, MAX_ATTEMPTS, _gave_up)
    logged = AR.read_runs(spark, f"{root}/_progress", "id string, written boolean").where("run <> 'earlier'")
    saved = logged.groupBy("id").agg(
        F.count_if((F.col("run") == "first") & F.col("written")).alias("n_written"), F.count_if(F.col("run") == "second").alias("n_again")
    )
    failed = AR.read_runs(spark, f"{root}/_failures", "id string, error string, timestamp timestamp").where("run = 'first' AND timestamp IS NOT NULL")
    tree = FS.scan_catalogue_tree(spark, root, files).withColumn("id", F.element_at(F.split("path", "/"), -1))
    rows = saved.join(failed.select("id", "error"), "id", "full_outer").join(tree, "id", "full_outer")
    return rows.select(
        F.col("id").alias("spec_id"), "path", "error", F.coalesce("n_written", F.lit(0)).alias("n_written"), F.coalesce("n_again", F.lit(0)).alias("n_again"),
        _keys("meta").alias("meta_keys"), *[F.md5(c).alias(f"{c}_md5") for c in files if c != "meta"],
    )


@register(
    "ingest_artefacts",
    f"""WITH e AS (SELECT page_id, spec_id, attempt, meta, html, css,
    CASE WHEN NOT ok_json THEN '{MSG_INVALID_JSON}' WHEN NOT ok_keys THEN '{K.MSG_TOP_KEYS}' ELSE error END AS err
  FROM {sql_template_error(_PARSED_SQL)}),
 g AS (SELECT spec_id, max_by(err, attempt) AS last_err, min(attempt) FILTER (err IS NULL) AS ok,
         min_by(meta, attempt) FILTER (err IS NULL) AS meta, min_by(html, attempt) FILTER (err IS NULL) AS html,
         min_by(css, attempt) FILTER (err IS NULL) AS css
       FROM e WHERE page_id % 9 <> 0 AND attempt <= {MAX_ATTEMPTS} GROUP BY spec_id)
SELECT spec_id, CASE WHEN ok IS NOT NULL THEN 'site/' || spec_id END AS path, CASE WHEN ok IS NULL THEN {_GAVE_UP_SQL} END AS error,
  CAST(ok IS NOT NULL AS BIGINT) AS n_written, CAST(0 AS BIGINT) AS n_again, array_to_string(json_keys(meta), ',') AS meta_keys,
  md5(html) AS html_md5, md5(css) AS css_md5 FROM g""",
)
def ingest_artefacts(spark, sf):
    """G5 with its sinks: resume, first valid response, artefact tree, progress and failure logs; run twice."""
    root = scratch_path(spark, "generated")
    resp = responses(spark, sf).withColumn("category", F.lit("site")).select("spec_id", "category", "attempt", "raw")
    done = X.templates(spark, sf).where(F.col("page_id") % 9 == 0).select(F.col("spec_id").alias("id"))
    return _two_runs(spark, parsed_templates, resp, done, root, "category", AR.TEMPLATE_FILES)


SPECS_A_TASK = 2_000  # a spec's row is small, its four responses are dear to check


def effect_responses(spark, sf) -> DataFrame:
    """Four generated responses per effect spec (one spec a part); the specs are dealt over tasks before responses are built,
    since a small file is read by one task."""
    specs = X.effects(spark, sf)
    specs = specs.repartition(max(1, -(-specs.count() // SPECS_A_TASK)), "p_partkey")
    e = specs.select("p_partkey", F.concat(F.lit("effect-"), F.col("p_partkey").cast("string")).alias("spec_id"), F.col("expected_trigger").alias("trigger"), "meta", "css")
    base = F.concat(F.lit('{"meta": '), "meta", F.lit(', "css": '), _json_str("css"), F.lit("}"))
    raw = F.array(
        F.when(F.col("p_partkey") % 4 == 1, F.concat(F.lit('{"meta": '), "meta")).otherwise(base),
        F.concat(F.lit('{"meta": '), "meta", F.lit("}")),
        F.concat(F.lit("```json\n"), base, F.lit("\n```")),
        base,
    )
    return e.select("p_partkey", "spec_id", "trigger", F.posexplode(raw).alias("attempt", "raw")).withColumn("attempt", F.col("attempt") + 1)


_EFFECT_RESP_SQL = f"""(SELECT p_partkey, spec_id, expected_trigger, attempt, raw FROM (
  SELECT p_partkey, 'effect-' || p_partkey AS spec_id, expected_trigger, meta,
    '{{"meta": ' || meta || ', "css": ' || to_json(css)::VARCHAR || '}}' AS base FROM {X.EFFECTS_SQL}) t,
  LATERAL (SELECT unnest([CASE WHEN p_partkey % 4 = 1 THEN '{{"meta": ' || meta ELSE base END, '{{"meta": ' || meta || '}}',
                          '```json' || chr(10) || base || chr(10) || '```', base]) AS raw,
                  unnest([1, 2, 3, 4]) AS attempt))"""


@register(
    "ingest_effects",
    f"""WITH c AS (SELECT *, {_sql_response_error()} AS cleaned FROM {_EFFECT_RESP_SQL}),
 p AS (SELECT p_partkey, spec_id, expected_trigger, attempt, json_valid(cleaned) AS ok_json,
    CASE WHEN json_valid(cleaned) THEN json_extract(cleaned, '$.meta')::VARCHAR END AS meta,
    CASE WHEN json_valid(cleaned) THEN json_extract_string(cleaned, '$.css') END AS css,
    CASE WHEN json_valid(cleaned) THEN list_contains(json_keys(cleaned), 'meta') AND list_contains(json_keys(cleaned), 'css') ELSE false END AS ok_keys FROM c),
 e AS (SELECT *, CASE WHEN NOT ok_json THEN '{MSG_INVALID_JSON}' WHEN NOT ok_keys THEN '{MSG_TOP_KEYS_OF.format(keys="meta/css")}'
    ELSE {_sql_effect_error()} END AS err FROM p),
 g AS (SELECT spec_id, expected_trigger, max_by(err, attempt) AS last_err, min(attempt) FILTER (err IS NULL) AS ok,
         min_by(meta, attempt) FILTER (err IS NULL) AS meta, min_by(css, attempt) FILTER (err IS NULL) AS css
       FROM e WHERE p_partkey % 9 <> 0 AND attempt <= {MAX_ATTEMPTS} GROUP BY spec_id, expected_trigger)
SELECT spec_id, CASE WHEN ok IS NOT NULL THEN expected_trigger || '/' || spec_id END AS path, CASE WHEN ok IS NULL THEN {_GAVE_UP_SQL} END AS error,
  CAST(ok IS NOT NULL AS BIGINT) AS n_written, CAST(0 AS BIGINT) AS n_again, array_to_string(json_keys(meta), ',') AS meta_keys,
  md5(css) AS css_md5 FROM g""",
)
def ingest_effects(spark, sf):
    """G5 for effects: B15 with B14 and its top-level keys, folders by trigger, logs; run twice."""
    root = scratch_path(spark, "effects")
    resp = effect_responses(spark, sf)
    done = table(spark, sf, "part").where(F.col("p_partkey") % 9 == 0).select(F.concat(F.lit("effect-"), F.col("p_partkey").cast("string")).alias("id"))
    return _two_runs(spark, parsed_effects, resp.drop("p_partkey"), done, root, "trigger", AR.EFFECT_FILES)


# --------------------------------------------------------------------------- G6
def review_tree(spark, root: str, work: str) -> DataFrame:
    """G6 on an artefact tree: the verdicts are written first, then the metas that passed are replaced by themselves with
    ``reviewed`` true, and the others are logged by group (A8, sorted JSON lines). Only a passed meta's new text is kept beside
    its verdict. Returns the verdicts (path, id, status, error), read back."""
    judged = review_gate_df(FS.scan_catalogue_tree(spark, root), keep=("meta",))
    marked = judged.withColumn("_old", F.when(F.col("status") == "marked_reviewed", F.col("meta"))).drop("meta")
    marked.withColumn("new_meta", AR.set_member("_old", "reviewed", True)).drop("_old").write.parquet(f"{work}/verdicts")
    verdicts = spark.read.parquet(f"{work}/verdicts")
    AR.replace_metas(verdicts.where(F.col("new_meta").isNotNull()), root).write.parquet(f"{work}/replaced")
    bad = verdicts.where(F.col("status").isin("failed_validation", "missing_files"))
    FS.write_lists(bad.select(F.col("status").alias("list"), "id", "path", "error"), f"{work}/failures", ["list", "id", "path"])
    return verdicts.drop("new_meta")


def _reviewed_once(spark, sf) -> tuple[str, str, DataFrame]:
    root, work = scratch_path(spark, "review-tree"), scratch_path(spark, "review")
    t = X.templates(spark, sf).withColumn("category", F.lit("site"))
    FS.write_catalogue_tree(t, root).write.parquet(f"{work}/written")
    return root, work, review_tree(spark, root, work)


@register(
    "review_writeback",
    f"""SELECT r.path, r.status AS first_status, CASE r.status WHEN 'marked_reviewed' THEN 'already_reviewed' ELSE r.status END AS second_status,
  CASE r.status WHEN 'marked_reviewed' THEN 'true' ELSE json_extract_string(t.meta, '$.reviewed') END AS reviewed,
  array_to_string(json_keys(t.meta), ',') AS meta_keys, json_extract_string(t.meta, '$.description') AS description,
  md5(replace(json_extract(t.meta, '$.placeholders')::VARCHAR, ' ', '')) AS placeholders_md5
FROM {_REVIEW_SQL} r JOIN {X.TEMPLATES_SQL} t USING (page_id)""",
)
def review_writeback(spark, sf):
    """G6 with its write-back: the tree reviewed, read again and reviewed again; members and their order stay."""
    root, _, first = _reviewed_once(spark, sf)
    again = review_gate_df(FS.scan_catalogue_tree(spark, root), keep=("meta",))
    return again.withColumnRenamed("status", "second_status").join(first.select("path", F.col("status").alias("first_status")), "path").select(
        "path", "first_status", "second_status", F.get_json_object("meta", "$.reviewed").alias("reviewed"), _keys("meta").alias("meta_keys"),
        F.get_json_object("meta", "$.description").alias("description"),
        F.md5(F.replace(F.get_json_object("meta", "$.placeholders"), F.lit(" "), F.lit(""))).alias("placeholders_md5"),
    )


@register(
    "review_failures",
    f"SELECT status AS list, id, path, error FROM {_REVIEW_SQL} WHERE status IN ('failed_validation', 'missing_files')",
)
def review_failures(spark, sf):
    """G6's failure log, grouped, as read back."""
    _, work, _ = _reviewed_once(spark, sf)
    return spark.read.schema("list string, id string, path string, error string").option("mode", "FAILFAST").json(f"{work}/failures")


# --------------------------------------------------------------------------- G7 / D6
def audit_rows(expected: DataFrame, found: DataFrame) -> DataFrame:
    """D6's three lists, one row per entry: ``missing_ids`` and ``extra_ids`` (distinct) and ``missing_file_issues`` (once per
    artefact). ``expected`` (id), ``found`` (id, issue); a null id is in no list."""
    ids = found.groupBy("id").agg(F.count_if("issue").alias("_issues"))
    j = expected.select("id").distinct().withColumn("_e", F.lit(True)).join(ids.withColumn("_g", F.lit(True)), "id", "full_outer").where("id IS NOT NULL")
    lists = F.concat(
        F.when(F.col("_g").isNull(), F.array(F.lit("missing_ids"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("_e").isNull(), F.array(F.lit("extra_ids"))).otherwise(F.array().cast("array<string>")),
    )
    named = j.select(F.explode(lists).alias("list"), "id")
    return named.unionByName(found.where(F.col("issue") & F.col("id").isNotNull()).select(F.lit("missing_file_issues").alias("list"), "id"))


@register(
    "audit_lists",
    f"""WITH ex AS (SELECT DISTINCT 'page-' || CAST(page_id AS VARCHAR) || '-v1' AS id FROM pages),
 f AS (SELECT coalesce(json_extract_string(meta, '$.id'), path) AS id, html IS NULL OR css IS NULL AS issue FROM {X.TEMPLATES_SQL})
SELECT 'missing_ids' AS list, id FROM (SELECT id FROM ex EXCEPT SELECT id FROM f)
UNION ALL SELECT 'extra_ids', id FROM (SELECT id FROM f EXCEPT SELECT id FROM ex)
UNION ALL SELECT 'missing_file_issues', id FROM f WHERE issue""",
)
def audit_lists(spark, sf):
    """G7's lists: expected ids (one spec a page) against the catalogue, written as a report (A9) and read back."""
    expected = table(spark, sf, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit("-v1")).alias("id"))
    found = X.templates(spark, sf).select(F.coalesce(F.get_json_object("meta", "$.id"), F.col("path")).alias("id"), K.files_missing("html", "css").alias("issue"))
    path = scratch_path(spark, "audit-lists")
    FS.write_lists(audit_rows(expected, found), path, ["list", "id"])
    return spark.read.schema("list string, id string").option("mode", "FAILFAST").json(path)
