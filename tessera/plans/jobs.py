"""End-to-end jobs a user calls (G1-G5), checked on their final tables.

Fixture: existing rows = even ``doc_id`` documents (label = lang); newly
generated rows = the string items of per-label raw batches built from the odd
documents (``plans.responses.raw_batches``). Random choices use the seeded md5
order (SURVEY §2.9(11)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.functions import text as T
from tessera.functions.fmt import fmt, sql_fmt
from tessera.operators.dedupe import append_if_absent, first_wins
from tessera.operators.ordering import hash_rank, seeded_key
from tessera.operators.sampling import numbered, smallest
from tessera.plans import fixtures as X
from tessera.plans import sql as S
from tessera.plans.catalog import sql_template_error
from tessera.plans.dataset import (
    BALANCE_KEPT,
    BALANCE_LABEL,
    BALANCE_TARGET,
    DOC_MAX,
    EXPECTED_LABELS,
    SEED,
    TARGET_PER_LABEL,
    _LABELS_SQL,
    category_gap_df,
    downsample_label,
    label_counts_with_zero_df,
    validate_clean,
)
from tessera.plans.registry import register
from tessera.plans.responses import items_sql, parse_string_batch, raw_batches, strict_json_valid
from tessera.session import checkpoint_dir, scratch_path
from tessera.sources import artefacts as AR
from tessera.sources import files as FS
from tessera.sources.tables import table

AUG_TARGETS = {"fr": 50, "de": 20}
# Retry budget and the final failure message.
MAX_ATTEMPTS = 4
MSG_GAVE_UP = "Failed after {attempts} attempts. Last error: {error}"
MSG_INVALID_JSON = "Invalid JSON"
MSG_TOP_KEYS_OF = "Missing required top-level keys ({keys})"
# Own message: a value that is no text.
MSG_NO_TEXT = "html and css must be text"


def _label_ord() -> F.Column:
    m = F.create_map(*[x for i, lab in enumerate(EXPECTED_LABELS) for x in (F.lit(lab), F.lit(i))])
    return F.coalesce(m[F.col("label")], F.lit(99))


_LABEL_ORD_SQL = "CASE label " + " ".join(f"WHEN '{lab}' THEN {i}" for i, lab in enumerate(EXPECTED_LABELS)) + " ELSE 99 END"


def existing_rows(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").where(F.col("doc_id") % 2 == 0)
    return d.select("text", F.col("lang").alias("label"), F.col("doc_id").alias("seq"))


def generated_items(spark, sf) -> DataFrame:
    """Distinct (label, item) pairs from the new batches (a set per category), with the item's seeded digest, which is the
    order key and, in place of the text, the shuffle key. Written once: samples read it more than once."""
    items = parse_string_batch(raw_batches(spark, sf, "doc_id % 2 = 1", by_label=True))
    path = scratch_path(spark, "items")
    items.select("label", "item", seeded_key(SEED, "item").alias("_h")).dropDuplicates(["label", "_h"]).write.parquet(path)
    return spark.read.parquet(path)


def _capped(items: DataFrame, quota, labels: list[str] | None = None) -> DataFrame:
    """The first items of every label in seeded order, numbered; ``quota`` as in ``sampling.smallest``."""
    items = items if labels is None else items.where(F.col("label").isin(labels))
    return numbered(smallest(items, "_h", quota), "_h").withColumn("seq", F.col("seq").cast("long"))


# --------------------------------------------------------------------------- G1
@register(
    "build_training_set",
    f"""WITH s AS (SELECT DISTINCT label, item FROM {items_sql('doc_id % 2 = 1', True)}),
 c AS (SELECT label, item, row_number() OVER (PARTITION BY label ORDER BY {S.md5_order(SEED, 'item')}, item) AS r FROM s),
 u AS (SELECT item AS text, label, 0 AS src_rank, {_LABEL_ORD_SQL} AS label_ord, CAST(r AS BIGINT) AS seq FROM c WHERE r <= {TARGET_PER_LABEL}
       UNION ALL SELECT text, lang AS label, 1, 0, doc_id FROM documents WHERE doc_id % 2 = 0),
 v AS (SELECT src_rank, label, label_ord, seq, {S.clean('text')} AS t FROM u WHERE {S.validate('text', 3, DOC_MAX)}),
 k AS (SELECT *, row_number() OVER (PARTITION BY {S.key('t')} ORDER BY src_rank, label_ord, seq) AS rn FROM v)
SELECT src_rank, label, seq, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM k WHERE rn = 1""",
)
def build_training_set(spark, sf):
    """G1: new items capped per label (E2) first, then existing rows (C7) ->
    validate (B8) -> clean (B9) -> first-wins dedupe (E1)."""
    capped = _capped(generated_items(spark, sf), TARGET_PER_LABEL)
    new = capped.select(F.col("item").alias("text"), "label", F.lit(0).alias("src_rank"), _label_ord().alias("label_ord"), "seq")
    old = existing_rows(spark, sf).select("text", "label", F.lit(1).alias("src_rank"), F.lit(0).alias("label_ord"), "seq")
    rows = validate_clean(new.unionByName(old), DOC_MAX)
    out = first_wins(rows, T.dedup_key("text"), ["src_rank", "label_ord", "seq"])
    return out.select("src_rank", "label", "seq", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


# --------------------------------------------------------------------------- G2
_GAP_SQL = f"""(SELECT l.label, coalesce(c.n, 0) AS existing, greatest(0, {TARGET_PER_LABEL} - coalesce(c.n, 0)) AS needed
  FROM {_LABELS_SQL} l LEFT JOIN (SELECT lang AS label, count(*) AS n FROM documents WHERE doc_id % 2 = 0 GROUP BY lang) c USING (label))"""


@register(
    "top_up",
    f"""WITH g AS {_GAP_SQL},
 s AS (SELECT DISTINCT label, item FROM {items_sql('doc_id % 2 = 1', True)}),
 c AS (SELECT s.label, item, row_number() OVER (PARTITION BY s.label ORDER BY {S.md5_order(SEED, 'item')}, item) AS r, g.needed
       FROM s JOIN g USING (label)),
 ex AS (SELECT text, lang AS label, doc_id AS seq FROM documents WHERE doc_id % 2 = 0),
 p0 AS (SELECT item AS text, label, 0 AS phase, {_LABEL_ORD_SQL} AS label_ord, CAST(r AS BIGINT) AS seq FROM c WHERE needed > 0 AND r <= needed
        UNION ALL SELECT text, label, 0, {_LABEL_ORD_SQL}, seq FROM ex WHERE label IN (SELECT label FROM g WHERE needed = 0)),
 ex1 AS (SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY seq) AS rr FROM ex),
 p1 AS (SELECT text, label, 1 AS phase, 0 AS label_ord, seq FROM ex1 WHERE rr = 1
        AND NOT EXISTS (SELECT 1 FROM p0 WHERE p0.text IS NOT DISTINCT FROM ex1.text AND p0.label IS NOT DISTINCT FROM ex1.label)),
 u AS (SELECT * FROM p0 UNION ALL SELECT * FROM p1),
 v AS (SELECT phase, label, label_ord, seq, {S.clean('text')} AS t FROM u WHERE {S.validate('text', 3, DOC_MAX)}),
 k AS (SELECT *, row_number() OVER (PARTITION BY {S.key('t')} ORDER BY phase, label_ord, seq) AS rn FROM v)
SELECT phase, label, seq, CAST(length(t) AS BIGINT) AS n_chars, md5(t) AS text_md5 FROM k WHERE rn = 1""",
)
def top_up(spark, sf):
    """Per category, full -> keep existing, else only the missing amount of new
    items (rank <= needed); then existing rows not yet collected (C6); then G1's
    validate / clean / dedupe."""
    ex = existing_rows(spark, sf)
    # one row per expected label (a fixed list): fetch it and use literals below
    needed = {r.label: r.needed for r in category_gap_df(spark, ex, TARGET_PER_LABEL).collect()}
    full_labels = [lab for lab, n in needed.items() if n == 0]
    quota = spark.createDataFrame([(lab, n) for lab, n in needed.items() if n > 0], "label string, quota long")
    new = _capped(generated_items(spark, sf), quota).select(
        F.col("item").alias("text"), "label", F.lit(0).alias("phase"), _label_ord().alias("label_ord"), "seq"
    )
    # at most TARGET rows per label: materialise once in the checkpoint folder, so
    # the batch parse is not run a second time for the anti-join below
    checkpoint_dir(spark)  # the cluster's shared folder (set only when the session names none)
    new = new.checkpoint()
    is_full = F.col("label").isin(full_labels) if full_labels else F.lit(False)
    full = ex.where(is_full).select("text", "label", F.lit(0).alias("phase"), _label_ord().alias("label_ord"), "seq")
    phase0 = new.unionByName(full)
    # Rows of full labels are all collected already; the others are kept once
    # unless equal (text and label) to a new row
    rest = append_if_absent(new, ex.where(~is_full), ["text", "label"], ["seq"]).select(
        "text", "label", F.lit(1).alias("phase"), F.lit(0).alias("label_ord"), "seq"
    )
    rows = validate_clean(phase0.unionByName(rest), DOC_MAX)
    out = first_wins(rows, T.dedup_key("text"), ["phase", "label_ord", "seq"])
    return out.select("phase", "label", "seq", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


# --------------------------------------------------------------------------- G3
_AUG_SQL_LABELS = ", ".join(f"('{k}', {v})" for k, v in AUG_TARGETS.items())


_AUG_ROWS_SQL = f"""WITH s AS (SELECT DISTINCT label, item FROM {items_sql('doc_id % 2 = 1', True)}),
 t AS (SELECT * FROM (VALUES {_AUG_SQL_LABELS}) v(label, target)),
 c AS (SELECT s.label, item, t.target, row_number() OVER (PARTITION BY s.label ORDER BY {S.md5_order(SEED, 'item')}, item) AS r
       FROM s JOIN t USING (label)),
 u AS (SELECT text, lang AS label, 0 AS src_rank, doc_id AS seq FROM documents WHERE doc_id % 2 = 0
       UNION ALL SELECT item, label, 1, r FROM c WHERE r <= target),
 k AS (SELECT label, src_rank, seq, text, row_number() OVER (PARTITION BY {S.key('text')} ORDER BY src_rank, seq) AS rn FROM u),
"""


def augmented(spark, sf) -> DataFrame:
    """Existing + capped new items (existing wins), de-duplicated on the raw
    text key (no cleaning)."""
    targets = spark.createDataFrame(list(AUG_TARGETS.items()), "label string, quota long")
    ranked = _capped(generated_items(spark, sf), targets, list(AUG_TARGETS))
    new = ranked.select(F.col("item").alias("text"), "label", F.lit(1).alias("src_rank"), "seq")
    old = existing_rows(spark, sf).select("text", "label", F.lit(0).alias("src_rank"), "seq")
    return first_wins(new.unionByName(old), T.dedup_key("text"), ["src_rank", "seq"])


@register(
    "augment",
    f"""{_AUG_ROWS_SQL} n AS (SELECT label, count(*) AS n FROM k WHERE rn = 1 GROUP BY label)
SELECT l.label, coalesce(n.n, 0) AS n FROM {_LABELS_SQL} l LEFT JOIN n USING (label)""",
)
def augment(spark, sf):
    """G3's report: rows of the augmented set, counted for the fixed label list."""
    return label_counts_with_zero_df(spark, augmented(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@register("augment_rows", f"{_AUG_ROWS_SQL.rstrip().rstrip(',')} SELECT src_rank, label, CAST(seq AS BIGINT) AS seq, md5(text) AS text_md5 FROM k WHERE rn = 1")
def augment_rows(spark, sf):
    """G3's data set as a user gets it: written (A2) and read back (A1), one row per example."""
    path = scratch_path(spark, "augmented")
    augmented(spark, sf).select("text", "label", "src_rank", "seq").write.json(path)
    back = spark.read.schema("text string, label string, src_rank int, seq long").option("mode", "FAILFAST").json(path)
    return back.select("src_rank", "label", "seq", F.md5("text").alias("text_md5"))


# --------------------------------------------------------------------------- G4
_BALANCED_SQL = f"""(SELECT doc_id, lang AS label, text FROM documents WHERE lang <> '{BALANCE_LABEL}' AND lang IN ({', '.join(repr(x) for x in BALANCE_KEPT)})
  UNION ALL SELECT doc_id, label, text FROM (SELECT doc_id, lang AS label, text FROM documents WHERE lang = '{BALANCE_LABEL}'
    ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id LIMIT {BALANCE_TARGET}))"""


def balanced(spark, sf) -> DataFrame:
    """JSONL in (A1) -> downsample one class (E3) -> seeded shuffle position (E4) -> JSONL out (A2) -> read back."""
    src, dst = scratch_path(spark, "balance-in"), scratch_path(spark, "balance-out")
    d = table(spark, sf, "documents").select("text", F.col("lang").alias("label"), "doc_id")
    d.write.json(src)
    data = spark.read.schema("text string, label string, doc_id long").option("mode", "FAILFAST").json(src)
    kept = downsample_label(data.withColumnRenamed("doc_id", "seq"), BALANCE_LABEL, BALANCE_TARGET, SEED, kept_labels=BALANCE_KEPT)
    placed = hash_rank(kept.withColumn("_h", seeded_key(SEED, "seq")), "_h", (), ["seq"], "position")
    # the shuffled order is also the file order of a range-partitioned, sorted write
    placed.orderBy("_h", "seq").select("text", "label", "position").write.json(dst)
    return spark.read.schema("text string, label string, position long").option("mode", "FAILFAST").json(dst)


@register("balance", f"SELECT label, count(*) AS n FROM {_BALANCED_SQL} GROUP BY label")
def balance(spark, sf):
    """G4's report: label histogram (D1) of what was written."""
    return balanced(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register(
    "balance_rows",
    f"""SELECT row_number() OVER (ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id) AS position, label, md5(text) AS text_md5 FROM {_BALANCED_SQL}""",
)
def balance_rows(spark, sf):
    """G4's data set as written: every kept example and its position in the shuffled order."""
    return balanced(spark, sf).select("position", "label", F.md5("text").alias("text_md5"))


# --------------------------------------------------------------------------- G5
def _json_str(c: str) -> F.Column:
    """A string as a JSON string literal (Spark's JSON writer)."""
    j = F.to_json(F.array(F.col(c)))
    return j.substr(F.lit(2), F.length(j) - 2)


def responses(spark, sf, done: DataFrame | None = None) -> DataFrame:
    """Up to 4 generated responses per remaining spec: broken JSON on attempt 1 for
    page_id % 4 = 1, fenced on 2, css key missing on 3, plain on 4."""
    t = X.templates(spark, sf)
    if done is not None:  # resume before anything is built for finished specs
        t = t.join(done, "spec_id", "left_anti")
    base = F.concat(
        F.lit('{"meta": '), "meta", F.lit(', "html": '), _json_str("html"),
        F.when(F.col("css").isNull(), F.lit("")).otherwise(F.concat(F.lit(', "css": '), _json_str("css"))), F.lit("}"),
    )
    no_css = F.concat(F.lit('{"meta": '), "meta", F.lit(', "html": '), _json_str("html"), F.lit("}"))
    payloads = F.array(
        F.when(F.col("page_id") % 4 == 1, F.concat(F.lit('{"meta": '), "meta")).otherwise(base),
        F.concat(F.lit("```json\n"), base, F.lit("\n```")),
        no_css,
        base,
    )
    return t.select("page_id", "spec_id", F.posexplode(payloads).alias("attempt", "raw")).withColumn("attempt", F.col("attempt") + 1)


def _first_error(files, valid: F.Column, keys: F.Column, rules: F.Column) -> F.Column:
    """B15's order: JSON (whole text) -> top-level keys (the columns ``files``) -> ``rules``."""
    has_all = F.forall(F.array(*[F.lit(c) for c in files]), lambda c: F.array_contains(keys, c))
    missing = MSG_TOP_KEYS_OF.format(keys="/".join(c for c in ("meta", "html", "css") if c in files))
    return F.when(~valid, F.lit(MSG_INVALID_JSON)).when(~F.coalesce(has_all, F.lit(False)), F.lit(missing)).otherwise(rules)


def _template_rules(meta, html, css) -> F.Column:
    """B13; a null html or css is no text."""
    return F.coalesce(F.when(html.isNull() | css.isNull(), F.lit(MSG_NO_TEXT)), K.template_error(meta, html, css))


def response_error(raw: str = "raw") -> F.Column:
    """B15 of a template response as one Column; ``parsed_templates`` is the form for whole tables."""
    cleaned = T.strip_code_fences(raw)
    rules = _template_rules(*[F.get_json_object(cleaned, f"$.{c}") for c in ("meta", "html", "css")])
    return _first_error(AR.TEMPLATE_FILES, strict_json_valid(cleaned), F.json_object_keys(cleaned), rules)


def _parsed(df: DataFrame, files, rules: F.Column) -> DataFrame:
    """The columns ``files`` of every response, and ``err``. Every step is a projection of its own, so that a response is
    cleaned and parsed once and not once per rule."""
    d = df.withColumn("_clean", T.strip_code_fences("raw")).drop("raw")
    d = d.withColumn("_valid", strict_json_valid(F.col("_clean"))).withColumn("_keys", F.json_object_keys("_clean"))
    d = d.select("*", *[F.get_json_object("_clean", f"$.{c}").alias(c) for c in files]).drop("_clean")
    return d.withColumn("err", _first_error(files, F.coalesce("_valid", F.lit(False)), F.col("_keys"), rules)).drop("_valid", "_keys")


def parsed_templates(df: DataFrame) -> DataFrame:
    """B15 with B13."""
    return _parsed(df, AR.TEMPLATE_FILES, _template_rules(F.col("meta"), F.col("html"), F.col("css")))


def parsed_effects(df: DataFrame) -> DataFrame:
    """B15 with B14; ``trigger`` is the one the spec asks for."""
    return _parsed(df, AR.EFFECT_FILES, K.effect_error("meta", "css", "trigger"))


def _sql_response_error():
    cleaned = (
        f"CASE WHEN starts_with({S.strip('raw')}, '```') THEN {S.strip(f'''regexp_replace(regexp_replace({S.strip('raw')}, '^```[a-zA-Z]*' || chr(10), ''), chr(10) || '```$', '')''')} "
        f"ELSE {S.strip('raw')} END"
    )
    return cleaned


_RESP_SQL = f"""(SELECT page_id, spec_id, attempt, raw FROM (
  SELECT page_id, spec_id, meta, html, css,
    '{{"meta": ' || meta || ', "html": ' || to_json(html)::VARCHAR || CASE WHEN css IS NULL THEN '' ELSE ', "css": ' || to_json(css)::VARCHAR END || '}}' AS base,
    '{{"meta": ' || meta || ', "html": ' || to_json(html)::VARCHAR || '}}' AS no_css FROM {X.TEMPLATES_SQL}) t,
  LATERAL (SELECT unnest([CASE WHEN page_id % 4 = 1 THEN '{{"meta": ' || meta ELSE base END,
                          '```json' || chr(10) || base || chr(10) || '```', no_css, base]) AS raw,
                  unnest([1, 2, 3, 4]) AS attempt))"""

_PARSED_SQL = f"""(SELECT page_id, spec_id, attempt, cleaned,
   CASE WHEN json_valid(cleaned) THEN json_extract(cleaned, '$.meta')::VARCHAR END AS meta,
   CASE WHEN json_valid(cleaned) THEN json_extract_string(cleaned, '$.html') END AS html,
   CASE WHEN json_valid(cleaned) THEN json_extract_string(cleaned, '$.css') END AS css,
   json_valid(cleaned) AS ok_json,
   CASE WHEN json_valid(cleaned) THEN list_contains(json_keys(cleaned), 'meta') AND list_contains(json_keys(cleaned), 'html')
     AND list_contains(json_keys(cleaned), 'css') ELSE false END AS ok_keys
 FROM (SELECT page_id, spec_id, attempt, {_sql_response_error()} AS cleaned FROM {_RESP_SQL}))"""


@register(
    "ingest_generated",
    f"""WITH e AS (SELECT page_id, spec_id, attempt,
    CASE WHEN NOT ok_json THEN '{MSG_INVALID_JSON}' WHEN NOT ok_keys THEN '{K.MSG_TOP_KEYS}' ELSE error END AS err
  FROM {sql_template_error(_PARSED_SQL)}),
 r AS (SELECT * FROM e WHERE page_id % 9 <> 0 AND attempt <= {MAX_ATTEMPTS}),
 g AS (SELECT spec_id, min(CASE WHEN err IS NULL THEN attempt END) AS first_ok, max_by(err, attempt) AS last_err FROM r GROUP BY spec_id)
SELECT spec_id, CASE WHEN first_ok IS NULL THEN 'failed' ELSE 'saved' END AS status, CAST(first_ok AS BIGINT) AS attempt_used,
  CASE WHEN first_ok IS NULL THEN {sql_fmt(MSG_GAVE_UP, attempts=str(MAX_ATTEMPTS), error='last_err')} END AS error FROM g""",
)
def ingest_generated(spark, sf):
    """Resume (C1 against the progress log, A7) -> per spec the first valid of
    up to 4 responses (B15); specs with none get the last error (A8 form)."""
    progress = scratch_path(spark, "progress")
    done = X.templates(spark, sf).where(F.col("page_id") % 9 == 0).select(F.col("spec_id").alias("id"))
    FS.append_log(done, progress)
    completed = FS.completed_ids(spark, progress).withColumnRenamed("id", "spec_id")
    r = responses(spark, sf, completed).where(F.col("attempt") <= MAX_ATTEMPTS)
    e = parsed_templates(r.select("spec_id", "attempt", "raw"))
    g = e.groupBy("spec_id").agg(
        F.min(F.when(F.col("err").isNull(), F.col("attempt"))).alias("first_ok"), F.max_by("err", "attempt").alias("last_err")
    )
    return g.select(
        "spec_id",
        F.when(F.col("first_ok").isNull(), "failed").otherwise("saved").alias("status"),
        F.col("first_ok").cast("long").alias("attempt_used"),
        F.when(F.col("first_ok").isNull(), fmt(MSG_GAVE_UP, attempts=MAX_ATTEMPTS, error=F.col("last_err"))).alias("error"),
    )
