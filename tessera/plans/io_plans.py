"""I/O queries: JSONL round trip (A1/A2), catalogue tree (A3/A4), archive ingest
(A6/G12 with C2), dataset card (A10), progress and failure logs (A7/A8).

Each query writes to a fresh folder under the session's checkpoint directory
(the shared folder a cluster names in ``spark.checkpoint.dir``) and returns what
Spark reads back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.plans import fixtures as X
from tessera.plans.catalog import _ENTRIES_SQL, UPLOADED_PREFIX, sql_template_error
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources import archive as A
from tessera.sources import files as FS
from tessera.sources.tables import table

CARD_STAMP = "1970-01-01_00-00-00"  # fixed so the card is reproducible


@register("jsonl_roundtrip", "SELECT md5(text) AS text_md5, lang AS label FROM documents")
def jsonl_roundtrip(spark, sf):
    """A2 then A1: write (text, label) JSONL, read it back strictly."""
    path = scratch_path(spark, "jsonl")
    FS.write_labelled(table(spark, sf, "documents").select("text", F.col("lang").alias("label")), path)
    back = FS.read_labelled(spark, path)
    return back.select(F.md5("text").alias("text_md5"), "label")


_CATALOG_SQL = f"""SELECT coalesce(json_extract_string(meta, '$.id'), path) AS id, path, md5(meta) AS meta_md5,
  md5(html) AS html_md5, md5(css) AS css_md5, (html IS NULL OR css IS NULL) AS files_missing FROM {X.TEMPLATES_SQL}"""


def _catalogue_view(s):
    return s.select(
        F.coalesce(F.get_json_object("meta", "$.id"), F.col("path")).alias("id"),
        "path",
        F.md5("meta").alias("meta_md5"),
        F.md5("html").alias("html_md5"),
        F.md5("css").alias("css_md5"),
        K.files_missing("html", "css").alias("files_missing"),
    )


@register("catalog_scan", _CATALOG_SQL)
def catalog_scan(spark, sf):
    """A4 tree form (folder per spec: category/spec_id with meta.json, index.html,
    style.css, written by the tasks) then A3 (recursive scan, siblings joined)."""
    root = scratch_path(spark, "catalogue-tree")
    t = X.templates(spark, sf).withColumn("category", F.lit("site"))
    FS.write_catalogue_tree(t, root).count()  # action: the tasks write the tree
    return _catalogue_view(FS.scan_catalogue_tree(spark, root))


@register("catalog_table", _CATALOG_SQL)
def catalog_table(spark, sf):
    """A4 Spark-native form: parquet partitioned by category, read back."""
    root = scratch_path(spark, "catalogue-table")
    FS.write_catalogue(X.templates(spark, sf).withColumn("category", F.lit("site")), root)
    return _catalogue_view(FS.read_catalogue(spark, root))


def page_entries(spark, sf):
    """Archive entries from pages: ``p{page_id}/{url path}`` holding the html."""
    p = table(spark, sf, "pages")
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]+/", ""), "[?#].*$", "")
    return p.select(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit("/"), path).alias("entry"), F.col("html").alias("content"))


@register(
    "archive_entries",
    f"""SELECT 'p' || CAST(e.page_id AS VARCHAR) || '/' || e.entry AS entry, e.base_name,
  CAST(octet_length(encode(p.html)) AS BIGINT) AS n_bytes, md5(p.html) AS content_md5
FROM {_ENTRIES_SQL} e JOIN pages p USING (page_id)
WHERE NOT ends_with(e.entry, '/') AND e.base_name NOT IN
  (SELECT base_name FROM {_ENTRIES_SQL} WHERE starts_with(entry, '{UPLOADED_PREFIX}') AND NOT ends_with(entry, '/'))""",
)
def archive_entries(spark, sf):
    """Write the pages as zip archives, list their entries, skip directories
    and base names already uploaded (under the prefix), read the rest. A corrupt
    archive or entry ends the query with its message: the result has no error column."""
    root = scratch_path(spark, "archives")
    # written once: what is listed below must not be a plan that writes again
    written = A.write_archives(page_entries(spark, sf), root).select("archive")
    listing = scratch_path(spark, "archive-list")
    written.write.parquet(listing)
    archives = spark.read.parquet(listing)
    entries = A.list_entries(archives, strict=True)
    files = entries.where(~F.col("is_dir"))
    # path inside the page folder, then its base name (C2 matches base names only)
    inner = F.regexp_replace("entry", "^p[0-9]+/", "")
    named = files.withColumn("inner", inner).withColumn("base_name", F.element_at(F.split("inner", "/"), -1))
    uploaded = named.where(F.col("inner").startswith(UPLOADED_PREFIX)).select("base_name").distinct()
    todo = named.join(uploaded, "base_name", "left_anti").drop("inner", "base_name")
    got = A.read_entries(todo, strict=True)
    return got.select("entry", "base_name", "n_bytes", "content_md5")


@register(
    "dataset_card",
    f"""SELECT '# Classifier Training Data' || chr(10) || chr(10) || '## Overview' || chr(10) || '- Total: ' || format('{{:,}}', sum(n)) || chr(10)
  || '- Generated: {CARD_STAMP}' || chr(10)
  || string_agg('- **' || label || ':** ' || format('{{:,}}', n) || chr(10), '' ORDER BY label)
  || chr(10) || '## Format' || chr(10) || '```json' || chr(10) || '{{"text": "user request", "label": "category"}}' || chr(10) || '```' || chr(10) AS card
FROM (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang)""",
)
def dataset_card(spark, sf):
    """A10 for the labelled documents."""
    d = table(spark, sf, "documents").select(F.col("lang").alias("label"))
    return FS.dataset_card(d, CARD_STAMP)


@register(
    "failure_log",
    f"SELECT spec_id AS id, error FROM {sql_template_error(X.TEMPLATES_SQL + ' WHERE html IS NOT NULL AND css IS NOT NULL')} WHERE error IS NOT NULL",
)
def failure_log(spark, sf):
    """A8 + A7: validation failures appended (with timestamp) to a failure log and
    passing ids to the progress log; read back (timestamp dropped for the check)."""
    base = scratch_path(spark, "logs")
    t = X.templates(spark, sf).where(F.col("html").isNotNull() & F.col("css").isNotNull())
    # validated once into a written table; both logs read that
    t.select(F.col("spec_id").alias("id"), K.template_error("meta", "html", "css").alias("error")).write.parquet(f"{base}/verdicts")
    v = spark.read.parquet(f"{base}/verdicts")
    FS.append_log(FS.failure_rows(v), f"{base}/failures")
    FS.append_log(v.where(F.col("error").isNull()).select("id"), f"{base}/progress")
    done = FS.completed_ids(spark, f"{base}/progress")
    fails = FS.read_log(spark, f"{base}/failures", "id string, error string, timestamp timestamp")
    # a failed id is never also completed
    return fails.join(done, "id", "left_anti").select("id", "error")
