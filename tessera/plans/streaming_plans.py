"""Streaming queries (H1-H4): each lands its input as ordered files (one parallel job) in a
fresh folder under the checkpoint directory, drains it with ``availableNow`` and
returns the sink as a table.

Contract (the reference is silent on lateness): watermark 10 minutes; in append
mode a window is emitted once the watermark passes its end, so the result equals
the batch counts over windows that end at or before ``max(ts) - 10 minutes``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.plans import fixtures as X
from tessera.plans import sql as S
from tessera.plans.catalog import _REVIEW_SQL, review_gate_df
from tessera.plans.dataset import DOC_MAX
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import events, table
from tessera.streaming import core as SC

BATCHES = 4  # micro-batches that a landed table is taken in


def _landed_events(spark, sf):
    root = scratch_path(spark, "events-landing")
    e = events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    n = SC.land_in_order(e, root, "ts")
    return SC.file_stream(spark, root, e.schema, -(-n // BATCHES))


_WM = "(SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events)"


@register(
    "stream_rate",
    f"""WITH s AS (SELECT user_id, time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k) AS ws
               FROM events, range(0, 6) r(k)),
     c AS (SELECT ws, user_id, count(*) AS n FROM s, {_WM} w
           WHERE s.ws <= (SELECT max(ts) FROM events) AND ws + INTERVAL 60 SECOND <= w.wm GROUP BY ws, user_id)
SELECT ws AS window_start, ws + INTERVAL 60 SECOND AS window_end, user_id, n FROM c""",
)
def stream_rate(spark, sf):
    """H2: 60 s sliding (10 s) counts per user from a file stream."""
    agg = SC.minute_rate(_landed_events(spark, sf), "user_id", "ts")
    sink, ckpt = scratch_path(spark, "rate-sink"), scratch_path(spark, "rate-ckpt")
    SC.run_available_now(agg, sink, ckpt)
    out = spark.read.parquet(sink)
    return out.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "user_id",
        "n",
    )


@register(
    "stream_quota",
    f"""SELECT date_trunc('day', ts) AS window_start, user_id, count(*) AS n FROM events, {_WM} w
GROUP BY 1, 2, w.wm HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= w.wm""",
)
def stream_quota(spark, sf):
    """H3: daily counts per user from a file stream."""
    agg = SC.daily_quota(_landed_events(spark, sf), "user_id", "ts")
    sink, ckpt = scratch_path(spark, "quota-sink"), scratch_path(spark, "quota-ckpt")
    SC.run_available_now(agg, sink, ckpt)
    out = spark.read.parquet(sink)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "user_id", "n")


@register(
    "stream_dedupe",
    f"""WITH c AS (SELECT doc_id, lang, {S.clean('text')} AS t FROM documents WHERE {S.validate('text', 3, DOC_MAX)}),
     k AS (SELECT doc_id, lang, t, row_number() OVER (PARTITION BY {S.key('t')} ORDER BY doc_id) rn FROM c)
SELECT doc_id, lang, CAST(length(t) AS BIGINT) AS n_chars FROM k WHERE rn = 1""",
)
def stream_dedupe(spark, sf):
    """H1: arriving documents validated and cleaned; the first arrival per key is kept
    across all micro-batches (files land in doc_id order)."""
    root = scratch_path(spark, "docs-landing")
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    n = SC.land_in_order(d, root, "doc_id")
    s = SC.file_stream(spark, root, d.schema, -(-n // BATCHES))
    v = s.where(T.validate_text("text", 3, DOC_MAX)).select("doc_id", "lang", T.clean_text("text").alias("t"))
    v = v.select("doc_id", "lang", "t", F.length("t").cast("long").alias("n_chars"))
    target, ckpt = scratch_path(spark, "dedupe-target"), scratch_path(spark, "dedupe-ckpt")
    SC.dedupe_into(v, target, ckpt, T.dedup_key("t"), ["doc_id"], ["doc_id", "lang", "n_chars"])
    return spark.read.parquet(target).select("doc_id", "lang", "n_chars")


@register("stream_resume", f"SELECT page_id, id, path, status, error FROM {_REVIEW_SQL}")
def stream_resume(spark, sf):
    """H4: review gate over a file stream of templates, stopped and restarted on the
    same checkpoint; the second run processes only the newly landed files."""
    t = X.templates(spark, sf)
    root = scratch_path(spark, "tpl-landing")
    sink, ckpt = scratch_path(spark, "review-sink"), scratch_path(spark, "review-ckpt")
    cut = t.approxQuantile("page_id", [0.66], 0.001)[0]
    first, rest = t.where(F.col("page_id") <= cut), t.where(F.col("page_id") > cut)
    for part in (first, rest):
        n = SC.land_in_order(part, root, "page_id")
        SC.run_available_now(review_gate_df(SC.file_stream(spark, root, t.schema, -(-n // 2))), sink, ckpt)
    return spark.read.parquet(sink)
