"""Labelled-dataset jobs (G1-G4) and their building blocks as registered queries.

Fixture mapping (FIXTURES.md §3): ``documents`` is the labelled set with
``label = lang`` and ``seq = doc_id``; odd ``doc_id`` = newly generated rows,
even = existing rows; ``benchmark`` is the curated list (label 'en').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.dedupe import append_absent_text, append_if_absent, first_wins, ordered_union
from tessera.operators.ordering import hash_rank, seeded_key
from tessera.operators.sampling import marked, smallest
from tessera.plans import sql as S
from tessera.plans.registry import register
from tessera.sources.tables import table

# Parameters of the fixture queries. Documents are prose, not short requests: no ceiling.
DOC_MAX = None
SEED = 42
EXPECTED_LABELS = ["de", "en", "es", "fr", "it"]
TARGET_PER_LABEL = 400
BATCH, ATTEMPT_FACTOR = 25, 3
CAP_PER_LABEL = 50
BALANCE_LABEL, BALANCE_TARGET = "en", 300
BALANCE_KEPT = ["de", "en", "fr"]  # classes that a balanced set holds
VAL_FRACTION_PCT = 15


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """M1 labelled examples: text, label, seq."""
    d = table(spark, sf, "documents")
    return d.select("text", F.col("lang").alias("label"), F.col("doc_id").alias("seq"))


def validate_clean(df: DataFrame, max_len: int | None = 200) -> DataFrame:
    """B8 then B9: validation sees the raw text, cleaning runs on valid rows only."""
    return df.where(T.validate_text("text", 3, max_len)).withColumn("text", T.clean_text("text"))


def build_training_set(new: DataFrame, existing: DataFrame, max_len: int | None = 200) -> DataFrame:
    """G1: new ∪ existing (new wins) -> validate -> clean -> first-wins dedupe."""
    rows = validate_clean(ordered_union(new, existing), max_len)
    return first_wins(rows, T.dedup_key("text"), ["src_rank", "seq"])


# --------------------------------------------------------------------------- flagship
def clean_dedupe_documents(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    v = d.where(T.validate_text("text", 3, DOC_MAX)).select("doc_id", "lang", T.clean_text("text").alias("t"))
    # Only (lang, length) of the winner travels through the shuffle.
    w = first_wins(
        v.select("doc_id", "lang", "t", F.length("t").alias("n")), T.dedup_key("t"), ["doc_id"], ["lang", "n"]
    )
    return w.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").cast("long").alias("n_chars"))


register(
    "clean_dedupe_documents",
    f"""
WITH c AS (SELECT doc_id, lang, {S.clean('text')} AS t FROM documents WHERE {S.validate('text', 3, DOC_MAX)}),
     k AS (SELECT lang, t, row_number() OVER (PARTITION BY {S.key('t')} ORDER BY doc_id) rn FROM c)
SELECT lang, count(*) AS n_docs, CAST(sum(length(t)) AS BIGINT) AS n_chars FROM k WHERE rn = 1 GROUP BY lang
""",
)(clean_dedupe_documents)


@register(
    "clean_conversations",
    f"SELECT conv_id, turn, role, {S.clean('text')} AS text FROM conversations WHERE {S.validate('text')}",
)
def clean_conversations(spark, sf):
    c = table(spark, sf, "conversations")
    return c.where(T.validate_text("text")).select("conv_id", "turn", "role", T.clean_text("text").alias("text"))


@register(
    "cleaning_counters",
    f"""
WITH v AS (SELECT {S.validate('text')} AS ok, text FROM conversations),
     a AS (SELECT count(*) AS n_input, count_if(ok) AS n_valid,
                  count(DISTINCT CASE WHEN ok THEN {S.key(S.clean('text'))} END) AS n_unique FROM v)
SELECT n_input, n_valid, n_input - n_valid AS n_invalid, n_valid - n_unique AS n_duplicates, n_unique FROM a
""",
)
def cleaning_counters(spark, sf):
    c = table(spark, sf, "conversations").select(T.validate_text("text").alias("ok"), "text")
    key = F.when(F.col("ok"), F.sha2(T.dedup_key(T.clean_text("text")), 256))
    a = c.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if("ok").alias("n_valid"),
        F.countDistinct(key).alias("n_unique"),
    )
    return a.select(
        "n_input",
        "n_valid",
        (F.col("n_input") - F.col("n_valid")).alias("n_invalid"),
        (F.col("n_valid") - F.col("n_unique")).alias("n_duplicates"),
        "n_unique",
    )


@register("label_histogram", "SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang ORDER BY label")
def label_histogram(spark, sf):
    return examples(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label")


def _labels_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in EXPECTED_LABELS], "label string")


_LABELS_SQL = "(SELECT unnest([" + ", ".join(f"'{x}'" for x in EXPECTED_LABELS) + "]) AS label)"


def label_counts_with_zero_df(spark, counts: DataFrame) -> DataFrame:
    """Counts for a fixed label list, zeros included (dimension is broadcast)."""
    return F.broadcast(_labels_dim(spark)).join(counts, "label", "left").select(
        "label", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


@register(
    "label_counts_with_zero",
    f"""
SELECT l.label, coalesce(c.n, 0) AS n FROM {_LABELS_SQL} l
LEFT JOIN (SELECT lang AS label, count(*) AS n FROM documents WHERE {S.validate('text', 3, DOC_MAX)} GROUP BY lang) c
ON l.label = c.label
""",
)
def label_counts_with_zero(spark, sf):
    v = examples(spark, sf).where(T.validate_text("text", 3, DOC_MAX))
    return label_counts_with_zero_df(spark, v.groupBy("label").agg(F.count(F.lit(1)).alias("n")))


def category_gap_df(spark, existing: DataFrame, target: int) -> DataFrame:
    """D3: needed = max(0, target - existing) per expected label."""
    counts = existing.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    c = label_counts_with_zero_df(spark, counts)
    return c.select(
        "label", F.col("n").alias("existing"), F.greatest(F.lit(0), F.lit(target) - F.col("n")).cast("long").alias("needed")
    )


_GAP_SQL = f"""
SELECT l.label, coalesce(c.n, 0) AS existing, greatest(0, {TARGET_PER_LABEL} - coalesce(c.n, 0)) AS needed
FROM {_LABELS_SQL} l LEFT JOIN (SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang) c
ON l.label = c.label
"""


@register("category_gap", _GAP_SQL)
def category_gap(spark, sf):
    return category_gap_df(spark, examples(spark, sf), TARGET_PER_LABEL)


def generation_plan_df(gap: DataFrame, batch: int, factor: int) -> DataFrame:
    """Batches needed and the attempt cap ``(needed // batch) * factor``; the cap
    is 0 when needed < batch, so such gaps are never filled (``starved``)."""
    cap = (F.floor(F.col("needed") / batch) * factor).cast("long")
    return gap.select(
        "label",
        "needed",
        F.ceil(F.col("needed") / batch).cast("long").alias("n_batches"),
        cap.alias("max_attempts"),
        ((F.col("needed") > 0) & (cap == 0)).alias("starved"),
    )


@register(
    "generation_plan",
    f"""
WITH g AS ({_GAP_SQL})
SELECT label, needed, CAST(ceil(needed / {BATCH}) AS BIGINT) AS n_batches,
       CAST(floor(needed / {BATCH}) * {ATTEMPT_FACTOR} AS BIGINT) AS max_attempts,
       (needed > 0 AND floor(needed / {BATCH}) * {ATTEMPT_FACTOR} = 0) AS starved
FROM g
""",
)
def generation_plan(spark, sf):
    return generation_plan_df(category_gap(spark, sf), BATCH, ATTEMPT_FACTOR)


@register(
    "union_new_first",
    f"""
WITH u AS (SELECT doc_id, lang, text, CASE WHEN doc_id % 2 = 1 THEN 0 ELSE 1 END AS src_rank FROM documents),
     c AS (SELECT doc_id, lang, src_rank, {S.clean('text')} AS t FROM u WHERE {S.validate('text', 3, DOC_MAX)}),
     k AS (SELECT *, row_number() OVER (PARTITION BY {S.key('t')} ORDER BY src_rank, doc_id) rn FROM c)
SELECT doc_id, lang AS label, src_rank, length(t) AS n_chars FROM k WHERE rn = 1
""",
)
def union_new_first(spark, sf):
    ex = examples(spark, sf)
    out = build_training_set(ex.where(F.col("seq") % 2 == 1), ex.where(F.col("seq") % 2 == 0), DOC_MAX)
    return out.select(
        F.col("seq").alias("doc_id"), "label", F.col("src_rank").cast("int"), F.length("text").cast("long").alias("n_chars")
    )


@register(
    "union_existing_first",
    f"""
WITH u AS (SELECT doc_id, lang, text, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS src_rank FROM documents),
     k AS (SELECT *, row_number() OVER (PARTITION BY {S.key('text')} ORDER BY src_rank, doc_id) rn FROM u)
SELECT doc_id, lang AS label, src_rank FROM k WHERE rn = 1
""",
)
def union_existing_first(spark, sf):
    """G3 core: existing + new, existing wins, dedupe on the raw (uncleaned) key."""
    ex = examples(spark, sf)
    u = ordered_union(ex.where(F.col("seq") % 2 == 0), ex.where(F.col("seq") % 2 == 1))
    out = first_wins(u, T.dedup_key("text"), ["src_rank", "seq"], ["seq", "label", "src_rank"])
    return out.select(F.col("seq").alias("doc_id"), "label", F.col("src_rank").cast("int"))


def _curated(spark, sf) -> DataFrame:
    b = table(spark, sf, "benchmark")
    return b.select("text", F.lit("en").alias("label"), F.col("item_id").alias("seq"))


@register(
    "targeted_append",
    """
WITH cur AS (SELECT item_id, text, row_number() OVER (PARTITION BY text ORDER BY item_id) rn FROM benchmark),
     added AS (SELECT item_id FROM cur WHERE rn = 1 AND text NOT IN (SELECT text FROM documents WHERE text IS NOT NULL))
SELECT 'base' AS src, doc_id AS id, lang AS label FROM documents
UNION ALL SELECT 'curated' AS src, item_id AS id, 'en' AS label FROM added
""",
)
def targeted_append(spark, sf):
    base = examples(spark, sf)
    added = append_absent_text(base, _curated(spark, sf), "text", ["seq"])
    return base.select(F.lit("base").alias("src"), F.col("seq").alias("id"), "label").unionByName(
        added.select(F.lit("curated").alias("src"), F.col("seq").alias("id"), "label")
    )


@register(
    "append_if_absent",
    """
WITH col AS (SELECT doc_id, text, lang FROM documents WHERE doc_id % 2 = 1),
     ex AS (SELECT doc_id, text, lang, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) rn FROM documents),
     add AS (SELECT doc_id, lang FROM ex WHERE rn = 1
             AND NOT EXISTS (SELECT 1 FROM col WHERE col.text IS NOT DISTINCT FROM ex.text
                                                AND col.lang IS NOT DISTINCT FROM ex.lang))
SELECT 'collected' AS src, doc_id, lang AS label FROM col
UNION ALL SELECT 'existing' AS src, doc_id, lang AS label FROM add
""",
)
def append_if_absent_q(spark, sf):
    """G2 tail: collected rows, then existing rows not already collected (whole-row test)."""
    ex = examples(spark, sf)
    collected = ex.where(F.col("seq") % 2 == 1)
    add = append_if_absent(collected, ex, ["text", "label"], ["seq"])
    return collected.select(F.lit("collected").alias("src"), F.col("seq").alias("doc_id"), "label").unionByName(
        add.select(F.lit("existing").alias("src"), F.col("seq").alias("doc_id"), "label")
    )


def cap_per_label_df(df: DataFrame, n: int, seed, key_col: str = "seq") -> DataFrame:
    """At most n rows per label, the n smallest seeded hashes, cut off where they are read."""
    return smallest(df.withColumn("_h", seeded_key(seed, key_col)), "_h", n, ["label"], [key_col]).drop("_h")


@register(
    "cap_per_label",
    f"""
SELECT doc_id, label FROM (
  SELECT doc_id, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id) rn
  FROM documents) WHERE rn <= {CAP_PER_LABEL}
""",
)
def cap_per_label(spark, sf):
    ex = examples(spark, sf).select("seq", "label")
    return cap_per_label_df(ex, CAP_PER_LABEL, SEED).select(F.col("seq").alias("doc_id"), "label")


def downsample_label(df: DataFrame, label: str, target: int, seed, key_col: str = "seq", kept_labels: list[str] | None = None) -> DataFrame:
    """Exactly ``target`` rows of ``label`` (smallest seeded hashes) when it has
    more; of the others only ``kept_labels``, whole (None: all others, null labels too). Rows of the big class are cut off
    where they are read, so it never sits in one task."""
    big = df.where(F.col("label") == label).withColumn("_h", seeded_key(seed, key_col))
    kept = smallest(big, "_h", target, ["label"], [key_col]).drop("_h")
    other = ~F.col("label").eqNullSafe(label)
    if kept_labels is not None:
        other = other & F.col("label").isin(kept_labels)
    return df.where(other).unionByName(kept)


_BAL_SQL = f"""
SELECT doc_id, lang AS label FROM documents WHERE lang <> '{BALANCE_LABEL}' AND lang IN ({', '.join(repr(x) for x in BALANCE_KEPT)})
UNION ALL
SELECT doc_id, label FROM (SELECT doc_id, lang AS label FROM documents WHERE lang = '{BALANCE_LABEL}'
  ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id LIMIT {BALANCE_TARGET})
"""


@register("balance_downsample", _BAL_SQL)
def balance_downsample(spark, sf):
    ex = examples(spark, sf).select("seq", "label")
    return downsample_label(ex, BALANCE_LABEL, BALANCE_TARGET, SEED, kept_labels=BALANCE_KEPT).select(F.col("seq").alias("doc_id"), "label")


@register(
    "seeded_shuffle_rank",
    f"""
SELECT doc_id, label, row_number() OVER (ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id) AS position
FROM ({_BAL_SQL})
""",
)
def seeded_shuffle_rank(spark, sf):
    """Seeded shuffle of the balanced set as an explicit position column."""
    b = balance_downsample(spark, sf).withColumn("_h", seeded_key(SEED, "doc_id"))
    return hash_rank(b, "_h", (), ["doc_id"], "position").drop("_h")


def stratified_split_df(df: DataFrame, pct: int, seed, key_col: str = "seq") -> DataFrame:
    """Validation size ceil(pct% of n); per-label quota floor(n_val*n_c/n) plus one
    for the labels with the largest remainders (ties: label asc); inside a label the
    rows with the smallest seeded hashes go to validation. All integer arithmetic."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n_c"))
    tot = Window.partitionBy()
    q = counts.withColumn("n", F.sum("n_c").over(tot)).withColumn(
        "n_val", F.expr(f"CAST((n * {pct} + 99) DIV 100 AS BIGINT)")
    )
    q = q.withColumn("base", F.expr("(n_val * n_c) DIV n")).withColumn("rem", F.expr("(n_val * n_c) % n"))
    q = q.withColumn("short", F.col("n_val") - F.sum("base").over(tot))
    q = q.withColumn("rr", F.row_number().over(Window.orderBy(F.desc("rem"), "label")))
    quota = q.select("label", (F.col("base") + F.when(F.col("rr") <= F.col("short"), 1).otherwise(0)).alias("quota"))
    taken = marked(df.withColumn("_h", seeded_key(seed, key_col)), "_h", quota, ["label"], [key_col])
    return taken.withColumn("split", F.when(F.col("_in"), "val").otherwise("train")).drop("_h", "_in")


@register(
    "stratified_split",
    f"""
WITH c AS (SELECT lang AS label, count(*) AS n_c FROM documents GROUP BY lang),
     t AS (SELECT sum(n_c) AS n, CAST((sum(n_c) * {VAL_FRACTION_PCT} + 99) // 100 AS BIGINT) AS n_val FROM c),
     b AS (SELECT label, (n_val * n_c) // n AS base, (n_val * n_c) % n AS rem, n_val FROM c, t),
     s AS (SELECT *, n_val - sum(base) OVER () AS short, row_number() OVER (ORDER BY rem DESC, label) rr FROM b),
     q AS (SELECT label, base + CASE WHEN rr <= short THEN 1 ELSE 0 END AS quota FROM s),
     r AS (SELECT doc_id, lang AS label,
                  row_number() OVER (PARTITION BY lang ORDER BY {S.md5_order(SEED, 'CAST(doc_id AS VARCHAR)')}, doc_id) rk
           FROM documents)
SELECT r.doc_id, r.label, CASE WHEN rk <= quota THEN 'val' ELSE 'train' END AS split FROM r JOIN q USING (label)
""",
)
def stratified_split(spark, sf):
    ex = examples(spark, sf).select("seq", "label")
    return stratified_split_df(ex, VAL_FRACTION_PCT, SEED).select(F.col("seq").alias("doc_id"), "label", "split")
