"""Evaluation queries over prediction pairs.

Pairs: ``labels ⋈ documents``; expected = ``lang``; got = a stop-word rule on the
text (a cheap text classifier standing in for the model's predictions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.plans.registry import register
from tessera.sources.tables import table

# Fixed values of the fixture rule: a stop word per language, checked in order.
STOP_WORDS = [("en", " the "), ("fr", " les "), ("de", " der "), ("es", " los ")]
CLASS_ORDER = ["de", "en", "es", "fr"]
KNOWN_MISS_SOURCES = ["src3", "src7"]


def guess_lang(text_col: str = "text"):
    c = F.col(text_col)
    expr = None
    for lang, w in STOP_WORDS:
        expr = F.when(c.contains(w), lang) if expr is None else expr.when(c.contains(w), lang)
    return expr.otherwise("unknown")


_GUESS_SQL = "CASE " + " ".join(f"WHEN contains(d.text, '{w}') THEN '{l}'" for l, w in STOP_WORDS) + " ELSE 'unknown' END"
PAIRS_SQL = f"(SELECT d.doc_id, d.source, d.lang AS expected, {_GUESS_SQL} AS got FROM labels l JOIN documents d USING (doc_id))"


def pairs(spark, sf) -> DataFrame:
    lab = table(spark, sf, "labels").select("doc_id")
    # the guess is made in the scan, so no text crosses the join
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("lang").alias("expected"), guess_lang().alias("got"))
    return lab.join(docs, "doc_id")


@register(
    "label_encoder",
    "SELECT lang AS label, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS BIGINT) AS label_index, count(*) AS n "
    "FROM documents GROUP BY lang",
)
def label_encoder(spark, sf):
    d = table(spark, sf, "documents").select(F.col("lang").alias("label"))
    return E.label_encoder(d)


@register("confusion", f"SELECT expected, got, count(*) AS n FROM {PAIRS_SQL} GROUP BY expected, got")
def confusion(spark, sf):
    return E.confusion(pairs(spark, sf))


@register(
    "accuracy",
    f"""
WITH a AS (SELECT count_if(expected = got) AS n_correct, count(*) AS n_total FROM {PAIRS_SQL})
SELECT n_correct, n_total, round(n_correct / n_total, 6) AS accuracy,
       n_correct || '/' || n_total || ' (' || CAST(round_even(n_correct * 100.0 / n_total, 0) AS BIGINT) || '%)' AS summary
FROM a
""",
)
def accuracy(spark, sf):
    return E.accuracy(pairs(spark, sf))


@register(
    "classification_report",
    f"""
WITH p AS {PAIRS_SQL},
cls AS (SELECT expected AS c FROM p UNION SELECT got FROM p),
m AS (SELECT c AS class,
        (SELECT count(*) FROM p WHERE expected = c) AS support,
        (SELECT count(*) FROM p WHERE got = c) AS pred,
        (SELECT count(*) FROM p WHERE got = c AND expected = c) AS tp FROM cls),
r AS (SELECT class,
        CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS precision,
        CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + (pred - tp) + (support - tp) > 0 THEN 2 * tp / (2 * tp + (pred - tp) + (support - tp)) ELSE 0.0 END AS f1,
        support, tp FROM m),
t AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) mp, avg(recall) mr, avg(f1) mf,
             sum(precision * support) wp, sum(recall * support) wr, sum(f1 * support) wf FROM r)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, round(tp / n, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), CAST(n AS BIGINT) FROM t
""",
)
def classification_report(spark, sf):
    return E.classification_report(pairs(spark, sf))


_ORDER_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(CLASS_ORDER)) + ") v(expected, ord))"


@register(
    "failure_breakdown",
    f"""
SELECT f.expected, CAST(o.ord AS BIGINT) AS ord, f.got, f.n FROM
  (SELECT expected, got, count(*) AS n FROM {PAIRS_SQL} WHERE expected <> got GROUP BY expected, got) f
LEFT JOIN {_ORDER_SQL} o USING (expected)
""",
)
def failure_breakdown(spark, sf):
    return E.failure_breakdown(pairs(spark, sf), CLASS_ORDER)


@register(
    "failure_list",
    f"""
SELECT doc_id, f.expected, CAST(o.ord AS BIGINT) AS ord, got, count(*) OVER (PARTITION BY f.expected) AS n_class
FROM {PAIRS_SQL} f LEFT JOIN {_ORDER_SQL} o USING (expected) WHERE f.expected <> got
""",
)
def failure_list(spark, sf):
    """Every failure under its class, with the class's count."""
    return E.failure_list(pairs(spark, sf), CLASS_ORDER).select("doc_id", "expected", "ord", "got", "n_class")


@register(
    "known_miss_split",
    f"""
SELECT doc_id, source, expected, got,
       CASE WHEN source IN ({', '.join(f"'{s}'" for s in KNOWN_MISS_SOURCES)}) THEN 'accepted' ELSE 'regression' END AS status
FROM {PAIRS_SQL} WHERE expected <> got
""",
)
def known_miss_split(spark, sf):
    p = pairs(spark, sf).where(F.col("expected") != F.col("got"))
    known = spark.createDataFrame([(s,) for s in KNOWN_MISS_SOURCES], "source string")
    return E.known_miss_split(p, known, "source").select("doc_id", "source", "expected", "got", "status")
