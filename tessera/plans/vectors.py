"""Retrieval queries.

Fixture: ``embeddings`` (unit vectors) is the vector index. Queries are derived from it
by Spark: the unit-normalised centroid of each label, and every vector whose id is divisible by 50.
The text index holds the reviewed templates; conversation turns and the templates' own texts ask it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import contracts as K
from tessera.operators import textindex as TI
from tessera.operators import vectors as V
from tessera.plans import fixtures as X
from tessera.plans.catalog import embed_text_col, sql_embed_text
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import table

TOP_K = 3
THRESHOLD = 0.4

_CENTROIDS_SQL = """(WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
  m AS (SELECT label, dim, avg(v) AS v FROM e GROUP BY label, dim),
  n AS (SELECT label, dim, v / sqrt(sum(v * v) OVER (PARTITION BY label)) AS v FROM m)
  SELECT label AS query_id, list(v ORDER BY dim) AS q FROM n GROUP BY label)"""


def label_queries(spark, sf):
    emb = table(spark, sf, "embeddings")
    return V.centroids(emb, "label").withColumnRenamed("label", "query_id").withColumn("query_id", F.col("query_id").cast("long"))


@register(
    "topk_vectors",
    f"""SELECT query_id, rank, vec_id, score FROM (
  SELECT q.query_id, e.vec_id, round(list_dot_product(e.embedding::DOUBLE[], q.q), 6) AS score,
         row_number() OVER (PARTITION BY q.query_id ORDER BY round(list_dot_product(e.embedding::DOUBLE[], q.q), 6) DESC, e.vec_id) AS rank
  FROM embeddings e, {_CENTROIDS_SQL} q) WHERE rank <= {TOP_K}""",
)
def topk_vectors(spark, sf):
    """E5 + C9: top-3 index vectors per label-centroid query."""
    return V.topk(table(spark, sf, "embeddings"), label_queries(spark, sf), TOP_K)


@register(
    "top1_threshold",
    f"""SELECT vec_id, CASE WHEN score >= {THRESHOLD} THEN query_id END AS query_id, round(score, 6) AS score FROM (
  SELECT e.vec_id, q.query_id, list_dot_product(e.embedding::DOUBLE[], q.q) AS score,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY list_dot_product(e.embedding::DOUBLE[], q.q) DESC, q.query_id) AS rn
  FROM embeddings e, {_CENTROIDS_SQL} q) WHERE rn = 1""",
)
def top1_threshold(spark, sf):
    """Every vector routed to its best centroid; below 0.4 -> no match."""
    return V.top1(table(spark, sf, "embeddings"), label_queries(spark, sf), THRESHOLD)


_ASKED = "vec_id % 50 = 0"  # the stated query set


@register(
    "topk_rows",
    f"""SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, e.vec_id, round(list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) DESC, e.vec_id) AS rank
  FROM embeddings e, (SELECT * FROM embeddings WHERE {_ASKED}) q) WHERE rank <= {TOP_K}""",
)
def topk_rows(spark, sf):
    """C9 + E5: the three nearest rows of every vector whose id is divisible by 50, itself included; the query side grows
    with the table."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return V.topk(e, e.where(_ASKED).withColumnRenamed("vec_id", "query_id"), TOP_K)


# --------------------------------------------------------------------------- text index
def index_records(spark, sf):
    """G8 input: strictly reviewed templates with their B4 text."""
    t = X.templates(spark, sf).where(K.strictly_reviewed("meta"))
    g = lambda k, d="": F.coalesce(F.get_json_object("meta", f"$.{k}"), F.lit(d))
    return t.select(
        F.get_json_object("meta", "$.id").alias("id"),
        g("category").alias("category"),
        g("subcategory").alias("subcategory"),
        g("level", "whole-site").alias("level"),
        g("description").alias("description"),
        "path",
        embed_text_col().alias("embed_text"),
    )


_REVIEWED_SQL = f"""(SELECT json_extract_string(meta, '$.id') AS id, coalesce(json_extract_string(meta, '$.category'), '') AS category,
  coalesce(json_extract_string(meta, '$.subcategory'), '') AS subcategory, coalesce(json_extract_string(meta, '$.level'), 'whole-site') AS level,
  coalesce(json_extract_string(meta, '$.description'), '') AS description, path, {sql_embed_text('meta')} AS embed_text
  FROM {X.TEMPLATES_SQL} WHERE json_type(meta, '$.reviewed') = 'BOOLEAN' AND json_extract_string(meta, '$.reviewed') = 'true')"""
_INDEX_SQL = TI.sql_vectors(_REVIEWED_SQL, "id", "embed_text")


@register(
    "index_build",
    f"""SELECT r.id, category, subcategory, level, description, path, CAST(coalesce(n_terms, 0) AS BIGINT) AS n_terms, norm
FROM {_REVIEWED_SQL} r LEFT JOIN (SELECT id, count(*) AS n_terms, round(sqrt(sum(w * w)), 6) AS norm FROM {_INDEX_SQL} GROUP BY id) v ON r.id = v.id""",
)
def index_build(spark, sf):
    """G8 then A5: the index (records, sparse vectors, vectoriser) is written and read back."""
    index = TI.TextIndex.build(index_records(spark, sf), scratch_path(spark, "index"), "id", "embed_text")
    size = index.postings.groupBy(F.col("id").alias("rep")).agg(F.count(F.lit(1)).alias("n_terms"), F.round(F.sqrt(F.sum(F.col("weight") * F.col("weight"))), 6).alias("norm"))
    out = index.records.join(index.members, "id", "left").join(size, "rep", "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    return out.select("id", "category", "subcategory", "level", "description", "path", "n_terms", "norm")


_TALK_ID = "'talk:' || CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING)"
_REQUESTS_SQL = f"""(SELECT {_TALK_ID} AS query_id, text FROM conversations
  UNION ALL SELECT 'self:' || id AS query_id, embed_text AS text FROM {_REVIEWED_SQL})"""


@register(
    "index_search",
    f"""WITH q AS {TI.sql_query_vectors(_REVIEWED_SQL, 'id', 'embed_text', _REQUESTS_SQL, 'query_id', 'text')},
 v AS {_INDEX_SQL},
 s AS (SELECT q.id AS query_id, v.id, round(sum(q.w * v.w), 6) AS score FROM q JOIN v USING (term) GROUP BY q.id, v.id),
 r AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s WHERE score >= {THRESHOLD}),
 rec AS (SELECT DISTINCT id, category, level FROM {_REVIEWED_SQL})
SELECT a.query_id, r.rank, r.id, category, level, r.score FROM (SELECT DISTINCT query_id FROM {_REQUESTS_SQL}) a
LEFT JOIN (SELECT * FROM r WHERE rank <= {TOP_K}) r ON a.query_id = r.query_id LEFT JOIN rec ON rec.id = r.id""",
)
def index_search(spark, sf):
    """E5 + E6 on the saved index: the three best templates of at least 0.4 for every conversation turn, and for every
    template's own text (which finds itself); a query without a match has one row without a template."""
    records = index_records(spark, sf)
    path = scratch_path(spark, "index")
    TI.TextIndex.build(records, path, "id", "embed_text")
    index = TI.TextIndex.load(spark, path)
    talk = table(spark, sf, "conversations").select(F.expr(_TALK_ID).alias("query_id"), "text")
    own = records.select(F.concat(F.lit("self:"), "id").alias("query_id"), F.col("embed_text").alias("text"))
    asked = talk.unionByName(own)
    found = index.search(asked, "query_id", "text", TOP_K, THRESHOLD)
    named = found.join(index.records.select("id", "category", "level").distinct(), "id")
    return asked.select("query_id").distinct().join(named, "query_id", "left").select("query_id", "rank", "id", "category", "level", "score")


@register(
    "tfidf_vectors",
    f"""SELECT doc_id, CAST(coalesce(nnz, 0) AS BIGINT) AS nnz, coalesce(norm, 0.0) AS norm, top_weight
FROM documents LEFT JOIN (SELECT id, count(*) AS nnz, round(sqrt(sum(w * w)), 4) AS norm, round(max(w), 6) AS top_weight
  FROM {TI.sql_vectors('documents', 'doc_id', 'text')} GROUP BY id) ON id = doc_id""",
)
def tfidf_vectors(spark, sf):
    """F1 over all documents: weighted terms, L2 norm (1, or 0 without a weighted term) and largest weight."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    v = TI.Vectoriser.fit(d, "doc_id", "text").transform(d, "doc_id", "text")
    per = v.groupBy(F.col("id").alias("doc_id")).agg(
        F.count(F.lit(1)).alias("nnz"), F.round(F.sqrt(F.sum(F.col("weight") * F.col("weight"))), 4).alias("norm"), F.round(F.max("weight"), 6).alias("top_weight")
    )
    out = d.select("doc_id").join(per, "doc_id", "left")
    return out.select("doc_id", F.coalesce("nnz", F.lit(0)).alias("nnz"), F.coalesce("norm", F.lit(0.0)).alias("norm"), "top_weight")
