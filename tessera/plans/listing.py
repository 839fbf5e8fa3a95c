"""Repository listing rules (B33, E12, D12) over a listing derived from ``pages``.

Fixture: each page is a repository entry — id ``{host}/{first path segment}``
(absent when page_id % 17 = 3, so the row is dropped), type by page_id % 3,
private when page_id % 4 = 0, downloads/likes missing for some rows (default
0); the page's link targets, in document order, are the repository's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.sources.tables import table

TYPE_ORDER = ["dataset", "model", "space"]
URL_BASE = "https://hub.example/"
FILE_SUFFIX = "on"  # fixture stand-in for the model-file suffix

_L1 = [
    "page_id",
    "CASE WHEN page_id % 17 = 3 THEN NULL ELSE regexp_extract(url, '://([^/]+)/', 1) || '/' || regexp_extract(url, '://[^/]+/([^/?#]+)', 1) END AS repo_id",
    "CASE page_id % 3 WHEN 0 THEN 'dataset' WHEN 1 THEN 'model' ELSE 'space' END AS type",
    "CASE WHEN page_id % 9 = 2 THEN NULL ELSE page_id % 4 = 0 END AS private",
    "CASE WHEN page_id % 5 = 0 THEN NULL ELSE length(html) % 100 END AS downloads",
    "CASE WHEN page_id % 6 = 0 THEN NULL ELSE page_id % 7 END AS likes",
]


def raw_listing(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").selectExpr(*_L1)


_RAW_SQL = f"(SELECT {', '.join(_L1)} FROM pages)"


def repo_rows(raw: DataFrame) -> DataFrame:
    """Drop rows without an id; short name after the last '/'; url; defaults
    False / 0 / 0 for missing private / downloads / likes."""
    r = raw.where(F.col("repo_id").isNotNull())
    return r.select(
        "page_id",
        F.element_at(F.split("repo_id", "/"), -1).alias("name"),
        F.col("repo_id").alias("full_name"),
        "type",
        F.coalesce("private", F.lit(False)).alias("private"),
        F.coalesce("downloads", F.lit(0)).cast("long").alias("downloads"),
        F.coalesce("likes", F.lit(0)).cast("long").alias("likes"),
        F.concat(F.lit(URL_BASE), "repo_id").alias("url"),
    )


_ROWS_SQL = f"""(SELECT page_id, split_part(repo_id, '/', -1) AS name, repo_id AS full_name, type,
  coalesce(private, false) AS private, CAST(coalesce(downloads, 0) AS BIGINT) AS downloads,
  CAST(coalesce(likes, 0) AS BIGINT) AS likes, '{URL_BASE}' || repo_id AS url FROM {_RAW_SQL} WHERE repo_id IS NOT NULL)"""


@register("repo_rows", f"SELECT * FROM {_ROWS_SQL}")
def repo_rows_q(spark, sf):
    return repo_rows(raw_listing(spark, sf))


@register(
    "first_file_per_repo",
    f"""SELECT page_id, files[pos] AS first_file, CAST(pos AS BIGINT) AS pos FROM (
  SELECT page_id, files, list_position(list_transform(files, lambda f: ends_with(f, '{FILE_SUFFIX}')), true) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS files FROM pages)) WHERE pos IS NOT NULL AND pos > 0""",
)
def first_file_per_repo(spark, sf):
    """The first listed file with the suffix, per repository; repositories
    without one are dropped. A per-row array expression — no shuffle."""
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1).alias("files"))
    hit = F.transform("files", lambda f: f.endswith(FILE_SUFFIX))
    pos = F.array_position(hit, True)
    return p.select("page_id", F.try_element_at("files", pos.cast("int")).alias("first_file"), pos.cast("long").alias("pos")).where(
        F.col("pos") > 0
    )


_TYPES_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"('{t}', {i})" for i, t in enumerate(TYPE_ORDER)) + ") v(type, ord))"


@register(
    "repo_inventory",
    f"""SELECT r.type, CAST(t.ord AS BIGINT) AS ord, count(*) AS n, count_if(private) AS n_private, count_if(NOT private) AS n_public,
  count_if(downloads > 0 OR likes > 0) AS n_with_stats, CAST(sum(downloads) AS BIGINT) AS downloads, CAST(sum(likes) AS BIGINT) AS likes
FROM {_ROWS_SQL} r JOIN {_TYPES_SQL} t USING (type) GROUP BY r.type, t.ord""",
)
def repo_inventory(spark, sf):
    """Per type in fixed order (types without repositories are absent):
    count, private / public, how many show stats (downloads or likes > 0)."""
    rows = repo_rows(raw_listing(spark, sf))
    dim = spark.createDataFrame([(t, i) for i, t in enumerate(TYPE_ORDER)], "type string, ord long")
    g = rows.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("private").alias("n_private"),
        F.count_if(~F.col("private")).alias("n_public"),
        F.count_if((F.col("downloads") > 0) | (F.col("likes") > 0)).alias("n_with_stats"),
        F.sum("downloads").cast("long").alias("downloads"),
        F.sum("likes").cast("long").alias("likes"),
    )
    return g.join(F.broadcast(dim), "type").select("type", "ord", "n", "n_private", "n_public", "n_with_stats", "downloads", "likes")
