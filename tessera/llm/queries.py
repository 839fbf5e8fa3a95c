"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    conversation_repair, embed_join, hash_ring, html_extract, jaccard_join, packing, piece_sampler, quality, secret_scan, token_align, token_store, toxicity, url_filter,
)
from tessera.llm.common import read_table
from tessera.llm.oracle import SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(SQL)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).drop("secrets")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(read_table(spark, sf_dir, "pages"), model)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; cut-offs per language from the labelled rows."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return quality.kept(docs, labels, columns=["doc_id", "lang"]).select("doc_id", *[f"_q.{c}" for c in counts], F.col("_kept").alias("kept"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and prediction of every document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.CUT, 1).otherwise(0).alias("predicted"),
    )


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return jaccard_join.classes(read_table(spark, sf_dir, "documents"))


@query
def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, class and keep flag of every embedding."""
    return embed_join.links(read_table(spark, sf_dir, "embeddings"))


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    model = html_extract.fit(html_extract.labelled_pages())
    return html_extract.extract(read_table(spark, sf_dir, "pages"), model, ["page_id", "url"])


@query
def op8_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and the text decoded from them."""
    coded = piece_sampler.encode(read_table(spark, sf_dir, "documents"))
    coded = coded.withColumn("n_pieces", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint"))
    text = piece_sampler.decode(coded.withColumn("ids_hash", F.xxhash64("ids")), ["doc_id", "n_pieces", "ids_hash"])
    return text.select("doc_id", "n_pieces", "ids_hash", F.length("decoded").cast("bigint").alias("n_chars"), F.crc32(F.encode("decoded", "UTF-8")).alias("text_crc32"))


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token-id files and read back."""
    return token_store.load(spark, token_store.stored(read_table(spark, sf_dir, "documents")))


@query
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the ids of two tokenizers, for every document."""
    return token_align.align(read_table(spark, sf_dir, "documents"))


@query
def op12_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return hash_ring.assign(read_table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation."""
    return conversation_repair.digests(read_table(spark, sf_dir, "conversations"))
