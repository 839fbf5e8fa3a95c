"""The corpus pipeline: quality rules, toxicity, near-duplicate removal, secret masking, packing.

Each stage takes all rows that its predecessor kept. The first four return the columns of ``documents``;
what they learn (cut-offs, grammar) comes from the labelled rows among their own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, packing, quality, secret_scan, toxicity
from tessera.llm.common import read_table, written


def _nested(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and the whole row as one struct: whatever else it holds cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "lang")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    judged = quality.kept(_nested(docs), read_table(spark, sf_dir, "labels"), columns=["row", "doc_id", "lang"])
    return judged.where("_kept").select("row.*")


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar calls toxic go."""
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(_nested(docs), grammar, ["row"])
    return scored.where(F.col("score") < toxicity.CUT).select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest id stays."""
    return jaccard_join.one_of_each(docs)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are masked in the text."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", clean_speech),
    ("jaccard_join", distinct_texts),
    ("secret_scan", masked_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # learned decisions and tokenizer ids are not SQL; tests/llm holds brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written to the shared folder and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
