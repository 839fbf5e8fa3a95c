"""Fixture tables: one parquet file per table under an sf directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_job_conf

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Zone-less timestamp columns per table (loaded as TIMESTAMP_NTZ).
NTZ_COLUMNS = {"events": ["ts"], "lineitem": ["l_shipdate"], "orders": ["o_orderdate"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one fixture table. Projection and filters are left to Catalyst,
    so only the columns a query touches reach the parquet scan."""
    ensure_job_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ``ts`` as TIMESTAMP (UTC session) — watermarks, range windows
    and ``unix_micros`` need a zoned timestamp."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))
