"""Shared helpers: table reads, written intermediates, worker-wide caches, graph components."""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

# Words are runs of anything but ASCII white space (the contracts' `[^\x20\x09-\x0D]+`).
WORD_SPACE = "[\\x20\\x09-\\x0D]"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; projections and filters are left to the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, by: str | None = None, conf: dict[str, str] = {}) -> DataFrame:  # noqa: B006
    """Write ``df`` to the shared scratch folder and return the reread table.

    Cuts the lineage: a lost executor costs at most a reread of finished files. The shuffle files of
    the write go when it ends, and texts are handed to Python a thousand at a time. With ``by`` it is a table of
    as many buckets as shuffles have partitions, so later joins on that column do not shuffle it again. ``conf``
    holds settings for this write alone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    wanted = {CLEANUP: "true", ARROW_ROWS: "1000", **conf}
    was = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        if by is None:
            df.write.parquet(path)
        else:
            table = f"tessera_{path.rsplit('/', 1)[1].replace('-', '_')}"
            n = int(spark.conf.get("spark.sql.shuffle.partitions"))
            df.write.bucketBy(n, by).sortBy(by).saveAsTable(table, format="parquet", path=path)
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path) if by is None else spark.table(table)
    out.scratch, out.bucketed = path, None if by is None else table
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete tables that ``written`` made. Only for tables of which nothing unwritten depends any more."""
    for df in tables:
        if df is not None:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            path = jvm.org.apache.hadoop.fs.Path(df.scratch)
            path.getFileSystem(conf).delete(path, True)
            if df.bucketed:
                df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.bucketed}")


def worker_cache(name: str, build):
    """One object per Python worker process, kept across tasks (functions travel by value,
    so module globals do not)."""
    store = sys.modules.setdefault("tessera_worker_cache", types.ModuleType("tessera_worker_cache"))
    if not hasattr(store, name):
        setattr(store, name, build())
    return getattr(store, name)


def labelled_once(labels: DataFrame, key: str, value: str) -> DataFrame:
    """One label per key: repeated label rows count once, the larger label wins; null labels go."""
    return labels.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)`` of longs.

    Returns ``(node, component)`` for every node with an edge, ``component`` being the smallest
    reachable node. Alternating large-star / small-star rounds: every round is two aggregations
    whose partial step runs before the shuffle, no adjacency list is gathered, and each round is
    written to the shared folder, where the round before is deleted. Self edges and nulls are ignored; an empty list gives no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = written(e, "cc")
    while True:
        # large-star: every larger neighbour of a node goes to the node's smallest neighbour
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small-star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        nxt = written(small.where("u <> v").distinct(), "cc")
        # a star forest: every u has one parent, and no parent has a parent
        parents = nxt.select(F.col("v").alias("u")).distinct().join(nxt.select("u").distinct(), "u", "left_semi")
        multi = nxt.groupBy("u").count().where("count > 1")
        done = parents.limit(1).count() == 0 and multi.limit(1).count() == 0
        forget(e)
        e = nxt
        if done:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
