"""Structured Streaming forms of the batch operators (H1-H4).

* ``minute_rate`` / ``daily_quota``: windowed counts with a watermark. In append
  mode a window is emitted once the watermark passes its end. A row is dropped
  as late when it is older than the watermark of the *previous* micro-batch
  (Spark's late-event watermark), so lateness is judged one batch behind.
* ``dedupe_into``: first-wins de-duplication against a growing target table via
  ``foreachBatch`` — within a batch by the order key, across batches by an
  anti-join on the key with the target's buckets that the batch meets. Each batch writes its own ``batch_id=`` partitions with
  dynamic overwrite, so a replayed batch replaces its output (idempotent).
* ``run_available_now``: drain what has landed, then stop; the checkpoint makes a
  restart continue where the last run stopped (resumable ingest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tessera.operators.dedupe import first_wins

WATERMARK = "10 minutes"
LEAST_FILES = 4
BUCKET_DIGITS = 1  # of a target's keys: 16 buckets; more for a target that outgrows its batches by far


def land_in_order(df: DataFrame, root: str, order_col: str, n_files: int | None = None) -> int:
    """Write ``df`` as about ``n_files`` parquet files (by default one per partition of ``df``, four at least) in ``order_col``
    order and return their number. One range-partitioned, sorted job writes them all in parallel; the order in which a file stream
    takes them is then set by their modification times, ascending with the part number and after all files that have landed
    before (a landing folder for tests; in production upstream writers fill it)."""
    spark = df.sparkSession
    dtype = dict(df.dtypes)[order_col]
    key = F.unix_micros(F.col(order_col).cast("timestamp")) if dtype.startswith("timestamp") else F.col(order_col)
    n = n_files or max(LEAST_FILES, df.rdd.getNumPartitions())
    before = landed_files(spark, root)
    dealt = df.withColumn("_ord", key).repartitionByRange(n, "_ord").sortWithinPartitions("_ord").drop("_ord")
    dealt.write.mode("append").parquet(root)
    old = {path for path, _ in before}
    new = sorted((path for path, _ in landed_files(spark, root) if path not in old), key=lambda x: x.rsplit("/", 1)[-1])
    jvm = spark._jvm
    last = max([t for _, t in before], default=0)
    start = max(last + 1000, (jvm.System.currentTimeMillis() // 1000 - len(new)) * 1000)
    for i, path in enumerate(new):
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(where, start + 1000 * i, -1)
    return len(new)


def landed_files(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Parquet files of a landing folder and their modification times in milliseconds."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return [(f.getPath().toString(), f.getModificationTime()) for f in fs.listStatus(where) if f.getPath().getName().endswith(".parquet")]


def file_stream(spark: SparkSession, root: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(root)


def minute_rate(stream: DataFrame, key: str, ts: str, delay: str = WATERMARK) -> DataFrame:
    """H2: per key, requests in 60 s windows sliding every 10 s."""
    w = stream.withWatermark(ts, delay).groupBy(F.window(ts, "60 seconds", "10 seconds"), key).count()
    return w.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, F.col("count").alias("n"))


def daily_quota(stream: DataFrame, key: str, ts: str, delay: str = WATERMARK) -> DataFrame:
    """H3: per key, requests per UTC day (tumbling window)."""
    w = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), key).count()
    return w.select(F.col("window.start").alias("window_start"), key, F.col("count").alias("n"))


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> None:
    q = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    q.awaitTermination()


def seen_keys(spark: SparkSession, target: str, batch_id: int, buckets: list[str]) -> DataFrame | None:
    """Keys that other batches left in these buckets of the target; None before the first batch. Only the buckets' folders are read."""
    try:
        stored = spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.where(F.col("bucket").isin(buckets) & (F.col("batch_id") != batch_id)).select("_k")


def dedupe_micro_batch(
    batch: DataFrame, batch_id: int, target: str, key: Column, order_cols: list[str], keep_cols: list[str], digits: int = BUCKET_DIGITS
) -> None:
    """One H1 step: first row per key inside the batch, minus keys already in the
    target (from other batches), written as ``bucket=`` / ``batch_id=`` partitions with
    dynamic overwrite — replaying the same batch id replaces, never duplicates.

    The target is split into ``16 ** digits`` buckets by the leading digits of the key's digest. A batch's keys are worked out once and
    kept, and only the buckets that they fall into are read (their names pass through the driver)."""
    spark = batch.sparkSession
    firsts = first_wins(batch.withColumn("_k", F.sha2(key, 256)), F.col("_k"), order_cols, ["_k", *keep_cols], hash_key=False)
    # a letter first: partition values are read back as text
    firsts = firsts.withColumn("bucket", F.concat(F.lit("p"), F.substring("_k", 1, digits))).persist()
    try:
        seen = seen_keys(spark, target, batch_id, [r[0] for r in firsts.select("bucket").distinct().collect()])
        fresh = firsts if seen is None else firsts.join(seen, "_k", "left_anti")
        (
            fresh.withColumn("batch_id", F.lit(batch_id))
            .repartition("bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "batch_id")
            .parquet(target)
        )
    finally:
        firsts.unpersist()


def dedupe_into(
    stream: DataFrame, target: str, checkpoint: str, key: Column, order_cols: list[str], keep_cols: list[str], digits: int = BUCKET_DIGITS
) -> None:
    """H1: keep the first arrival per key across the whole stream."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        dedupe_micro_batch(batch, batch_id, target, key, order_cols, keep_cols, digits)

    q = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
