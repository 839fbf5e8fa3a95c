"""Late data: Spark judges lateness against the watermark of the previous
micro-batch, so a row older than that watermark is dropped."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.streaming import core as SC


def test_late_rows_are_dropped(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    schema = "user_id long, ts timestamp"
    first = spark.createDataFrame([(1, t0 + dt.timedelta(hours=h)) for h in range(0, 5)], schema)
    later = spark.createDataFrame([(1, t0 + dt.timedelta(hours=4, minutes=30))], schema)
    late = spark.createDataFrame([(1, t0 + dt.timedelta(minutes=5))], schema)
    root = scratch_path(spark, "late")
    for part in (first, later, late):  # one file per micro-batch, in this order
        part.coalesce(1).write.mode("append").parquet(root)
    agg = SC.minute_rate(SC.file_stream(spark, root, first.schema), "user_id", "ts")
    sink, ck = scratch_path(spark, "late-sink"), scratch_path(spark, "late-ck")
    SC.run_available_now(agg, sink, ck)
    out = spark.read.parquet(sink)
    around_late = out.where((F.col("window_start") >= F.lit(t0 + dt.timedelta(minutes=4))) & (F.col("window_end") <= F.lit(t0 + dt.timedelta(minutes=6))))
    assert around_late.count() == 0
    assert out.where(F.col("window_start") == F.lit(t0)).first().n == 1


def test_dedupe_batch_replay_is_idempotent(spark):
    target = scratch_path(spark, "dedupe-replay")
    key = F.lower(F.col("t"))
    b0 = spark.createDataFrame([(1, "A"), (2, "b"), (3, "a")], "seq long, t string")
    b1 = spark.createDataFrame([(4, "B"), (5, "c")], "seq long, t string")
    for bid, b in [(0, b0), (1, b1), (1, b1), (0, b0)]:  # batches 1 and 0 are replayed
        SC.dedupe_micro_batch(b, bid, target, key, ["seq"], ["seq", "t"])
    got = sorted((r.seq, r.t) for r in spark.read.parquet(target).collect())
    assert got == [(1, "A"), (2, "b"), (5, "c")]


def test_landing_is_one_parallel_job_in_stream_order(spark):
    root = scratch_path(spark, "landing")
    df = spark.range(0, 4000, 1, 6).select((F.hash("id") % 100_000).cast("long").alias("k"), "id")
    n = SC.land_in_order(df.where("id < 3000"), root, "k", 12)
    m = SC.land_in_order(df.where("id >= 3000"), root, "k", 5)
    files = sorted(SC.landed_files(spark, root), key=lambda x: x[1])
    assert len(files) == n + m and len({t for _, t in files}) == n + m and n > 8
    spans = [spark.read.parquet(p).agg(F.min("k"), F.max("k")).first() for p, _ in files]
    for part in (spans[:n], spans[n:]):
        assert all(a[1] <= b[0] for a, b in zip(part, part[1:]))
    assert spark.read.parquet(root).count() == 4000
    sink, ck = scratch_path(spark, "landing-sink"), scratch_path(spark, "landing-ck")
    SC.run_available_now(SC.file_stream(spark, root, df.schema, 3), sink, ck)
    assert spark.read.parquet(sink).count() == 4000


def test_dedupe_reads_only_the_buckets_of_the_batch(spark):
    target = scratch_path(spark, "dedupe-buckets")
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "seq long, t string")
    SC.dedupe_micro_batch(rows, 0, target, F.col("t"), ["seq"], ["seq", "t"], 2)
    one = spark.createDataFrame([(900, "t7"), (901, "new")], "seq long, t string")
    buckets = ["p" + r[0] for r in one.select(F.substring(F.sha2("t", 256), 1, 2)).collect()]
    plan = SC.seen_keys(spark, target, 1, buckets)._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("PartitionFilters") :]
    assert "bucket" in part.split("]")[0] and all(b in part for b in buckets)
    SC.dedupe_micro_batch(one, 1, target, F.col("t"), ["seq"], ["seq", "t"], 2)
    back = spark.read.parquet(target)
    assert back.count() == 301 and back.where("t = 't7'").first().seq == 7 and back.where("batch_id = 1").count() == 1
