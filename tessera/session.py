"""Session helpers: local sessions for tests/bench and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. Timestamps in the fixtures are
# zone-less, so UTC keeps day boundaries and epoch arithmetic exact.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_job_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the library depends on (idempotent)."""
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local[N] session for tests and the bench; the UI stays off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A session on a ``local`` master shares one disk, so a private folder serves
    when it names none; anywhere else executors would write to their own disks
    and rows would vanish, so a missing folder is an error.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
