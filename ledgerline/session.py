"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of size: AQE re-plans joins and
# coalesces/splits shuffle partitions at run time; skew join splits hot keys.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a selective side (one month of orders) prunes the big side (all order lines)
    # with a runtime bloom filter before the shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # per-run stored tables are dropped from the checkpoint folder once unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline") -> SparkSession:
    """Return the active session, or build one (local runs and tests).

    On a cluster the session already exists and its settings win; we only
    fill in what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the executor
        builder = builder.config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    A cluster names a shared folder (HDFS/S3/...) there.  Local runs and tests
    have none, so we take a fresh folder under the system temp dir.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            # a machine-local folder would not survive a lost executor
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for cluster runs")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def listing(spark: SparkSession, paths: list[str]) -> tuple:
    """(path, length, modification time) of every file under ``paths``, sorted: changes when the data does."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored tables, wherever the cluster keeps it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def size_shuffle_partitions(spark: SparkSession, paths: list[str], target_bytes: int = 128 << 20) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about input bytes / ``target_bytes``.

    Only when the job did not set it itself.  AQE then merges small partitions
    and splits skewed ones at run time; this sets the upper bound so that the
    largest stage's partitions fit an executor.
    """
    conf = spark.sparkContext.getConf()
    if conf.contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    jvm = spark._jvm
    hconf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    n = max(spark.sparkContext.defaultParallelism, -(-total // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
