"""Spark session defaults and the shared checkpoint folder.

Nothing here starts a server: the UI is off, and the only state the library
keeps across jobs lives in folders the caller names.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew handling splits hot join
# partitions.  Session time zone is UTC so timestamps mean the same thing on
# every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "callcredit", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults applied.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if not key.startswith("spark.ui") and not key.startswith("spark.driver"):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf of an already running session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform and points at shared storage.  A
    local scratch folder is only chosen when the setting is absent (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for the cluster")
        root = tempfile.mkdtemp(prefix="callcredit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for intermediate tables."""
    return os.path.join(checkpoint_root(spark), "callcredit", f"{name}-{uuid.uuid4().hex[:12]}")


def purge_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this library under the shared
    folder: for when no DataFrame that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint_root(spark), "callcredit"))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a cluster run over ``input_bytes`` of input.

    Start with about one shuffle partition per ``target_partition_bytes`` of
    input and let AQE coalesce the small ones; scans split files at the same
    size.  For very large inputs raise ``target_partition_bytes`` rather than
    starting fewer, larger partitions unawares.  Pass the result as ``extra``
    to ``build_session``.
    """
    parts = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        # coalesce to the advisory size rather than to the default parallelism
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: one job, lineage cut at the written table (a lost executor
    re-reads files instead of re-running the plan), and later scans keep
    column pruning."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def bucket_count(input_bytes: int, bucket_bytes: int = 256 << 20, least: int = 8) -> int:
    """Buckets of about ``bucket_bytes`` for ``input_bytes``."""
    return max(least, -(-input_bytes // bucket_bytes))
