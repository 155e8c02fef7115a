"""Versioned table snapshots on plain files (section 7.2 of the survey).

A table is a folder of versions ``<root>/v=<n>``; a version counts once its
``_SUCCESS`` marker exists.  Writers write version ``n+1`` and readers take
the highest complete version, so a failed or lost job leaves the previous
state readable, and a retry simply writes the version again.  There is one
writer per table at a time.

Folder listing goes through the Hadoop FileSystem of the path, so the same
code works on HDFS, object stores and local disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions under ``root``, ascending."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v="):
            try:
                n = int(name[2:])
            except ValueError:
                continue
            if fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                out.append(n)
    return sorted(out)


def latest_version(spark: SparkSession, root: str) -> int | None:
    vs = versions(spark, root)
    return vs[-1] if vs else None


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    v = latest_version(spark, root) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v={v}")


def write_snapshot(df: DataFrame, root: str, num_files: int | None = None) -> int:
    """Write ``df`` as the next version and return its number.

    ``df`` may be computed from the current version: the new version goes
    to a new folder, so the input is never overwritten while it is read.
    """
    spark = df.sparkSession
    current = latest_version(spark, root)
    nxt = 0 if current is None else current + 1
    out = df.repartition(num_files) if num_files else df
    target = f"{root.rstrip('/')}/v={nxt}"
    out.write.mode("overwrite").parquet(target)
    # the version counts once its marker exists; write it ourselves when the
    # session's committer is set not to (the write above has succeeded)
    fs, p, jvm = _fs(spark, target)
    marker = jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")
    if not fs.exists(marker):
        fs.create(marker, True).close()
    return nxt


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` complete versions (and incomplete
    folders older than the newest complete one); returns the versions
    removed.  Without it every run keeps a full copy of the table.  Keep at
    least two so a reader that started on the previous version can finish."""
    if keep < 1:
        raise ValueError("keep at least one version")
    complete = versions(spark, root)
    if len(complete) <= keep:
        return []
    fs, p, jvm = _fs(spark, root)
    newest = complete[-1]
    removed = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith("v=")):
            continue
        try:
            n = int(name[2:])
        except ValueError:
            continue
        if (n in complete and n < complete[-keep]) or (n not in complete and n < newest):
            fs.delete(status.getPath(), True)
            removed.append(n)
    return sorted(removed)
