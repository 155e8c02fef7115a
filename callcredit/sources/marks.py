"""Load marks that runs may advance at once.

The control table is a base snapshot and one folder per advance beside it.
An advance writes a folder of its own, so runs that overlap never overwrite
one another; the mark of a table is the latest of its rows.  A mark that would
go back is refused, and of two runs of one table the later mark holds whichever
ends last.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental as inc
from . import snapshot

ADVANCES = "advances"


class MarkError(ValueError):
    """A mark older than the stored one."""


def _advances(root: str) -> str:
    return f"{root.rstrip('/')}/{ADVANCES}"


def _stored(spark: SparkSession, root: str) -> list[str]:
    """Folders of the advances since the base."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_advances(root))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [f for f in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """``table_name``, ``watermark_value``: the present mark of each table."""
    rows = snapshot.read_snapshot(spark, root).select("table_name", "watermark_value")
    stored = _stored(spark, root)
    if stored:
        rows = rows.unionByName(spark.read.schema(inc.CONTROL_SCHEMA).parquet(*stored))
    return rows.groupBy("table_name").agg(F.max("watermark_value").alias("watermark_value"))


def advance(spark: SparkSession, root: str, table: str, value: datetime) -> None:
    """Set the mark of ``table``; later runs read it, whatever other runs
    store meanwhile.  The same mark again changes nothing."""
    stored = read_marks(spark, root).where(F.col("table_name") == table).collect()
    if stored and stored[0][1] is not None and value < stored[0][1]:
        raise MarkError(f"mark of {table!r} is {stored[0][1]}, not to be set back to {value}")
    row = spark.createDataFrame([(table, value)], inc.CONTROL_SCHEMA).coalesce(1)
    row.write.parquet(f"{_advances(root)}/{uuid.uuid4().hex}")


def compact(spark: SparkSession, root: str) -> None:
    """The present marks as the next base snapshot; the advances it holds go."""
    held = _stored(spark, root)
    snapshot.write_snapshot(read_marks(spark, root), root)
    for name in held:  # later advances stay
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
