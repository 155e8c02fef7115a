"""Key-bucketed tables: an upsert rewrites only the buckets it touches.

A full-snapshot upsert rewrites the whole table for every incremental batch.
Here the table is partitioned by ``b = pmod(xxhash64(keys), buckets)``; the
buckets a batch touches are read (the partition filter prunes the others),
merged and written back by Spark's dynamic partition overwrite, which leaves
every other bucket alone.  The number of buckets and the key columns are
stored beside the data; a batch that names others is refused.

Beside the data lies a summary of each bucket's keys: their number and the
sum of their hashes, which does not depend on their order.  Deletes compare it
with the same summary of the live keys and read only buckets that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mutate
from ..session import materialize

BUCKET = "bucket"
LAYOUT = "_layout"  # a leading underscore keeps it out of the table's files
SUMMARY = "_keys"


class LayoutError(ValueError):
    """The table has other buckets or keys than asked for."""


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, root: str, keys: list[str], buckets: int) -> None:
    """Initial write of a table in key buckets."""
    (df.withColumn(BUCKET, bucket_of(keys, buckets))
     .hint("rebalance", BUCKET)
     .write.mode("overwrite").partitionBy(BUCKET).parquet(root))
    df.sparkSession.createDataFrame([(buckets, list(keys))], "buckets int, keys array<string>").coalesce(1).write.mode(
        "overwrite").json(f"{root.rstrip('/')}/{LAYOUT}")
    _store_summary(df.sparkSession, root, list(keys))


def layout(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """The stored number of buckets and key columns."""
    row = spark.read.schema("buckets int, keys array<string>").json(f"{root.rstrip('/')}/{LAYOUT}").first()
    return row["buckets"], list(row["keys"])


def is_bucketed(spark: SparkSession, root: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{LAYOUT}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_bucketed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop(BUCKET)


def upsert_bucketed(spark: SparkSession, root: str, changes: DataFrame, keys: list[str],
                    buckets: int | None = None, newest_by: str | None = None) -> list[int]:
    """Apply ``changes`` (M1 semantics) to a bucketed table; returns the
    buckets rewritten.  The changes are computed once and stored; the list of
    touched buckets is all that reaches the driver.  Rows with a NULL key are
    inserted each time they are applied, as a MERGE does."""
    stored, stored_keys = layout(spark, root)
    if list(keys) != stored_keys or buckets not in (None, stored):
        raise LayoutError(f"{root} has {stored} buckets on {stored_keys}, not {buckets} on {list(keys)}")
    staged = materialize(changes.withColumn(BUCKET, bucket_of(keys, stored)), "changes")
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())
    if not touched:
        return []
    current = spark.read.parquet(root).where(F.col(BUCKET).isin(touched))
    cols = [c for c in current.columns if c != BUCKET]
    merged = mutate.upsert(current.select(*cols, BUCKET), staged.select(*cols, BUCKET), keys, newest_by=newest_by)
    (merged.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(root))
    _store_summary(spark, root, list(keys), touched)
    return touched


def _known(keys: list[str]) -> Column:
    """Whether no part of the key is NULL."""
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``bucket``, ``n``, ``total`` (sum of key hashes) of rows with a whole key."""
    return rows.where(_known(keys)).groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.lit(1), *[F.col(k) for k in keys]).cast("decimal(38,0)")).alias("total"))


def _store_summary(spark: SparkSession, root: str, keys: list[str], touched: list[int] | None = None) -> None:
    """Summaries of the touched buckets (all: ``None``), from their key
    columns alone; a bucket without rows gets a row of zeros."""
    rows = spark.read.parquet(root)
    if touched is not None:
        rows = rows.where(F.col(BUCKET).isin(touched))
    found = _summary(rows.select(*keys, BUCKET), keys)
    if touched is not None:
        every = spark.createDataFrame([(b,) for b in touched], f"{BUCKET} int")
        found = every.join(found, BUCKET, "left").fillna(0, ["n"])
    (found.select("n", "total", BUCKET).repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "static" if touched is None else "dynamic")
     .partitionBy(BUCKET).parquet(f"{root.rstrip('/')}/{SUMMARY}"))


def delete_bucketed(spark: SparkSession, root: str, live: DataFrame, keys: list[str]) -> list[int]:
    """Remove the rows whose key is not in ``live`` (M4, M5 semantics: a row
    with a NULL in its key stays); returns the buckets rewritten.  Buckets
    whose summary equals that of the live keys are not read."""
    stored, stored_keys = layout(spark, root)
    if list(keys) != stored_keys:
        raise LayoutError(f"{root} is keyed by {stored_keys}, not by {list(keys)}")
    there = materialize(live.select(*keys).where(_known(keys)).withColumn(BUCKET, bucket_of(keys, stored)), "live-keys")
    mine = spark.read.schema(f"n bigint, total decimal(38,0), {BUCKET} int").parquet(f"{root.rstrip('/')}/{SUMMARY}").where("n > 0")
    theirs = _summary(there, keys).select(BUCKET, F.col("n").alias("n_live"), F.col("total").alias("total_live"))
    same = F.col("n").eqNullSafe(F.col("n_live")) & F.col("total").eqNullSafe(F.col("total_live"))
    differ = [r[0] for r in mine.join(theirs, BUCKET, "left").where(~same).select(BUCKET).collect()]  # at most the bucket count
    if not differ:
        return []
    current = spark.read.parquet(root).where(F.col(BUCKET).isin(differ))
    gone = current.select(*keys, BUCKET).where(_known(keys)).join(there.select(*keys), keys, "left_anti")
    touched = sorted(r[0] for r in gone.select(BUCKET).distinct().collect())
    if not touched:  # keys that are not here yet made the difference
        return []
    kept = materialize(mutate.keep_live(current.where(F.col(BUCKET).isin(touched)), there.where(F.col(BUCKET).isin(touched)), keys), "kept-rows")
    left = {r[0] for r in kept.select(BUCKET).distinct().collect()}
    (kept.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(root))
    for bucket in set(touched) - left:  # an overwrite leaves what it has no rows for
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{BUCKET}={bucket}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _store_summary(spark, root, list(keys), touched)
    return touched
