"""Distributions over growing data (A9): a mergeable quantile sketch per group
and run, kept beside the data.

A run adds the sketches of its own rows only; quartiles over all runs come
from merging the stored sketches, without reading the rows of earlier runs.
A sketch holds some ``3 * k`` values whatever the number of rows, and its
partial states merge before the shuffle, so a hot group is one small row per
task.  ``explore.segment_distribution`` stays the exact form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

K = 1024
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def rank_error(k: int = K) -> float:
    """The error of a quantile's rank, as a share of the rows, that a sketch
    of size ``k`` keeps with 99 % confidence, merged or not (Karnin, Lang and
    Liberty's sketch as Spark ships it; the constants were fitted by its
    authors).  Groups of at most ``k`` rows are exact."""
    return 2.296 / k ** 0.9723


def write_run(rows: DataFrame, path: str, run: str, groups: list[str], measure: str, k: int = K) -> None:
    """Store the sketches of one run's rows under ``path``.  A run that is
    repeated replaces its own sketches and no others; null groups and
    measures are left out, as in the exact form."""
    kept = rows.where(F.col(measure).isNotNull())
    for g in groups:
        kept = kept.where(F.col(g).isNotNull())
    value = F.col(measure).cast("double")
    (kept.groupBy(*groups).agg(F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"), F.min(value).alias("least"),
                               F.max(value).alias("most"))
     .withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run").parquet(path))


def merged_quantiles(spark: SparkSession, path: str, groups: list[str], quantiles: dict[str, float] = QUARTILES,
                     runs: list[str] | None = None) -> DataFrame:
    """Rows (``n``), extremes and quantiles of every group over all stored
    runs, or over those named."""
    stored = spark.read.option("basePath", path).parquet(path)
    if runs is not None:
        stored = stored.where(F.col("run").cast("string").isin(runs))
    merged = stored.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.min("least").alias("least"),
                                         F.max("most").alias("most"))
    return merged.select(*groups, F.kll_sketch_get_n_double("sketch").alias("n"), "least", "most",
                         *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in quantiles.items()])


def rank_errors(rows: DataFrame, found: DataFrame, groups: list[str], measure: str,
                quantiles: dict[str, float] = QUARTILES) -> DataFrame:
    """How far the rank of each found quantile lies from the one asked for, as
    a share of the group's rows: ``<name>_error``, 0 where one of the rows
    equal to the value has that rank."""
    v = F.col(measure)
    joined = rows.where(v.isNotNull()).join(found.select(*groups, *quantiles), groups)
    counts = joined.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum((v < F.col(q)).cast("bigint")).alias(f"_{q}_below") for q in quantiles],
        *[F.sum((v <= F.col(q)).cast("bigint")).alias(f"_{q}_upto") for q in quantiles])
    errors = [F.greatest(F.col(f"_{q}_below") / F.col("n") - p, p - F.col(f"_{q}_upto") / F.col("n"), F.lit(0.0)).alias(f"{q}_error")
              for q, p in quantiles.items()]
    return counts.select(*groups, "n", *errors)
