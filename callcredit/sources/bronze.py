"""Run folders of the raw (bronze) layer.

Each load writes the rows it read under
``<root>/<db>/<table>/YYYY_MM_DD/YYYY_MM_DD-HH_MM_SS`` so every run's input is
kept and can be replayed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..config import TableRef, run_folder


def write_run(df: DataFrame, root: str, ref: TableRef, run_time: datetime | str,
              num_files: int | None = None) -> str:
    path = run_folder(root, ref, run_time)
    out = df.repartition(num_files) if num_files else df
    out.write.mode("overwrite").parquet(path)
    return path


def read_run(spark: SparkSession, root: str, ref: TableRef, run_time: datetime | str) -> DataFrame:
    return spark.read.parquet(run_folder(root, ref, run_time))
