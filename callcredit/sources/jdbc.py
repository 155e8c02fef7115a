"""JDBC sources and sinks.

Whole-table reads are split over ``num_partitions`` tasks on a numeric
column when one is given, instead of one task reading the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

READER_TYPES = ("table", "query")


def read_jdbc(spark: SparkSession, url: str, *, table: str | None = None, query: str | None = None,
              user: str | None = None, password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            reader = reader.option(key, value)
    if table is not None:
        reader = reader.option("dbtable", table)
        if partition_column:
            if None in (lower_bound, upper_bound, num_partitions):
                raise ValueError("partitioned read needs lower_bound, upper_bound, num_partitions")
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                      .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None, mode: str = "overwrite",
               batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """K5 / K9: overwrite (default) a relational table, inserts batched;
    ``num_partitions`` caps the number of open connections."""
    writer = (df.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", batch_size).mode(mode))
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            writer = writer.option(key, value)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.save()
