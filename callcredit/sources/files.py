"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv")
# text as it is: quotes doubled inside quotes, blanks kept at both ends
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_files(spark: SparkSession, fmt: str, path: str, header: bool = True,
               schema: StructType | str | None = None, infer_schema: bool = True,
               multiline: bool = False) -> DataFrame:
    """Parquet or CSV.

    CSV with an explicit ``schema`` is read as declared (S12, the way to read
    large inputs); without one the schema is inferred as the published
    reader does (S2), which costs an extra pass over the data.  ``multiline``
    reads values that hold line breaks; such a file is read by one task.  An
    unknown format is an error before any job runs (S3).
    """
    kind = fmt.lower()
    if kind not in FORMATS:
        raise ValueError(f"invalid source type {fmt!r}; expected one of {FORMATS}")
    if kind == "parquet":
        reader = spark.read.format("parquet")
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    reader = spark.read.format("csv").options(**CSV_TEXT).option("header", header).option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.load(path)


def write_files(df: DataFrame, fmt: str, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, num_files: int | None = None,
                header: bool = True) -> None:
    """K1 / K2 / K8: write a DataFrame as files.

    With ``partition_by`` the output is Hive-style ``col=value`` folders.  The
    rows are clustered by those columns with a ``rebalance`` hint: each task
    writes few files, and AQE splits a value that holds a large share of the
    rows over several tasks (and merges small ones) instead of one task
    writing it all.  ``num_files`` asks for a fixed file count.
    """
    kind = fmt.lower()
    if kind not in ("parquet", "csv", "json", "orc"):
        raise ValueError(f"invalid target type {fmt!r}")
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    elif num_files:
        out = out.repartition(num_files)
    writer = out.write.format(kind).mode(mode)
    if kind == "csv":
        writer = writer.options(**CSV_TEXT).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
