"""Watermark-bounded incremental loads.

The control table is ``(table_name string, watermark_value timestamp)``:
the high-water mark of each table's last load.  It is a batch bookmark, not
an event-time watermark.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from ..config import TIME_FORMAT, LoadWindow, TableRef, check_identifier

CONTROL_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("watermark_value", TimestampNTZType(), True),
])


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL_SCHEMA)


def stored_mark(control: DataFrame, table: str) -> datetime:
    """The stored mark of one table (one row to the driver); an error
    when the table has none."""
    rows = (control.where(F.col("table_name") == table)
            .select("watermark_value").limit(1).collect())
    if not rows or rows[0][0] is None:
        raise LookupError(f"no watermark stored for table {table!r}")
    return rows[0][0]


def _wall_clock(value: datetime):
    """A bound as wall-clock text: it takes the column's own type in the
    comparison, so no client or session zone is applied to it."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f"))


def window_scan(df: DataFrame, window: LoadWindow, column: str = "ETLTimestamp") -> DataFrame:
    """Rows whose load time lies in the inclusive window.  The
    bounds fold to literals of the column's type, so the predicate reaches
    the scan (``PushedFilters``)."""
    return df.where(F.col(column).between(_wall_clock(window.start), _wall_clock(window.end)))


def advance_mark(control: DataFrame, table: str, value: datetime) -> DataFrame:
    """The control table with ``table``'s mark set to ``value`` (rows of
    other tables unchanged; a table without a row gets none, as an UPDATE)."""
    return control.withColumn(
        "watermark_value",
        F.when(F.col("table_name") == table, _wall_clock(value).cast("timestamp_ntz"))
        .otherwise(F.col("watermark_value")))


def set_mark(control: DataFrame, table: str, value: datetime) -> DataFrame:
    """Advance the mark, inserting the table's row when it has none."""
    spark = control.sparkSession
    row = spark.createDataFrame([(table, value)], CONTROL_SCHEMA)
    return control.where(~F.col("table_name").eqNullSafe(table)).unionByName(row)


def _source_name(ref: TableRef, bracket: bool) -> str:
    return ref.qualified_source if bracket else ref.plain_source


def window_query(ref: TableRef, window: LoadWindow, column: str = "ETLTimestamp",
                 bracket: bool = False) -> str:
    """The load window as a query the source database runs, so only
    the window's rows leave it.  Identifiers are checked and the bounds are
    formatted timestamps, never free text (D-23)."""
    col = check_identifier(column)
    start = window.start.strftime(TIME_FORMAT)
    end = window.end.strftime(TIME_FORMAT)
    return f"SELECT * FROM {_source_name(ref, bracket)} WHERE {col} BETWEEN '{start}' AND '{end}'"


def key_query(ref: TableRef, keys: list[str], bracket: bool = False) -> str:
    """M3: the live primary keys of a source table, projected remotely."""
    cols = ", ".join(check_identifier(k) for k in keys)
    return f"SELECT {cols} FROM {_source_name(ref, bracket)}"
