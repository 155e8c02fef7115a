"""Lookups and classification expressions.

A lookup table is a Python mapping held by the caller.  It becomes a small
relation with a known size, left-joined on columns of private names, so the
caller's columns are never touched; Spark broadcasts it when it is under the
session's threshold.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: Column, mapping: dict[str, str], out: str,
           default: str | None = None) -> DataFrame:
    """``out = mapping[key]``; a missing key gives ``default`` (NULL
    unless given, D-17)."""
    mark = uuid.uuid4().hex
    k, v = f"_key_{mark}", f"_value_{mark}"
    table = df.sparkSession.createDataFrame(pa.table(
        {k: pa.array(list(mapping.keys()), pa.string()), v: pa.array(list(mapping.values()), pa.string())}))
    joined = df.join(table, key == F.col(k), "left")
    value = (F.col(v) if default is None else F.coalesce(F.col(v), F.lit(default))).alias(out)
    if out in df.columns:
        return joined.select(*[value if c == out else df[c] for c in df.columns])
    return joined.select(*[df[c] for c in df.columns], value)


def prefix(col: Column, length: int) -> Column:
    """the first ``length`` characters (position 0 and 1 both mean the
    start, as in SQL ``substring``)."""
    return F.substring(col, 1, length)


def glue(*cols: Column) -> Column:
    """Plain concatenation; NULL if any part is NULL."""
    return F.concat(*cols)


def remap(col: Column, fixes: dict[str, str]) -> Column:
    """Replace listed values, keep every other value as it is."""
    expr = None
    for src, dst in fixes.items():
        expr = F.when(col == src, dst) if expr is None else expr.when(col == src, dst)
    return col if expr is None else expr.otherwise(col)


def two_way(col: Column, members: tuple[str, ...], yes: str, no: str) -> Column:
    """``yes`` for listed values, ``no`` otherwise (NULL included)."""
    return F.when(col.isin(*members), yes).otherwise(no)


def date_of(col: Column, fmt: str | None = None) -> Column:
    """Calendar date of a timestamp or text (in ``fmt``, which has
    no effect on a timestamp); text that is no date gives NULL."""
    return F.try_to_date(col, fmt) if fmt else F.try_to_date(col)
