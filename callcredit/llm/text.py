"""Column expressions shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PART_BYTES = 4 << 20  # of a batch's values that are Python objects at once

# White space of the word rule: space and the controls 0x09 to 0x0D.
WS_CLASS = r"[\x20\x09-\x0D]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs without white space, in order; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS_CLASS + "+"), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double; zero when ``b`` is zero."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def named(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(batch: pa.RecordBatch, column: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of one column."""
    values = batch.column(column)
    wide = pa.types.is_list(values.type)
    sizes = pc.fill_null(pc.list_value_length(values) if wide else pc.binary_length(values), 0).to_numpy().astype(np.int64)
    number = np.cumsum(sizes * (values.type.value_type.bit_width // 8 if wide else 1)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        if z > a:
            yield batch.slice(a, z - a)


def map_texts(df: DataFrame, text: str, fields: list[T.StructField], make: Callable[[list], list[list]],
              drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``fields`` computed in Arrow batches from one column.

    ``make`` gets some of its values, of about ``PART_BYTES``, and returns one
    list or Arrow array per field.  The other columns pass through untouched;
    ``drop`` names those that end here, and an input column with the name of a
    field is replaced.  A worker outlives its tasks, so each batch's memory is
    given back to the system and not kept for later ones.
    """
    gone = {f.name for f in fields} | set(drop)
    plain = [f"c{i}" for i in range(len(df.columns))]  # inside, for columns of any name
    kept = [(p, f) for p, f in zip(plain, df.schema.fields) if f.name not in gone]
    out = T.StructType([*(T.StructField(p, f.dataType) for p, f in kept), *(T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields))])
    names, arrow, column = [p for p, _ in kept], to_arrow_schema(out), plain[df.columns.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in parts(whole, column):
                made = make(b.column(column).to_pylist())
                passed = [b.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*passed, *(v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(made, list(arrow)[len(names):]))], names=arrow.names)
                del b, made, passed
            del whole
            pa.default_memory_pool().release_unused()

    return df.toDF(*plain).mapInArrow(run, out).toDF(*[f.name for _, f in kept], *[f.name for f in fields])
