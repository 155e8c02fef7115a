"""Time zone normalisation.

One projection per table: every configured column is rewritten in a single
``withColumns``, so the plan has one Project however many columns change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..config import TimeSpec


def local_to_utc(col: Column, zone: str, wall_clock: bool = True) -> Column:
    """A wall-clock time in ``zone`` as UTC.

    ``EST`` is a fixed -5 h; a region name such as ``America/New_York``
    follows summer time.  With ``wall_clock`` the result stays a zone-less
    timestamp holding UTC wall time (the session zone must be UTC).
    """
    out = F.to_utc_timestamp(col, zone)
    return out.cast("timestamp_ntz") if wall_clock else out


def parse_with_offset(col: Column, fmt: str, wall_clock: bool = True) -> Column:
    """Text carrying its own offset (``... -05:00``) as an instant;
    text in another form gives NULL (see :func:`parse_misses`)."""
    out = F.try_to_timestamp(col, F.lit(fmt))
    return out.cast("timestamp_ntz") if wall_clock else out


def normalise_times(df: DataFrame, spec: TimeSpec | None) -> DataFrame:
    """Z3: zone columns to UTC, then offset text to timestamps; a table
    without a spec passes unchanged."""
    if spec is None:
        return df
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    changes: dict[str, Column] = {}
    for name, zone in spec.zones:
        if name.lower() in types:
            ntz = isinstance(types[name.lower()], TimestampNTZType)
            changes[name] = local_to_utc(F.col(name), zone, wall_clock=ntz)
    for name, fmt in spec.formats:
        if name.lower() in types:
            changes[name] = parse_with_offset(F.col(name), fmt)
    return df.withColumns(changes) if changes else df


def parse_misses(df: DataFrame, spec: TimeSpec) -> DataFrame:
    """One row: for each column of ``spec.formats`` the number of texts that
    do not parse, as ``<column>_misses``."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & parse_with_offset(F.col(c), fmt).isNull()).alias(f"{c}_misses")
                    for c, fmt in spec.formats])
