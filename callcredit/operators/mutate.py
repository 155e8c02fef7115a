"""Row-level changes as DataFrame -> DataFrame operators.

Each returns the *next* state of a table from its current state and a set
of changes; the caller writes it as a new snapshot (``sources.snapshot``).
Key comparisons are plain SQL equality, so a NULL key never matches: rows
with NULL keys are always inserted by an upsert and never deleted by a
delete, as the published MERGE / DELETE statements behave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import check_identifier


class DuplicateChangeError(ValueError):
    """Two change rows target the same existing row."""


def _keys(keys) -> list[str]:
    if isinstance(keys, str):
        keys = [keys]
    if not keys:
        raise ValueError("at least one key column is needed")
    return [check_identifier(k) for k in keys]


def _non_null(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def latest_per_key(changes: DataFrame, keys, order_by: str) -> DataFrame:
    """Keep the newest change per key.

    ``max`` of a struct led by ``order_by`` (the other columns break ties,
    so the choice is deterministic) is an ordinary aggregate: it combines
    map-side, so a key with very many changes is reduced before the
    shuffle.  Rows with a NULL key are all kept.
    """
    keys = _keys(keys)
    rest = [c for c in changes.columns if c not in keys and c != order_by]
    newest = (changes.where(_non_null(keys)).groupBy(*keys)
              .agg(F.max(F.struct(F.col(order_by), *[F.col(c) for c in rest])).alias("_m"))
              .select(*keys, *[F.col(f"_m.{c}").alias(c) for c in [order_by, *rest]]))
    return newest.select(*changes.columns).unionByName(changes.where(~_non_null(keys)))


def check_unique_changes(target: DataFrame, changes: DataFrame, keys) -> None:
    """Raise when two change rows would update the same target row (the
    condition a MERGE refuses).

    The common case costs one aggregate over the changes (a batch, not the
    table): only when some key repeats is the target consulted, and then
    only for the repeated keys.  At most one row reaches the driver."""
    keys = _keys(keys)
    repeated = (changes.where(_non_null(keys)).groupBy(*keys).count()
                .where(F.col("count") > 1).select(*keys))
    if not repeated.limit(1).count():
        return
    if repeated.join(target.select(*keys), keys, "left_semi").limit(1).count():
        raise DuplicateChangeError(f"several changes for one target row on keys {keys}")


def upsert(target: DataFrame, changes: DataFrame, keys, check: bool = True,
           newest_by: str | None = None) -> DataFrame:
    """Update matched rows (all columns), insert the others.

    ``newest_by`` first reduces the changes to the newest row per key;
    otherwise, with ``check``, duplicate changes for one target row raise.
    """
    keys = _keys(keys)
    if newest_by:
        changes = latest_per_key(changes, keys, newest_by)
    elif check:
        check_unique_changes(target, changes, keys)
    changed_keys = changes.where(_non_null(keys)).select(*keys)
    kept = target.join(changed_keys, keys, "left_anti")
    return kept.unionByName(changes.select(*target.columns))


def deleted_keys(current: DataFrame, live: DataFrame, keys) -> DataFrame:
    """Keys present now but gone at the source (EXCEPT DISTINCT,
    NULL-safe)."""
    keys = _keys(keys)
    return current.select(*keys).subtract(live.select(*keys))


def delete_keys(target: DataFrame, gone: DataFrame, keys) -> DataFrame:
    """Rows of ``target`` whose key is not in ``gone``."""
    keys = _keys(keys)
    return target.join(gone.select(*keys), keys, "left_anti")


def keep_live(target: DataFrame, live: DataFrame, keys) -> DataFrame:
    """M4 + M5 in one step: the rows of ``target`` whose key is in ``live``,
    and those with a NULL in their key, which no delete matches."""
    keys = _keys(keys)
    kept = target.where(_non_null(keys)).join(live.select(*keys), keys, "left_semi")
    return kept.select(*target.columns).unionByName(target.where(~_non_null(keys)))


def insert_if_absent(target: DataFrame, new_rows: DataFrame, keys) -> DataFrame:
    """Append the rows whose key is not in the target yet, as if
    they came one by one: of several new rows with one key a single one goes
    in (the smallest by the other columns).  A NULL key is never present."""
    keys = _keys(keys)
    cols = target.columns
    rest = [c for c in cols if c not in keys]
    new_rows = new_rows.select(*cols)
    known = new_rows.where(_non_null(keys))
    if rest:
        one = known.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_one")).select(*keys, "_one.*")
    else:
        one = known.distinct()
    fresh = one.join(target.select(*keys), keys, "left_anti").select(*cols)
    return target.unionByName(fresh).unionByName(new_rows.where(~_non_null(keys)))
