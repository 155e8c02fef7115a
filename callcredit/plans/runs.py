"""Load runs: full loads, bronze -> silver, incremental merges, deletes.

Every run is a short sequence of whole-table Spark jobs with one write each.
State lives in folders (bronze run folders, silver snapshots, the control
table snapshot), so a run that dies can be started again: it rewrites its
own run folder and the next snapshot version, and the previous version stays
readable meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..config import (KEY_SNAPSHOT_FOLDER, LoadWindow, TableRef, TimeSpec, load_steps, primary_keys,
                      sets_mark, time_spec)
from ..functions.timezone import normalise_times
from ..operators import incremental as inc
from ..operators import mutate
from ..sources import bronze, buckets, marks, snapshot


def full_load(read_source: Callable[[TableRef], DataFrame], tables: list[TableRef],
              bronze_root: str, run_time: datetime) -> dict[str, str]:
    """Copy each source table whole into this run's bronze folder."""
    return {t.target_name: bronze.write_run(read_source(t), bronze_root, t, run_time) for t in tables}


def bronze_to_silver(spark: SparkSession, ref: TableRef, bronze_root: str, run_time: datetime,
                     silver_root: str, spec: TimeSpec | None = None) -> int:
    """K7: this run's bronze rows, times normalised (by the configuration of
    the table unless ``spec`` is given), as the next silver snapshot."""
    df = normalise_times(bronze.read_run(spark, bronze_root, ref, run_time), spec or time_spec(ref.target_name))
    return snapshot.write_snapshot(df, f"{silver_root}/{ref.database}/{ref.target_name}")


def incremental_merge(spark: SparkSession, ref: TableRef, source: DataFrame, *,
                      bronze_root: str, silver_root: str, control_root: str, keys: dict,
                      run_time: datetime, given_start: str | None = None,
                      given_end: str | None = None, overlap_minutes: str | int = 0,
                      source_zone: str | None = None, spec: TimeSpec | None = None,
                      time_column: str = "ETLTimestamp", save_mark: bool = True,
                      keep_versions: int | None = None) -> LoadWindow:
    """Window scan -> bronze -> times -> upsert -> mark.

    The window overlaps the previous one by ``overlap_minutes``; rows read
    twice are absorbed by the upsert.  The mark stored is the end bound
    actually used (D-13); runs of other tables may store theirs meanwhile.
    A window that ends before the stored mark is merged and leaves the mark.
    """
    table = ref.target_name
    mark = None if given_start else inc.stored_mark(marks.read_marks(spark, control_root), table)
    window = LoadWindow.resolve(stored_mark=mark, given_start=given_start, given_end=given_end,
                                run_time=run_time, overlap_minutes=overlap_minutes,
                                source_zone=source_zone)
    bronze.write_run(inc.window_scan(source, window, time_column), bronze_root, ref, run_time)
    changes = normalise_times(bronze.read_run(spark, bronze_root, ref, run_time), spec or time_spec(table))
    silver_path = f"{silver_root}/{ref.database}/{table}"
    columns = primary_keys(keys, table)
    in_buckets = buckets.is_bucketed(spark, silver_path)
    if in_buckets:  # only the buckets that the window touches are rewritten
        buckets.upsert_bucketed(spark, silver_path, changes, columns)
    else:
        current = snapshot.read_snapshot(spark, silver_path)
        snapshot.write_snapshot(mutate.upsert(current, changes, columns), silver_path)
    if save_mark:
        try:
            marks.advance(spark, control_root, table, window.end)
        except marks.MarkError:
            pass  # an older window read again
    if keep_versions:
        if not in_buckets:
            snapshot.vacuum(spark, silver_path, keep_versions)
        snapshot.vacuum(spark, control_root, keep_versions)
    return window


def snapshot_live_keys(source: DataFrame, ref: TableRef, keys: dict, bronze_root: str,
                       run_time: datetime) -> str:
    """M3: the source's current keys into ``<bronze>/primary_keys/...``."""
    cols = primary_keys(keys, ref.target_name)
    return bronze.write_run(source.select(*cols), f"{bronze_root}/{KEY_SNAPSHOT_FOLDER}", ref, run_time)


def delete_run(spark: SparkSession, ref: TableRef, *, keys: dict, bronze_root: str,
               silver_root: str, run_time: datetime, keep_versions: int | None = None) -> int | list[int]:
    """M6: silver rows whose key is gone at the source are removed; returns
    the new version, or the buckets rewritten of a table in key buckets.
    ``keep_versions`` drops older snapshot versions afterwards."""
    cols = primary_keys(keys, ref.target_name)
    live = bronze.read_run(spark, f"{bronze_root}/{KEY_SNAPSHOT_FOLDER}", ref, run_time)
    silver_path = f"{silver_root}/{ref.database}/{ref.target_name}"
    if buckets.is_bucketed(spark, silver_path):
        return buckets.delete_bucketed(spark, silver_path, live, cols)
    current = snapshot.read_snapshot(spark, silver_path)
    version = snapshot.write_snapshot(mutate.keep_live(current, live, cols), silver_path)
    if keep_versions:
        snapshot.vacuum(spark, silver_path, keep_versions)
    return version


def run_load(load_type: str, steps: dict[str, Callable[[], object]],
             record_mark: Callable[[], object] | None = None) -> list[str]:
    """M7 / M8: run the steps of a load type in order; only the initial
    load records a mark."""
    done = []
    for step in load_steps(load_type):
        steps[step]()
        if sets_mark(step) and record_mark is not None:
            record_mark()
        done.append(step)
    return done


def build_derived_tables(spark: SparkSession, sources: dict[str, DataFrame], root: str,
                         distinct_numbers: bool = True) -> dict[str, str]:
    """The derived-table path: call table (B1) -> document numbers (B5) ->
    invoice lines (B2) -> revenue per call (B7), each written as the next
    snapshot under ``root/<table>`` and read back by the next step, so every
    step starts from stored data (short lineage, restartable per step)."""
    from ..operators import docnum, revenue
    from .calls import build_calls
    from .invoices import build_invoice_lines

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{root.rstrip('/')}/{name}"
        snapshot.write_snapshot(df, path)
        return snapshot.read_snapshot(spark, path)

    calls = store(build_calls(**{k: sources[k] for k in (
        "meetings", "x_user", "ad_user_all", "hr_corpdir", "branch_phone", "details")}), "calls")
    texts = docnum.upper_text_columns(calls.select("MeetingId", "PartsDocumentNumber", "Notes"))
    numbers = store(docnum.extract_all(texts, distinct=distinct_numbers), "document_numbers")
    lines = store(build_invoice_lines(**{k: sources[k] for k in (
        "invoice_header", "workorder_header", "workorder_partdetail", "equipment",
        "conditionsummary")}), "invoice_lines")
    store(revenue.attribute_revenue(numbers, lines), "revenue")
    return {name: f"{root.rstrip('/')}/{name}" for name in
            ("calls", "document_numbers", "invoice_lines", "revenue")}


def jdbc_source(spark: SparkSession, url_for: Callable[[TableRef], str], *, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                query_for: Callable[[TableRef], str] | None = None,
                bracket: bool = False) -> Callable[[TableRef], DataFrame]:
    """A ``read_source`` for ``full_load`` that reads a
    table or, with ``query_for``, a query run by the database (the
    load-window filter or a key projection).  Table names are
    ``schema.table`` on direct connections and ``schema.[table]`` with
    ``bracket=True`` (tables reached through a linked server) - one loader
    for both."""
    from ..sources.jdbc import read_jdbc

    def read(ref: TableRef) -> DataFrame:
        if query_for is not None:
            return read_jdbc(spark, url_for(ref), query=query_for(ref), user=user, password=password,
                             driver=driver)
        name = ref.qualified_source if bracket else ref.plain_source
        return read_jdbc(spark, url_for(ref), table=name, user=user, password=password, driver=driver)
    return read


def incremental_merges(spark: SparkSession, tables: list[TableRef],
                       read_source: Callable[[TableRef], DataFrame], **kwargs) -> dict[str, LoadWindow]:
    """One incremental merge per configured table, in order; each table
    is its own set of jobs, so a failure names the table and the tables
    before it keep their new state and marks."""
    return {ref.target_name: incremental_merge(spark, ref, read_source(ref), **kwargs) for ref in tables}


def delete_runs(spark: SparkSession, tables: list[TableRef], read_source: Callable[[TableRef], DataFrame],
                *, keys: dict, bronze_root: str, silver_root: str, run_time: datetime) -> dict[str, int]:
    """M3 + M6 for every table: snapshot the live keys, then delete the gone
    ones; a table without configured keys is an error before any job."""
    for ref in tables:
        primary_keys(keys, ref.target_name)
    out = {}
    for ref in tables:
        snapshot_live_keys(read_source(ref), ref, keys, bronze_root, run_time)
        out[ref.target_name] = delete_run(spark, ref, keys=keys, bronze_root=bronze_root,
                                          silver_root=silver_root, run_time=run_time)
    return out
