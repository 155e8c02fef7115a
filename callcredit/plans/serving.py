"""Serving transforms (G1-G10): per-table shaping before the reporting copy.

Each transform is ``DataFrame -> DataFrame`` with its side inputs passed in a
``ServingContext``.  The dispatch table maps a table name to its transform;
tables without one pass unchanged.  ``serve`` reads each table, applies its
transform and hands it to a writer (JDBC overwrite in production).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AGENT_FILTER, EXTENSION_FILTER, QUEUE_FILTER, MemberFilter
from ..functions import lookup as lk
from ..operators.membership import filter_members

# --- fixed values -------------------------------------------------------------
# Objectives that count as a direct parts sale.
DIRECT_OBJECTIVES = ("Sale with a part number", "Sale without part number", "Parts Sale")
# Branch names the reports spell differently.
BRANCH_FIXES = {
    "Concord": "Concord H.O.",
    "Brampton": "Power Systems",
    "Sault Ste. Marie": "Sault Ste Marie",
}
NOT_FOUND = "not found"
AGENT_PREFIX_LENGTH = 4
# --- end of fixed values ------------------------------------------------------


@dataclass
class Lookups:
    """Lookup tables (kept by the operator, not in the code)."""

    branch_region: dict[str, str] = field(default_factory=dict)
    queue_branch: dict[str, str] = field(default_factory=dict)
    agent_display: dict[str, str] = field(default_factory=dict)
    agent_prefix_branch: dict[str, str] = field(default_factory=dict)
    queue_group_key: dict[str, str] = field(default_factory=dict)


@dataclass
class ServingContext:
    lookups: Lookups
    table: Callable[[str], DataFrame]          # name -> DataFrame of the silver layer
    branch_fixes: dict[str, str] = field(default_factory=lambda: dict(BRANCH_FIXES))


def customer_account(df: DataFrame) -> DataFrame:
    """G1: external customers only; missing spend is 0."""
    return (df.where(F.col("Internal").cast("int") == 0)
            .fillna({"expenditure_5yavg_total": 0, "expenditure_5yavg_partsnservices": 0}))


def queue_group(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Join key of a queue group by its name, ``'not found'`` otherwise."""
    return lk.lookup(df, F.col("name"), lookups.queue_group_key, "join_key", default=NOT_FOUND)


def _members(ctx: ServingContext, kind: str) -> tuple[DataFrame, DataFrame]:
    return ctx.table(f"tblconfig_{kind}groupmembers"), ctx.table(f"tblconfig_{kind}group")


def _filtered(df: DataFrame, id_col: str, ctx: ServingContext, kind: str,
              spec: MemberFilter) -> DataFrame:
    members, groups = _members(ctx, kind)
    return filter_members(df, id_col, members, groups, spec)


def with_date(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("date", lk.date_of(F.col(col)))


def extension_performance(df: DataFrame, ctx: ServingContext) -> DataFrame:
    """Extensions of the selected groups, plus the day."""
    return with_date(_filtered(df, "fkextension", ctx, "extension", EXTENSION_FILTER),
                     "midnightstartdate")


def branch_address(df: DataFrame, ctx: ServingContext) -> DataFrame:
    """Report spelling of the branch; region looked up on the raw name."""
    df = df.withColumn("branch_pbi", lk.remap(F.col("branchname"), ctx.branch_fixes))
    return lk.lookup(df, F.col("branchname"), ctx.lookups.branch_region, "region")


def _agent_names(df: DataFrame, lookups: Lookups) -> DataFrame:
    df = lk.lookup(df, lk.glue(F.col("agentfirstname"), F.lit(""), F.col("agentlastname")),
                   lookups.agent_display, "pop_name")
    return lk.lookup(df, lk.prefix(F.col("agentfirstname"), AGENT_PREFIX_LENGTH),
                     lookups.agent_prefix_branch, "branch")


def agent_events(df: DataFrame, ctx: ServingContext) -> DataFrame:
    """Agents of the selected groups, display name, branch, day."""
    df = _filtered(df, "agentid", ctx, "agent", AGENT_FILTER)
    return with_date(_agent_names(df, ctx.lookups), "midnightstartdate")


def agent_performance(df: DataFrame, ctx: ServingContext) -> DataFrame:
    """G6 (main output): as G5."""
    return agent_events(df, ctx)


def unique_agent_names(agent_rows: DataFrame, calls: DataFrame) -> DataFrame:
    """G6 (second output) / U4: display names of agents and call contacts,
    once each, without NULL."""
    return (agent_rows.select("pop_name")
            .unionByName(calls.select(F.col("Contact").alias("pop_name")))
            .distinct().where(F.col("pop_name").isNotNull()))


def queue_performance(df: DataFrame, ctx: ServingContext) -> DataFrame:
    """Queues of the selected groups, branch by queue name, day."""
    df = _filtered(df, "queueid", ctx, "queue", QUEUE_FILTER)
    df = lk.lookup(df, F.col("queuename"), ctx.lookups.queue_branch, "branch")
    return with_date(df, "midnightstartdate")


def call_table(df: DataFrame) -> DataFrame:
    """Direct / Indirect contribution and the day of the call."""
    df = df.withColumn("contribution", lk.two_way(F.col("objective"), DIRECT_OBJECTIVES,
                                                  "Direct", "Indirect"))
    return with_date(df, "callstart")


TRANSFORMS: dict[str, Callable[[DataFrame, ServingContext], DataFrame]] = {
    "customeraccount": lambda df, ctx: customer_account(df),
    "global_branch_address": branch_address,
    "agenteventstats": agent_events,
    "agentperformancebyperiodstats": agent_performance,
    "queueperformancebyperiodstats": queue_performance,
    "tblconfig_queuegroup": lambda df, ctx: queue_group(df, ctx.lookups),
    "tbldata_extensionperformancebyperiod": extension_performance,
    "partscallcentre_popup_data": lambda df, ctx: call_table(df),
}


def transform(df: DataFrame, table: str, ctx: ServingContext) -> DataFrame:
    """The table's transform, or the table unchanged."""
    fn = TRANSFORMS.get(table)
    return df if fn is None else fn(df, ctx)


def serve(tables: list[str], ctx: ServingContext,
          write: Callable[[DataFrame, str], DataFrame | None]) -> dict[str, DataFrame]:
    """Read -> transform -> write for each table; one action per table.

    A writer may return the written table, which is then read instead of
    computing it again.  The unique agent names are returned (and written) as their own output
    instead of being written from inside a transform (D-24).
    """
    out: dict[str, DataFrame] = {}
    for name in tables:
        result = transform(ctx.table(name), name, ctx)
        stored = write(result, name)
        out[name] = result if stored is None else stored
    if "agentperformancebyperiodstats" in out and "partscallcentre_popup_data" in tables:
        names = unique_agent_names(out["agentperformancebyperiodstats"], out["partscallcentre_popup_data"])
        out["agent_name_unique"] = names
        write(names, "agent_name_unique")
    return out


def jdbc_writer(url: str, schema: str = "dbo", *, user: str | None = None, password: str | None = None,
                driver: str | None = None, batch_size: int = 10000,
                num_partitions: int | None = None) -> Callable[[DataFrame, str], None]:
    """A ``write`` for ``serve`` that overwrites
    ``<schema>.<table>`` in a relational reporting database, inserting in
    batches, with at most ``num_partitions`` connections."""
    from ..config import check_identifier
    from ..sources.jdbc import write_jdbc

    def write(df: DataFrame, table: str) -> None:
        write_jdbc(df, url, f"{check_identifier(schema)}.{check_identifier(table)}", user=user,
                   password=password, driver=driver, batch_size=batch_size, num_partitions=num_partitions)
    return write
