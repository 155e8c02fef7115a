"""Query catalogue: every operator bound to the driver's test tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Queries that need scratch storage (round trips through files, catalog
tables, snapshots) write under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LoadWindow, MemberFilter, TableRef, TimeSpec
from ..functions import lookup as lkf
from ..functions import timezone as tz
from ..operators import docnum, revenue, revenue_delta
from ..operators import explore as ex
from ..operators import incremental as inc
from ..operators import mutate, sketches
from ..operators.membership import filter_members
from ..session import bucket_count, materialize, path_bytes, scratch_path
from ..sources import buckets as bk
from ..sources import bronze
from ..sources import catalog as cat
from ..sources import files, marks, snapshot
from ..streaming.incremental import merge_stream
from . import bindings as b
from . import oracle as o
from . import runs
from .calls import build_calls, first_per_key
from .invoices import SOURCE, build_invoice_lines, source_keys, update_invoice_lines
from .serving import ServingContext, customer_account, serve, transform, unique_agent_names

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def _t(spark, sf_dir, *names):
    _ensure_conf(spark)
    return [b.read(spark, sf_dir, n) for n in names]


def _ensure_conf(spark: SparkSession) -> None:
    """Session settings the queries rely on (a caller's session may lack
    them): UTC wall-clock semantics and adaptive execution."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.adaptive.enabled", "true")):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem, part, supplier = _t(spark, sf_dir, "orders", "lineitem", "part", "supplier")
    return build_invoice_lines(**b.invoice_sources(orders, lineitem, part, supplier))


def revenue_inputs(spark: SparkSession, sf_dir: str):
    """Parsed numbers and the invoice-line table.  As in the load runs, the
    invoice lines are built once and stored (here under the shared
    checkpoint folder); attribution reads the stored table, which it scans
    several times, instead of re-running the invoice joins each time."""
    (orders,) = _t(spark, sf_dir, "orders")
    return b.revenue_numbers(orders), materialize(invoice_lines(spark, sf_dir), "invoice_lines")


# --- step 1: revenue ----------------------------------------------------------------

@register("attribute_revenue", o.REVENUE_STRICT)
def q_attribute_revenue(spark, sf_dir):
    numbers, lines = revenue_inputs(spark, sf_dir)
    return revenue.attribute_revenue(numbers, lines, mode="strict")


@register("revenue_incremental", o.REVENUE_STRICT)
def q_revenue_incremental(spark, sf_dir):
    """A1, A2 and B7 kept current: states of an earlier day, in which some
    lines and mentions were still missing, some were there that are gone since
    and some had other values, brought up to date by the difference alone."""
    numbers, lines = revenue_inputs(spark, sf_dir)
    numbers, lines = materialize(numbers.select("MeetingId", "RootDocumentNumber"), "numbers"), materialize(lines, "lines")
    part = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.lit(n)) == 0
    changed = lines.where(part(lines, 13)).withColumn("PartSales", (F.col("PartSales") * -2).cast(lines.schema["PartSales"].dataType))
    moved = numbers.where(part(numbers, 17)).withColumn("MeetingId", F.col("MeetingId") + 1)
    changes = revenue_delta.Changes(lines.where(part(lines, 11)), changed, numbers.where(part(numbers, 7)), moved)
    old_lines = materialize(lines.where(~part(lines, 11)).unionByName(changed), "old-lines")
    old_numbers = materialize(numbers.where(~part(numbers, 7)).unionByName(moved), "old-numbers")
    documents = materialize(revenue_delta.document_table(old_numbers, old_lines), "documents")
    calls = materialize(revenue_delta.credit_calls(old_numbers, documents), "calls")

    now, touched = revenue_delta.update_documents(documents, lines, changes)
    now = materialize(now, "documents-now")
    return revenue_delta.update_calls(calls, now, numbers, touched, changes)


@register("attribute_revenue_by_document", o.REVENUE_BY_DOCUMENT)
def q_attribute_revenue_by_document(spark, sf_dir):
    numbers, lines = revenue_inputs(spark, sf_dir)
    return revenue.attribute_revenue(numbers, lines, mode="by_document")


@register("aggregate_invoice", o.AGGREGATE_INVOICE)
def q_aggregate_invoice(spark, sf_dir):
    return revenue.aggregate_invoice(invoice_lines(spark, sf_dir))


@register("invoice_lines", o.INVOICE_LINES)
def q_invoice_lines(spark, sf_dir):
    return invoice_lines(spark, sf_dir).withColumn("PartSales", F.col("PartSales").cast("double"))


# --- step 2: document numbers ---------------------------------------------------------

def _texts(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    return docnum.upper_text_columns(b.call_texts(orders))


@register("docnum_field", o.DOCNUM_FIELD)
def q_docnum_field(spark, sf_dir):
    return docnum.extract_from_field(_texts(spark, sf_dir))


@register("docnum_notes", o.DOCNUM_NOTES)
def q_docnum_notes(spark, sf_dir):
    return docnum.extract_from_notes(_texts(spark, sf_dir))


@register("docnum_all", o.DOCNUM_ALL)
def q_docnum_all(spark, sf_dir):
    return docnum.extract_all(_texts(spark, sf_dir), distinct=True)


@register("docnum_all_repeats", o.DOCNUM_ALL_REPEATS)
def q_docnum_all_repeats(spark, sf_dir):
    return docnum.extract_all(_texts(spark, sf_dir), distinct=False)


@register("docnum_legacy", o.DOCNUM_LEGACY)
def q_docnum_legacy(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    return docnum.extract_legacy(b.call_texts(orders))


# --- step 3: call table -------------------------------------------------------------

def call_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region, supplier, events = _t(
        spark, sf_dir, "orders", "customer", "nation", "region", "supplier", "events")
    return build_calls(**b.call_sources(orders, customer, nation, region, supplier, events))


@register("call_table", o.CALL_TABLE)
def q_call_table(spark, sf_dir):
    return call_table(spark, sf_dir)


@register("first_per_key", o.FIRST_PER_KEY)
def q_first_per_key(spark, sf_dir):
    (supplier,) = _t(spark, sf_dir, "supplier")
    return first_per_key(b.branch_phones(supplier), "BranchNo", "BranchName", ["BranchNo", "BranchName"])


# --- step 4: serving ----------------------------------------------------------------

def serving_context(spark: SparkSession, sf_dir: str):
    events, nation, region, customer = _t(spark, sf_dir, "events", "nation", "region", "customer")
    tables = b.telephony_tables(events, nation, region, customer)

    def table(name):
        # the call table stores its branch names as soon as it is built
        return call_table(spark, sf_dir) if name == "partscallcentre_popup_data" else tables[name]

    return ServingContext(b.serving_lookups(), table, dict(b.SERVING_BRANCH_FIXES))


def _serve(table: str):
    def run(spark, sf_dir):
        ctx = serving_context(spark, sf_dir)
        return transform(ctx.table(table), table, ctx)
    return run


_SERVING_SQL = o.serving_sql()
for _name, _table in [("serve_customer_account", "customeraccount"),
                      ("serve_branch_address", "global_branch_address"),
                      ("serve_agent_events", "agenteventstats"),
                      ("serve_agent_performance", "agentperformancebyperiodstats"),
                      ("serve_queue_performance", "queueperformancebyperiodstats"),
                      ("serve_queue_group", "tblconfig_queuegroup"),
                      ("serve_extension_performance", "tbldata_extensionperformancebyperiod"),
                      ("serve_agent_group", "tblconfig_agentgroup"),
                      ("serve_agent_group_members", "tblconfig_agentgroupmembers"),
                      ("serve_queue_group_members", "tblconfig_queuegroupmembers"),
                      ("serve_extension_group", "tblconfig_extensiongroup"),
                      ("serve_extension_group_members", "tblconfig_extensiongroupmembers"),
                      ("serve_call_table", "partscallcentre_popup_data")]:
    register(_name, _SERVING_SQL[_name])(_serve(_table))


@register("serve_agent_names", _SERVING_SQL["serve_agent_names"])
def q_serve_agent_names(spark, sf_dir):
    ctx = serving_context(spark, sf_dir)
    agents = transform(ctx.table("agentperformancebyperiodstats"), "agentperformancebyperiodstats", ctx)
    return unique_agent_names(agents, ctx.table("partscallcentre_popup_data"))


@register("serve_revenue", o.REVENUE_STRICT)
def q_serve_revenue(spark, sf_dir):
    """The revenue table passes to the reports unchanged."""
    ctx = serving_context(spark, sf_dir)
    return transform(q_attribute_revenue(spark, sf_dir), "partscallcentre_revenue", ctx)


# --- step 5: sources, sinks, times, windows -------------------------------------------


@register("scan_project", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def q_scan_project(spark, sf_dir):
    return files.read_files(spark, "parquet", f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity")


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf_dir):
    (customer,) = _t(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    files.write_files(customer, "csv", path)
    return files.read_files(spark, "csv", path, schema=customer.schema)


@register("partitioned_roundtrip", "SELECT * FROM orders")
def q_partitioned_roundtrip(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_by_status")
    files.write_files(orders, "parquet", path, partition_by=["o_orderstatus"])
    return files.read_files(spark, "parquet", path).select(*orders.columns)


@register("catalog_roundtrip", "SELECT * FROM supplier")
def q_catalog_roundtrip(spark, sf_dir):
    (supplier,) = _t(spark, sf_dir, "supplier")
    root = scratch_path(spark, "catalog")
    cat.create_database(spark, "callcredit_scratch", f"{root}/db")
    cat.write_table(supplier, "callcredit_scratch", "supplier_copy", path=f"{root}/supplier_copy")
    return cat.read_table(spark, "callcredit_scratch", "supplier_copy", columns=supplier.columns)


@register("managed_table", "SELECT * FROM part")
def q_managed_table(spark, sf_dir):
    """K3: a managed table, overwritten, read through the catalog."""
    (part,) = _t(spark, sf_dir, "part")
    root = scratch_path(spark, "managed")
    name = f"callcredit_{root.rsplit('-', 1)[-1]}"
    cat.create_database(spark, name, f"{root}/db")
    cat.write_table(part.limit(0), name, "part_copy")
    cat.write_table(part, name, "part_copy")
    return cat.read_table(spark, name, "part_copy", columns=part.columns)


_WINDOW = LoadWindow.resolve(stored_mark=_dt(2024, 1, 10), given_start=None,
                             given_end="2024-01-20 00:00:00", run_time=_dt(2024, 1, 31),
                             overlap_minutes="30")


@register("window_scan", """SELECT * FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-09 23:30:00' AND TIMESTAMP '2024-01-20 00:00:00'""")
def q_window_scan(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    return inc.window_scan(events, _WINDOW, "ts")


@register("utc_from_zone", "SELECT event_id, ts + INTERVAL 5 HOUR AS ts FROM events")
def q_utc_from_zone(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    spec = TimeSpec(zones=(("ts", "EST"),))
    return tz.normalise_times(events.select("event_id", "ts"), spec)


_OFFSET_SPEC = TimeSpec(formats=(("ts_text", "yyyy-MM-dd HH:mm:ss z"),))


def _offset_texts(spark, sf_dir):
    """Event times as text with an offset; every 13th is no time at all."""
    (events,) = _t(spark, sf_dir, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" -05:00"))
    return events.select("event_id", F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(text).alias("ts_text"))


@register("offset_parse", """SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN date_trunc('second', ts) + INTERVAL 5 HOUR END AS ts_text
FROM events""")
def q_offset_parse(spark, sf_dir):
    return tz.normalise_times(_offset_texts(spark, sf_dir), _OFFSET_SPEC)


@register("offset_misses", "SELECT count(*) AS ts_text_misses FROM events WHERE event_id % 13 = 0")
def q_offset_misses(spark, sf_dir):
    """texts that do not parse, counted."""
    return tz.parse_misses(_offset_texts(spark, sf_dir), _OFFSET_SPEC)


@register("date_of_ts", "SELECT event_id, cast(ts as date) AS date FROM events")
def q_date_of_ts(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    return events.select("event_id", lkf.date_of(F.col("ts")).alias("date"))


@register("date_of_text", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN cast(o_orderdate as date) END AS date
FROM orders""")
def q_date_of_text(spark, sf_dir):
    """dates as text; those in another form, or none, give NULL."""
    (orders,) = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    text = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd-MM-yyyy")).otherwise("n/a")
    return orders.select("o_orderkey", lkf.date_of(text, "yyyy-MM-dd").alias("date"))


@register("control_mark", """SELECT c_name AS table_name,
  CASE WHEN c_name = 'Customer#000000007' THEN TIMESTAMP '2024-02-01 00:00:00'
       ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(cast(c_custkey % 30 as int)) END AS watermark_value
FROM customer""")
def q_control_mark(spark, sf_dir):
    """A control table with one mark per loaded table (here one
    per customer name), read back, one mark advanced."""
    (customer,) = _t(spark, sf_dir, "customer")
    control = customer.select(
        F.col("c_name").alias("table_name"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval((F.col("c_custkey") % 30).cast("int"))).alias("watermark_value"))
    root = scratch_path(spark, "control")
    snapshot.write_snapshot(control, root)
    current = snapshot.read_snapshot(spark, root)
    inc.stored_mark(current, "Customer#000000007")   # N1: raises when the table has no mark
    marks.advance(spark, root, "Customer#000000007", _dt(2024, 2, 1))
    return marks.read_marks(spark, root)


@register("control_marks_overlapping", """SELECT c_name AS table_name,
  CASE WHEN c_name = 'Customer#000000007' THEN TIMESTAMP '2024-02-01 00:00:00'
       WHEN c_name = 'Customer#000000008' THEN TIMESTAMP '2024-02-02 00:00:00'
       ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(cast(c_custkey % 30 as int)) END AS watermark_value
FROM customer""")
def q_control_marks_overlapping(spark, sf_dir):
    """Two runs read the marks, then both store theirs; a third stores an
    earlier one, which is refused; the marks are compacted."""
    (customer,) = _t(spark, sf_dir, "customer")
    control = customer.select(
        F.col("c_name").alias("table_name"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval((F.col("c_custkey") % 30).cast("int"))).alias("watermark_value"))
    root = scratch_path(spark, "control")
    snapshot.write_snapshot(control, root)
    for table in ("Customer#000000007", "Customer#000000008"):
        inc.stored_mark(marks.read_marks(spark, root), table)
    marks.advance(spark, root, "Customer#000000007", _dt(2024, 2, 1))
    marks.advance(spark, root, "Customer#000000008", _dt(2024, 2, 2))
    try:
        marks.advance(spark, root, "Customer#000000007", _dt(2024, 1, 2))
    except marks.MarkError:
        marks.compact(spark, root)
    return marks.read_marks(spark, root)


# --- step 6: upsert, delete, insert-if-absent ---------------------------------------------

def _order_changes(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    updated = orders.where(k % 10 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = orders.where(k % 50 == 0).withColumn("o_orderkey", k + 10000000)
    return updated.unionByName(added)


@register("upsert_orders", """WITH changes AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL
  SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 = 0)
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM changes""")
def q_upsert_orders(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    return mutate.upsert(orders, _order_changes(orders), ["o_orderkey"])


@register("upsert_newest", """WITH changes AS (
  SELECT o_orderkey % 1000 AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
      ORDER BY o_orderdate DESC NULLS LAST, o_custkey DESC, o_orderstatus DESC, o_totalprice DESC,
               o_orderpriority DESC) AS rn FROM changes) t WHERE rn = 1)
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM newest c WHERE c.o_orderkey = o.o_orderkey)
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM newest""")
def q_upsert_newest(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    changes = orders.withColumn("o_orderkey", F.col("o_orderkey") % 1000)
    return mutate.upsert(orders, changes, ["o_orderkey"], newest_by="o_orderdate")


@register("deleted_keys", """SELECT o_orderkey FROM orders
EXCEPT SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0""")
def q_deleted_keys(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    return mutate.deleted_keys(orders, orders.where(F.col("o_orderkey") % 7 != 0), ["o_orderkey"])


_LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@register("delete_by_key", """SELECT * FROM lineitem l WHERE NOT EXISTS (
  SELECT 1 FROM lineitem g WHERE g.l_orderkey % 5 = 0 AND g.l_linenumber = 1
    AND g.l_orderkey = l.l_orderkey AND g.l_partkey = l.l_partkey AND g.l_suppkey = l.l_suppkey
    AND g.l_linenumber = l.l_linenumber)""")
def q_delete_by_key(spark, sf_dir):
    (lineitem,) = _t(spark, sf_dir, "lineitem")
    gone = lineitem.where((F.col("l_orderkey") % 5 == 0) & (F.col("l_linenumber") == 1))
    return mutate.delete_keys(lineitem, gone, _LINE_KEY)


@register("insert_if_absent", o.with_(o.NUMBERS) + """
SELECT * FROM numbers WHERE MeetingId % 2 = 0
UNION ALL
SELECT DISTINCT * FROM numbers n WHERE NOT EXISTS (SELECT 1 FROM numbers t WHERE t.MeetingId % 2 = 0
  AND t.MeetingId = n.MeetingId AND t.RootDocumentNumber = n.RootDocumentNumber)""")
def q_insert_if_absent(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    numbers = b.revenue_numbers(orders)
    target = numbers.where(F.col("MeetingId") % 2 == 0)
    batch = numbers.unionByName(numbers.where(F.col("MeetingId") % 3 == 0))  # repeats inside the batch
    return mutate.insert_if_absent(target, batch, ["MeetingId", "RootDocumentNumber"])


@register("member_filter", """SELECT * FROM customer WHERE c_nationkey IN (
  SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('AMERICA', 'EUROPE'))""")
def q_member_filter(spark, sf_dir):
    customer, nation, region = _t(spark, sf_dir, "customer", "nation", "region")
    spec = MemberFilter("n_regionkey", "r_regionkey", "n_nationkey", ("AMERICA", "EUROPE"),
                        reporting_col="r_name")
    return filter_members(customer, "c_nationkey", nation, region, spec)


@register("unique_names", """SELECT DISTINCT name FROM (
  SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier
  UNION ALL SELECT NULL) u WHERE name IS NOT NULL""")
def q_unique_names(spark, sf_dir):
    customer, supplier = _t(spark, sf_dir, "customer", "supplier")
    nulls = spark.createDataFrame([(None,)], "name string")
    return (customer.select(F.col("c_name").alias("name"))
            .unionByName(supplier.select(F.col("s_name").alias("name")))
            .unionByName(nulls).distinct().where(F.col("name").isNotNull()))


# --- load runs ----------------------------------------------------------------------

_ORDERS_REF = TableRef("warehouse", "dbo", "orders")
_EVENTS_REF = TableRef("warehouse", "dbo", "events")


@register("bronze_to_silver", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  o_orderdate + INTERVAL 5 HOUR AS o_orderdate, o_orderpriority FROM orders""")
def q_bronze_to_silver(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "layers")
    run_time = _dt(2024, 2, 1, 6, 0, 0)
    runs.full_load(lambda ref: orders, [_ORDERS_REF], f"{root}/bronze", run_time)
    spec = TimeSpec(zones=(("o_orderdate", "EST"),))
    runs.bronze_to_silver(spark, _ORDERS_REF, f"{root}/bronze", run_time, f"{root}/silver", spec)
    return snapshot.read_snapshot(spark, f"{root}/silver/warehouse/orders")


@register("incremental_run", "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-25 00:00:00'")
def q_incremental_run(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    root = scratch_path(spark, "incremental")
    keys = {"events": ["event_id"]}
    first_mark = _dt(2024, 1, 10)
    bk.write_bucketed(events.where(F.col("ts") < F.lit(first_mark)), f"{root}/silver/warehouse/events", ["event_id"],
                      bucket_count(path_bytes(spark, f"{sf_dir}/events.parquet")))
    control = inc.set_mark(inc.empty_control(spark), "events", first_mark)
    snapshot.write_snapshot(control, f"{root}/control")
    common = dict(bronze_root=f"{root}/bronze", silver_root=f"{root}/silver",
                  control_root=f"{root}/control", keys=keys, overlap_minutes="60",
                  time_column="ts")
    runs.incremental_merge(spark, _EVENTS_REF, events, run_time=_dt(2024, 1, 20, 1),
                           given_end="2024-01-20 00:00:00", **common)
    runs.incremental_merge(spark, _EVENTS_REF, events, run_time=_dt(2024, 1, 25, 1),
                           given_end="2024-01-25 00:00:00", **common)
    return bk.read_bucketed(spark, f"{root}/silver/warehouse/events").select(*events.columns)


@register("delete_run", "SELECT * FROM orders WHERE o_orderkey % 7 <> 0")
def q_delete_run(spark, sf_dir):
    (orders,) = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "deletes")
    keys = {"orders": ["o_orderkey"]}
    run_time = _dt(2024, 2, 2)
    snapshot.write_snapshot(orders, f"{root}/silver/warehouse/orders")
    live = orders.where(F.col("o_orderkey") % 7 != 0)
    runs.snapshot_live_keys(live, _ORDERS_REF, keys, f"{root}/bronze", run_time)
    runs.delete_run(spark, _ORDERS_REF, keys=keys, bronze_root=f"{root}/bronze",
                    silver_root=f"{root}/silver", run_time=run_time)
    return snapshot.read_snapshot(spark, f"{root}/silver/warehouse/orders")


@register("delete_run_bucketed", "SELECT * FROM orders WHERE o_orderkey % 7 <> 0")
def q_delete_run_bucketed(spark, sf_dir):
    """M3-M6 on a table in key buckets: key summaries tell which buckets to
    read; a second run without deletions reads none."""
    (orders,) = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "deletes")
    keys, run_time = {"orders": ["o_orderkey"]}, _dt(2024, 2, 2)
    silver = f"{root}/silver/warehouse/orders"
    bk.write_bucketed(orders, silver, ["o_orderkey"], bucket_count(path_bytes(spark, f"{sf_dir}/orders.parquet")))
    live = orders.where(F.col("o_orderkey") % 7 != 0)
    runs.snapshot_live_keys(live, _ORDERS_REF, keys, f"{root}/bronze", run_time)
    for _ in range(2):
        runs.delete_run(spark, _ORDERS_REF, keys=keys, bronze_root=f"{root}/bronze", silver_root=f"{root}/silver", run_time=run_time)
    return bk.read_bucketed(spark, silver).select(*orders.columns)


# --- step 7: exploration ------------------------------------------------------------


_CUST = ["CustomerNo", "CustomerName"]
_SEGMENTS = ["Loyalty", "Size", "SupportReliance", "Profitability"]


def _calls(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    return b.explore_calls(events)


def _queues(spark, sf_dir):
    return _calls(spark, sf_dir).where(F.col("CallType") == "Queue Call")


def _afterhours(spark, sf_dir):
    return _calls(spark, sf_dir).where(F.col("CallType") == "Afterhours")


def _spend_clean(spark, sf_dir):
    (customer,) = _t(spark, sf_dir, "customer")
    return ex.dedupe_rows(b.explore_spend(customer)).where(F.col("Expenditure_5YAVG_PartsNServices") >= 0)


def _spend(spark, sf_dir):
    ranked = ex.average_rank_desc(_spend_clean(spark, sf_dir), "Expenditure_5YAVG_PartsNServices", "ExpPNSRank")
    return ex.average_rank_desc(ranked, "Expenditure_5YAVG_Total", "ExpTotalRank")


def _per_customer_segments(spark, sf_dir):
    per = ex.all_but_total(_queues(spark, sf_dir), _CUST)
    return per.join(_spend_clean(spark, sf_dir).select("CustomerNo", *_SEGMENTS), "CustomerNo", "left")


@register("top_with_total", o.TOP_WITH_TOTAL)
def q_top_with_total(spark, sf_dir):
    return ex.top_with_total(_queues(spark, sf_dir), _CUST)


@register("top_by_calls", o.TOP_BY_CALLS)
def q_top_by_calls(spark, sf_dir):
    return ex.top_with_total(_afterhours(spark, sf_dir), _CUST, sort_by="TotalCalls")


@register("top_objectives", o.TOP_OBJECTIVES)
def q_top_objectives(spark, sf_dir):
    return ex.top_with_total(_queues(spark, sf_dir), ["Objective"])


@register("top_branches", o.TOP_BRANCHES)
def q_top_branches(spark, sf_dir):
    return ex.top_with_total(_afterhours(spark, sf_dir), ["Branch", "Contact"])


@register("top_queue_branches", o.TOP_QUEUE_BRANCHES)
def q_top_queue_branches(spark, sf_dir):
    return ex.top_with_total(_queues(spark, sf_dir), ["Branch", "Contact"])


@register("top_afterhours_objectives", o.TOP_AFTERHOURS_OBJECTIVES)
def q_top_afterhours_objectives(spark, sf_dir):
    return ex.top_with_total(_afterhours(spark, sf_dir), ["Objective"])


@register("top_measures_sum", o.TOP_MEASURES_SUM)
def q_top_measures_sum(spark, sf_dir):
    return ex.top_measures_sum(_calls(spark, sf_dir), _CUST)


@register("pivot_with_totals", o.PIVOT_WITH_TOTALS)
def q_pivot_with_totals(spark, sf_dir):
    return ex.pivot_with_totals(_calls(spark, sf_dir), _CUST, "CallType",
                                ["Queue Call", "Afterhours", "Direct Call", "Walk In"])


@register("calls_hours_by_customer", o.CALLS_HOURS_BY_CUSTOMER)
def q_calls_hours_by_customer(spark, sf_dir):
    return ex.calls_hours(_calls(spark, sf_dir), "CustomerNo")


@register("calls_hours_corr", o.CALLS_HOURS_CORR)
def q_calls_hours_corr(spark, sf_dir):
    return ex.calls_hours_corr(_calls(spark, sf_dir), "CustomerNo")


@register("pareto", o.PARETO)
def q_pareto(spark, sf_dir):
    queues = _queues(spark, sf_dir)
    top = ex.by_key(queues, _CUST).orderBy(*ex._order("TotalHours", _CUST)).limit(10)
    chosen = queues.join(top.select(*_CUST), _CUST, "left_semi")
    return ex.pareto(chosen, _CUST, "Objective", threshold=90.0)


@register("avg_rank", o.AVG_RANK)
def q_avg_rank(spark, sf_dir):
    return _spend(spark, sf_dir)


@register("spend_per_hour", o.SPEND_PER_HOUR)
def q_spend_per_hour(spark, sf_dir):
    top = ex.by_key(_queues(spark, sf_dir), _CUST).orderBy(*ex._order("TotalHours", _CUST)).limit(10)
    spend = _spend(spark, sf_dir).select("CustomerNo", "Expenditure_5YAVG_PartsNServices",
                                         "ExpPNSRank", "ExpTotalRank")
    return ex.spend_per_hour(top.select("CustomerNo", "TotalCalls", "TotalHours"), spend)


@register("segment_share", o.SEGMENT_SHARE)
def q_segment_share(spark, sf_dir):
    return ex.segment_share(_per_customer_segments(spark, sf_dir), _SEGMENTS)


@register("segment_share_each", o.SEGMENT_SHARE_EACH)
def q_segment_share_each(spark, sf_dir):
    return ex.segment_share_each(_per_customer_segments(spark, sf_dir),
                                 ["Size", "Loyalty", "SupportReliance", "Profitability"])


def _distribution(segment: str):
    def run(spark, sf_dir):
        # quartiles are interpolated; shown to 6 decimals (engines interpolate
        # with different but equivalent formulas)
        out = ex.segment_distribution(_per_customer_segments(spark, sf_dir), segment)
        return out.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})
    return run


register("segment_distribution", o.segment_distribution_sql("Size"))(_distribution("Size"))
for _segment in ("Loyalty", "SupportReliance", "Profitability"):
    register(f"segment_distribution_{_segment.lower()}", o.segment_distribution_sql(_segment))(_distribution(_segment))


@register("segment_distribution_runs", o.SEGMENT_DISTRIBUTION_RUNS)
def q_segment_distribution_runs(spark, sf_dir):
    """A9 over growing data: two runs store their sketches, the second one
    twice; the merged quartiles against the rows, with twice the error that is
    kept with 99 % confidence (and a row for interpolation) as the bound."""
    rows = _per_customer_segments(spark, sf_dir).where("Size is not null and MinPerCall is not null")
    rows = materialize(rows.select("CustomerNo", "Size", "MinPerCall"), "segment-rows")
    path = scratch_path(spark, "segment-sketches")
    second = F.pmod(F.xxhash64("CustomerNo"), F.lit(3)) == 0
    for run, part in (("1", rows.where(~second)), ("2", rows.where(second)), ("2", rows.where(second))):
        sketches.write_run(part, path, run, ["Size"], "MinPerCall")
    found = materialize(sketches.merged_quantiles(spark, path, ["Size"]), "segment-quantiles")
    errors = sketches.rank_errors(rows, found, ["Size"], "MinPerCall")
    bound = 2 * sketches.rank_error() + 1 / F.col("n")
    return errors.drop("n").join(found, "Size").select(
        "Size", "n", "least", "most", *[(F.col(f"{q}_error") <= bound).alias(f"{q}_kept") for q in sketches.QUARTILES])


@register("branch_drill", o.BRANCH_DRILL)
def q_branch_drill(spark, sf_dir):
    rows = _queues(spark, sf_dir).where(F.col("Branch") == "Branch 3  ")
    return ex.drill(rows, ["Branch", "Contact", "Objective"])


@register("branch_calls_filter", o.BRANCH_CALLS_FILTER)
def q_branch_calls_filter(spark, sf_dir):
    return _queues(spark, sf_dir).where((F.col("Branch") == "Branch 3  ")
                                        & (F.col("Contact") == "Contact 2")
                                        & (F.col("DurationHours") > 1))


@register("call_duration", o.CALL_DURATION)
def q_call_duration(spark, sf_dir):
    (events,) = _t(spark, sf_dir, "events")
    saved = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 600).cast("int"))
    return events.select(F.col("event_id").alias("MeetingID"),
                         ex.duration_hours(F.col("ts"), saved).alias("DurationHours"))


@register("root_doc_sales", o.ROOT_DOC_SALES)
def q_root_doc_sales(spark, sf_dir):
    (lineitem,) = _t(spark, sf_dir, "lineitem")
    invoice = lineitem.select(
        F.concat(b.doc_of(F.col("l_orderkey")), F.lit("/"), F.col("l_linenumber").cast("string")).alias("PDN"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("TotalPartSales"))
    return ex.sales_by_root(invoice, "PDN", "TotalPartSales")


@register("dedupe_rows", o.DEDUPE_ROWS)
def q_dedupe_rows(spark, sf_dir):
    (customer,) = _t(spark, sf_dir, "customer")
    return ex.dedupe_rows(b.explore_spend(customer)).where(F.col("Expenditure_5YAVG_PartsNServices") >= 0)


@register("clean_names", o.CLEAN_NAMES)
def q_clean_names(spark, sf_dir):
    (customer,) = _t(spark, sf_dir, "customer")
    raw = customer.select(F.col("c_custkey").alias("Customer No"),
                          F.col("c_mktsegment").alias("Size_ClusterDesc"),
                          F.col("c_nationkey").alias("Loyalty_ClusterDesc"),
                          F.col("c_acctbal").alias("Expenditure (PNS)"))
    return ex.clean_names(raw, drop_suffix="_ClusterDesc")


@register("calls_with_revenue", o.CALLS_WITH_REVENUE)
def q_calls_with_revenue(spark, sf_dir):
    """Each call with the distinct numbers it names (legacy
    parser), their invoice sales and the sales type."""
    orders, lineitem = _t(spark, sf_dir, "orders", "lineitem")
    calls = orders.select(F.col("o_orderkey").alias("MeetingId"),
                          F.concat(F.lit("Branch "), (F.col("o_custkey") % 9).cast("string"),
                                   F.lit("  ")).alias("Branch"))
    numbers = docnum.extract_legacy(b.call_texts(orders))
    sales = q_root_doc_sales(spark, sf_dir)
    return ex.calls_with_sales(calls, numbers, sales)


# --- streaming form of the incremental merge -------------------------------------------

@register("incremental_stream", "SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-25 00:00:00'")
def q_incremental_stream(spark, sf_dir):
    """N6 / M2 as a file stream: two overlapping load windows land as bronze
    run folders; an AvailableNow stream upserts them into the bucketed table."""
    (events,) = _t(spark, sf_dir, "events")
    root = scratch_path(spark, "stream")
    first_mark = _dt(2024, 1, 10)
    bk.write_bucketed(events.where(F.col("ts") < F.lit(first_mark)), f"{root}/silver", ["event_id"],
                      bucket_count(path_bytes(spark, f"{sf_dir}/events.parquet")))
    w1 = LoadWindow(_dt(2024, 1, 9, 23), _dt(2024, 1, 20))
    w2 = LoadWindow(_dt(2024, 1, 19, 23), _dt(2024, 1, 25))
    for run_time, w in ((_dt(2024, 1, 20, 1), w1), (_dt(2024, 1, 25, 1), w2)):
        bronze.write_run(inc.window_scan(events, w, "ts"), f"{root}/bronze", _EVENTS_REF, run_time)
    q = merge_stream(spark, f"{root}/bronze", events.schema, ["event_id"], f"{root}/silver",
                     f"{root}/checkpoint", newest_by="ts")
    q.awaitTermination()
    return bk.read_bucketed(spark, f"{root}/silver").select(*events.columns)


# --- serving dispatch (G9 / G10) ----------------------------------------------------------

_SERVED = ["customeraccount", "global_branch_address", "partscallcentre_revenue", "partscallcentre_popup_data",
           "agenteventstats", "agentperformancebyperiodstats", "tblconfig_agentgroup", "tblconfig_agentgroupmembers",
           "tblconfig_extensiongroupmembers", "tblconfig_extensiongroup", "tblconfig_queuegroup", "tblconfig_queuegroupmembers",
           "tbldata_extensionperformancebyperiod", "queueperformancebyperiodstats"]
_SERVED_SQL = {"customeraccount": "serve_customer_account", "global_branch_address": "serve_branch_address",
               "agenteventstats": "serve_agent_events", "agentperformancebyperiodstats": "serve_agent_performance",
               "queueperformancebyperiodstats": "serve_queue_performance",
               "tblconfig_queuegroup": "serve_queue_group",
               "tbldata_extensionperformancebyperiod": "serve_extension_performance",
               "partscallcentre_popup_data": "serve_call_table", "agent_name_unique": "serve_agent_names",
               "tblconfig_agentgroup": "serve_agent_group", "tblconfig_agentgroupmembers": "serve_agent_group_members",
               "tblconfig_queuegroupmembers": "serve_queue_group_members", "tblconfig_extensiongroup": "serve_extension_group",
               "tblconfig_extensiongroupmembers": "serve_extension_group_members"}


def _serving_dispatch_sql() -> str:
    parts = [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM ({_SERVING_SQL[q].strip()}) x"
             for t, q in _SERVED_SQL.items()]
    parts.append(f"SELECT 'partscallcentre_revenue', count(*) FROM ({o.REVENUE_STRICT}) x")
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


@register("serving_dispatch", _serving_dispatch_sql())
def q_serving_dispatch(spark, sf_dir):
    """Read -> transform -> write for every served table, then the row
    count of each written table (read back from the files); the values are
    those of the serve_* queries.  The call table is built once."""
    ctx = serving_context(spark, sf_dir)
    tables = {"partscallcentre_revenue": q_attribute_revenue(spark, sf_dir)}
    ctx = replace(ctx, table=lambda name, other=ctx.table: tables[name] if name in tables else other(name))
    root = scratch_path(spark, "gold")
    written = []

    def write(df, name):
        files.write_files(df, "parquet", f"{root}/{name}")
        written.append(name)
        return spark.read.parquet(f"{root}/{name}")

    serve(_SERVED, ctx, write)
    counts = [spark.read.parquet(f"{root}/{name}").groupBy().count()
              .select(F.lit(name).alias("table_name"), F.col("count").alias("n_rows")) for name in written]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("upsert_bucketed", ORACLE["upsert_orders"])
def q_upsert_bucketed(spark, sf_dir):
    """M1 at scale: the orders table kept in key buckets sized by its bytes;
    the changes rewrite only the buckets they touch."""
    (orders,) = _t(spark, sf_dir, "orders")
    root = scratch_path(spark, "orders_bucketed")
    bk.write_bucketed(orders, root, ["o_orderkey"], bucket_count(path_bytes(spark, f"{sf_dir}/orders.parquet")))
    bk.upsert_bucketed(spark, root, _order_changes(orders), ["o_orderkey"])
    return bk.read_bucketed(spark, root).select(*orders.columns)


# --- the recogniser over whole free texts ---------------------------------------------

def _with_number(text: str, key):
    """A whole text between two mentions of the number of its key."""
    number = b.doc_of(key)
    return F.concat(number, F.lit(" "), F.col(text), F.lit(" ref. "), number)


@register("docnum_documents", o.DOCNUM_DOCUMENTS)
def q_docnum_documents(spark, sf_dir):
    """B4 over every document's full text with a number made from its key
    (notes rule)."""
    (documents,) = _t(spark, sf_dir, "documents")
    notes = documents.select(F.col("doc_id").alias("MeetingId"), F.upper(_with_number("text", F.col("doc_id"))).alias("Notes"))
    return docnum.extract_from_notes(notes)


@register("docnum_pages", o.DOCNUM_PAGES)
def q_docnum_pages(spark, sf_dir):
    """B4 over every raw web page (markup included, as call notes carry it)."""
    (pages,) = _t(spark, sf_dir, "pages")
    return docnum.extract_from_notes(pages.select(F.col("page_id").alias("MeetingId"),
                                                  F.upper(_with_number("html", F.col("page_id"))).alias("Notes")))


@register("docnum_conversations", o.DOCNUM_CONVERSATIONS)
def q_docnum_conversations(spark, sf_dir):
    """B3 over every conversation turn's full text (document-field rule)."""
    (conversations,) = _t(spark, sf_dir, "conversations")
    key = F.col("conv_id") * 1000 + F.col("turn")
    field = conversations.select(key.alias("MeetingId"), F.upper(_with_number("text", key)).alias("PartsDocumentNumber"))
    return docnum.extract_from_field(field)


@register("revenue_from_calls", o.REVENUE_FROM_CALLS)
def q_revenue_from_calls(spark, sf_dir):
    """Section 3.2 end to end: calls -> numbers -> invoice lines -> revenue,
    each step stored before the next reads it."""
    orders, customer, nation, region, supplier, events, lineitem, part = _t(
        spark, sf_dir, "orders", "customer", "nation", "region", "supplier", "events", "lineitem", "part")
    sources = dict(b.call_sources(orders, customer, nation, region, supplier, events))
    sources.update(b.invoice_sources(orders, lineitem, part, supplier))
    paths = runs.build_derived_tables(spark, sources, scratch_path(spark, "derived"))
    return snapshot.read_snapshot(spark, paths["revenue"])


@register("csv_dates_roundtrip", "SELECT * FROM orders")
def q_csv_dates_roundtrip(spark, sf_dir):
    """Orders (with timestamps) to CSV, read back with an explicit
    schema (no inference pass), timestamps parsed."""
    (orders,) = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders_csv")
    files.write_files(orders, "csv", path)
    return files.read_files(spark, "csv", path, schema=orders.schema)


@register("csv_notes_roundtrip", """SELECT doc_id, ' "' || text || '", he said,' || chr(10) || 'twice ""' AS notes, lang
FROM documents""")
def q_csv_notes_roundtrip(spark, sf_dir):
    """K8: free text with line breaks, quotes and commas through CSV."""
    (documents,) = _t(spark, sf_dir, "documents")
    rows = documents.select("doc_id", F.concat(F.lit(' "'), F.col("text"), F.lit('", he said,\ntwice ""')).alias("notes"), "lang")
    path = scratch_path(spark, "notes_csv")
    files.write_files(rows, "csv", path)
    return files.read_files(spark, "csv", path, schema=rows.schema, multiline=True)


@register("csv_inferred", "SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey::INT AS c_nationkey, c_acctbal FROM customer")
def q_csv_inferred(spark, sf_dir):
    """CSV read back with an inferred schema."""
    (customer,) = _t(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer_csv")
    files.write_files(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), "csv", path)
    return files.read_files(spark, "csv", path)


# --- single lookups and case expressions on the test tables ----------------------------

_SEGMENT_LABELS = {"MACHINERY": "Machines", "BUILDING": "Buildings", "AUTOMOBILE": "Autos"}
_NAME_PREFIXES = {"smal": "S", "red ": "R", "blue": "B"}
_PRIORITY_KEYS = {"1-URGENT": "k-1", "2-HIGH": "k-2"}
_STATUS_FIXES = {"F": "Finished", "O": "Open"}
_DIRECT_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def _case_sql(col: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


@register("lookup_exact", f"""SELECT c_custkey, c_mktsegment,
  {_case_sql('c_mktsegment', _SEGMENT_LABELS, 'NULL')} AS label FROM customer""")
def q_lookup_exact(spark, sf_dir):
    """exact-key lookup; a missing key gives NULL."""
    (customer,) = _t(spark, sf_dir, "customer")
    return lkf.lookup(customer.select("c_custkey", "c_mktsegment"), F.col("c_mktsegment"),
                      _SEGMENT_LABELS, "label")


@register("lookup_prefix", f"""SELECT p_partkey, p_name,
  {_case_sql('substr(p_name, 1, 4)', _NAME_PREFIXES, 'NULL')} AS tag FROM part""")
def q_lookup_prefix(spark, sf_dir):
    """F2 + F15: lookup on the first four characters."""
    (part,) = _t(spark, sf_dir, "part")
    return lkf.lookup(part.select("p_partkey", "p_name"), lkf.prefix(F.col("p_name"), 4),
                      _NAME_PREFIXES, "tag")


@register("lookup_default", f"""SELECT o_orderkey, o_orderpriority,
  {_case_sql('o_orderpriority', _PRIORITY_KEYS, "'not found'")} AS join_key FROM orders""")
def q_lookup_default(spark, sf_dir):
    """F15 + P15: lookup with a default for missing keys."""
    (orders,) = _t(spark, sf_dir, "orders")
    return lkf.lookup(orders.select("o_orderkey", "o_orderpriority"), F.col("o_orderpriority"),
                      _PRIORITY_KEYS, "join_key", default="not found")


@register("case_remap", f"""SELECT o_orderkey,
  {_case_sql('o_orderstatus', _STATUS_FIXES, 'o_orderstatus')} AS o_orderstatus FROM orders""")
def q_case_remap(spark, sf_dir):
    """Listed values replaced, all others kept."""
    (orders,) = _t(spark, sf_dir, "orders")
    return orders.select("o_orderkey", lkf.remap(F.col("o_orderstatus"), _STATUS_FIXES).alias("o_orderstatus"))


@register("case_contribution", """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  THEN 'Direct' ELSE 'Indirect' END AS contribution FROM orders""")
def q_case_contribution(spark, sf_dir):
    """Two-way classification (NULL counts as the second class)."""
    (orders,) = _t(spark, sf_dir, "orders")
    return orders.select("o_orderkey", lkf.two_way(F.col("o_orderpriority"), _DIRECT_PRIORITIES,
                                                   "Direct", "Indirect").alias("contribution"))


@register("filter_fill", """SELECT * FROM (
  SELECT cast(c.c_custkey as varchar) AS CustomerNo, CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS Internal,
         coalesce(s.total, 0) AS expenditure_5yavg_total,
         coalesce(s.total / 5, 0) AS expenditure_5yavg_partsnservices
  FROM customer c LEFT JOIN (
    SELECT o_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) AS total
    FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.o_custkey) t
WHERE Internal = 0""")
def q_filter_fill(spark, sf_dir):
    """P2 + P15 (G1 on joined data): spend per customer from its orders,
    external customers only, missing spend 0."""
    customer, orders = _t(spark, sf_dir, "customer", "orders")
    spend = orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    joined = customer.join(spend, customer.c_custkey == spend.o_custkey, "left").select(
        F.col("c_custkey").cast("string").alias("CustomerNo"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).alias("Internal"),
        F.col("total").alias("expenditure_5yavg_total"),
        (F.col("total") / 5).alias("expenditure_5yavg_partsnservices"))
    return customer_account(joined)


@register("call_table_bucketed", o.CALL_TABLE)
def q_call_table_bucketed(spark, sf_dir):
    """B1 over silver tables stored bucketed on the call id: the calls and
    their details (the two large inputs) are co-located, so their join needs
    no shuffle when neither side is small enough to broadcast."""
    orders, customer, nation, region, supplier, events = _t(
        spark, sf_dir, "orders", "customer", "nation", "region", "supplier", "events")
    sources = b.call_sources(orders, customer, nation, region, supplier, events)
    root = scratch_path(spark, "silver_bucketed")
    cat.create_database(spark, "callcredit_scratch", f"{root}/db")
    suffix = root.rsplit("-", 1)[-1]
    n = bucket_count(sum(path_bytes(spark, f"{sf_dir}/{t}.parquet") for t in ("orders", "events")))
    for name in ("meetings", "details"):
        cat.write_table(sources[name], "callcredit_scratch", f"{name}_{suffix}", path=f"{root}/{name}",
                        bucket_by=(n, ["MeetingId"]))
        sources[name] = cat.read_table(spark, "callcredit_scratch", f"{name}_{suffix}")
    return build_calls(**sources)


@register("invoice_lines_incremental", o.INVOICE_LINES)
def q_invoice_lines_incremental(spark, sf_dir):
    """The invoice table kept up to date: stored as of an earlier state in
    which some invoices named another document, some lines were not void yet
    and some rows existed that the source has dropped since; then updated by
    the rows loaded since and the keys dropped - equal to a full build."""
    orders, lineitem, part, supplier = _t(spark, sf_dir, "orders", "lineitem", "part", "supplier")
    src = b.invoice_sources(orders, lineitem, part, supplier)
    cutoff = F.lit("1999-01-01 00:00:00")
    later = F.col("ETLTimestamp") >= cutoff
    headers, details, works = src["invoice_header"], src["workorder_partdetail"], src["workorder_header"]
    key = F.col("InvoiceNumber").cast("bigint")
    before = dict(src)
    # rows loaded later: a third were absent, the others looked different
    before["invoice_header"] = headers.where(~later | (key % 3 != 0)).withColumn(
        "DocumentNumber", F.when(later, F.concat(b.doc_of(key + 1), F.lit("-X"))).otherwise(F.col("DocumentNumber"))).unionByName(
        headers.where(key % 11 == 0).withColumn("InvoiceNumber", F.concat(F.lit("gone"), F.col("InvoiceNumber"))))
    before["workorder_partdetail"] = details.withColumn(
        "HdrSegInvoiceIndicator", F.when(~later, F.col("HdrSegInvoiceIndicator"))).unionByName(
        details.where(F.col("SegmentNo") == "1").withColumn("WONo", F.concat(F.lit("gone"), F.col("WONo"))))
    before["workorder_header"] = works.unionByName(works.withColumn("WONo", F.concat(F.lit("gone"), F.col("WONo"))))
    root = scratch_path(spark, "invoice_table")
    snapshot.write_snapshot(build_invoice_lines(**before, keep_source=True), root)
    current = snapshot.read_snapshot(spark, root)
    gone = mutate.deleted_keys(current.where(F.col(SOURCE).isNotNull()), source_keys(headers, details), [SOURCE])
    snapshot.write_snapshot(update_invoice_lines(current, changed=later, gone=gone, **src), root)
    return snapshot.read_snapshot(spark, root).drop(SOURCE).withColumn("PartSales", F.col("PartSales").cast("double"))
