"""Domain tables made from the driver's test tables.

The test data is a TPC-H-like star (orders, lineitem, customer, ...) plus an
event stream; none of it holds call-centre tables or document numbers.  Each
function here derives one domain input from those tables with narrow
projections only, so every query's work grows with the data.  The same
derivations are written as SQL in ``oracle.py``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_of(k: Column) -> Column:
    """A document number made from an integer key:
    two digits (k mod 100), a type letter (C, S, R by k mod 3), six digits."""
    letter = F.when(k % 3 == 0, "C").when(k % 3 == 1, "S").otherwise("R")
    return F.concat(F.lpad((k % 100).cast("string"), 2, "0"), letter,
                    F.lpad((k % 1000000).cast("string"), 6, "0"))


def _pad(k: Column, width: int) -> Column:
    return F.lpad(k.cast("string"), width, "0")


# --- revenue inputs -------------------------------------------------------------

def revenue_numbers(orders: DataFrame) -> DataFrame:
    """Calls = customers; each names the documents of its orders.  Every tenth
    order is also named by the next customer, so some documents have two
    mentions."""
    k = F.col("o_orderkey")
    base = orders.select(F.col("o_custkey").alias("MeetingId"), doc_of(k).alias("RootDocumentNumber"))
    extra = (orders.where(k % 10 == 0)
             .select((F.col("o_custkey") + 1).alias("MeetingId"), doc_of(k).alias("RootDocumentNumber")))
    return base.unionByName(extra)


def invoice_sources(orders: DataFrame, lineitem: DataFrame, part: DataFrame,
                    supplier: DataFrame) -> dict[str, DataFrame]:
    k = F.col("o_orderkey")
    make = F.when(k % 5 == 0, F.lit("M9")).otherwise(
        F.concat(F.lit("M"), (F.col("o_custkey") % 7).cast("string")))
    serial = F.col("o_custkey").cast("string")
    prio = F.substring("o_orderpriority", 1, 1)
    invoice_header = orders.select(
        k.cast("string").alias("InvoiceNumber"),
        F.concat(doc_of(k), F.lit("-"), F.col("o_orderstatus")).alias("DocumentNumber"),
        F.col("o_orderdate").alias("OpenDate"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("TotalParts"),
        make.alias("Make"), serial.alias("SerialNumber"),
        F.when(prio == "1", "P").when(prio == "3", "W").otherwise("C").alias("InvoiceType"),
        F.col("o_orderdate").alias("ETLTimestamp"))
    workorder_header = orders.select(
        k.cast("string").alias("WONo"), F.col("o_orderdate").alias("OpenDate"),
        make.alias("EquipManufCode"), serial.alias("SerialNo"),
        F.col("o_orderdate").alias("ETLTimestamp"))
    lk = F.col("l_orderkey")
    workorder_partdetail = lineitem.select(
        lk.cast("string").alias("WONo"), F.col("l_linenumber").cast("string").alias("SegmentNo"),
        F.col("l_partkey").cast("string").alias("PartNo"), F.col("l_suppkey").cast("int").alias("SeqNo"),
        F.concat(doc_of(lk), F.lit("/"), F.col("l_linenumber").cast("string")).alias("RefDocumentNo"),
        (F.col("l_extendedprice").cast("decimal(18,2)") + F.lit(Decimal("0.0040"))).cast("decimal(18,4)").alias("UnitSell"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(2)).otherwise(F.lit(1)).alias("InvoiceQty"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
        .otherwise(F.col("l_returnflag")).alias("HdrSegInvoiceIndicator"),
        F.col("l_shipdate").alias("ETLTimestamp"))
    equipment = part.select(
        F.col("p_partkey").alias("EquipmentId"),
        F.concat(F.lit("M"), (F.col("p_partkey") % 7).cast("string")).alias("OriginalMakeCode"),
        F.col("p_partkey").cast("string").alias("OriginalSerialNumber"))
    s = F.col("s_suppkey")
    conditionsummary = supplier.select(
        (F.expr("s_suppkey div 2") * 7).alias("EquipmentId"),
        F.make_date((s % 5 + 1994).cast("int"), (s % 12 + 1).cast("int"), F.lit(1))
        .cast("timestamp_ntz").alias("ContractStart"),
        F.when(s % 10 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            F.make_date((s % 6 + 1996).cast("int"), ((s * 5) % 12 + 1).cast("int"), F.lit(28))
            .cast("timestamp_ntz")).alias("ContractEnd"))
    return dict(invoice_header=invoice_header, workorder_header=workorder_header,
                workorder_partdetail=workorder_partdetail, equipment=equipment,
                conditionsummary=conditionsummary)


# --- call texts -----------------------------------------------------------------

def _text_columns(k: Column, priority: Column) -> tuple[Column, Column]:
    kind = k % 8
    field = (F.when(k % 17 == 0, F.lit(None).cast("string"))
             .when(kind == 0, doc_of(k))
             .when(kind == 1, F.concat(doc_of(k), F.lit("-"), _pad((k + 7) % 100, 2)))
             .when(kind == 2, F.concat_ws("&", doc_of(k), doc_of(k + 1), doc_of(k + 2)))
             .when(kind == 3, F.lit("no doc"))
             .when(kind == 4, F.concat(F.lit(" "), F.lower(doc_of(k)), F.lit("/")))
             .when(kind == 5, F.concat(F.lit("DOCUMENT "), doc_of(k), F.lit(" "), _pad(k % 10000, 4)))
             .when(kind == 6, F.concat(doc_of(k), (k % 10).cast("string")))
             .otherwise(F.concat((k % 1000).cast("string"), F.lit(" "), doc_of(k), F.lit("_X-"),
                                 _pad(k % 1000000, 7))))
    nk = k % 6
    notes = (F.when(nk == 0, F.concat(F.lit("see "), doc_of(k + 3), F.lit(" and "), doc_of(k + 4),
                                      F.lit("0")))
             .when(nk == 1, priority)
             .when(nk == 2, doc_of(k))
             .when(nk == 3, F.concat(F.lit("<p>"), doc_of(k + 5), F.lit("A&nbsp; "),
                                     k.cast("string"), F.lit("</p>")))
             .when(nk == 4, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lower(doc_of(k + 6)), F.lit(" 12"))))
    return field, notes


def call_texts(orders: DataFrame) -> DataFrame:
    """``MeetingId, PartsDocumentNumber, Notes`` written the way agents type
    them: full numbers, short completions, lists, lower case, junk."""
    k = F.col("o_orderkey")
    field, notes = _text_columns(k, F.col("o_orderpriority"))
    return orders.select(k.alias("MeetingId"), field.alias("PartsDocumentNumber"), notes.alias("Notes"))


# --- call table inputs ----------------------------------------------------------

def branch_phones(supplier: DataFrame) -> DataFrame:
    """Branch phone numbers: one per supplier; branches are nations, so a
    branch number has several names."""
    return supplier.select(
        F.concat(F.lit("PH"), F.col("s_suppkey").cast("string")).alias("PhoneNumber"),
        F.concat(F.lit("B"), F.col("s_nationkey").cast("string")).alias("BranchNo"),
        F.col("s_name").alias("BranchName"))


def call_sources(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame,
                 supplier: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    k = F.col("o_orderkey")
    field, _ = _text_columns(k, F.col("o_orderpriority"))
    meetings = orders.select(
        k.alias("MeetingId"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))).alias("CustomerNo"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("CustomerName"),
        F.concat(F.lit("caller-"), (k % 97).cast("string")).alias("CallerId"),
        F.col("o_orderpriority").alias("ContactName"),
        F.when(k % 4 == 0, "Parts Sale").when(k % 4 == 1, "Tracking an order")
        .when(k % 4 == 2, "Sale with a part number").otherwise("General info/other").alias("Objective"),
        field.alias("PartsDocumentNumber"),
        F.when(k % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PH"), (k % 150).cast("string"))).alias("DialedNumber"),
        F.when((F.col("o_orderstatus") == "P") & (k % 5 == 0), F.lit(2)).otherwise(F.lit(1))
        .alias("ActivityTypeId"),
        F.expr("o_orderdate + INTERVAL 20 YEARS").alias("CallStart"),
        F.expr("o_orderdate + INTERVAL 20 YEARS + make_dt_interval(0, 0, o_orderkey % 600, 0)")
        .alias("EnterDateTime"),
        F.col("o_custkey").alias("EnterXUId"),
        F.when(k % 11 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("PartsCallId"))
    x_user = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("UserId"),
        F.concat(F.lit("user"), F.col("c_nationkey").cast("string")).alias("LoginName"),
        F.when(F.col("c_custkey") % 9 == 0, F.col("n_regionkey") + 1)
        .otherwise(F.col("n_regionkey")).alias("DomainId"))
    ad_user_all = nation.select(
        F.concat(F.lit("user"), F.col("n_nationkey").cast("string")).alias("LoginName"),
        F.col("n_regionkey").alias("DomainId"),
        F.concat(F.lit("First"), F.col("n_nationkey").cast("string")).alias("FirstName"),
        F.col("n_name").alias("LastName"),
        F.concat(F.lit("E"), F.col("n_nationkey").cast("string")).alias("SAPID"))
    hr_corpdir = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("E"), F.col("n_nationkey").cast("string")).alias("EmployeeNumber"),
        F.concat(F.lit("Branch "), F.col("r_name")).alias("PersSubText"))
    branch_phone = branch_phones(supplier)
    et = F.col("event_type")
    details = events.select(
        F.col("event_id").alias("MeetingId"),
        (et == "error").cast("int").alias("IsAfterhours"),
        (et == "view").cast("int").alias("IsService"),
        (et == "click").cast("int").alias("IsUsedRestored"),
        F.when(F.col("value") > 300, F.lit(1)).otherwise(F.lit(0)).alias("IsAgwest"),
        F.concat(F.lit("B"), (F.col("user_id") % 25).cast("string")).alias("BranchNo"),
        F.col("props").alias("Notes"),
        F.when(et == "signup", F.concat(F.lit("EV"), F.col("user_id").cast("string")))
        .alias("PhoneNumber"))
    return dict(meetings=meetings, x_user=x_user, ad_user_all=ad_user_all, hr_corpdir=hr_corpdir,
                branch_phone=branch_phone, details=details)


# --- telephony and serving inputs -------------------------------------------------

# Invented agent first-name prefixes; the fourth never hits the prefix lookup.
AGENT_PREFIXES = ("Amb_", "Bel_", "Cor_", "Dunx")


def reporting_code(regionkey: Column) -> Column:
    """Region r -> reporting code of the group r: two agent codes, one
    unknown code, one queue code, one extension code."""
    return (F.when(regionkey == 0, "520").when(regionkey == 1, "232").when(regionkey == 2, "999")
            .when(regionkey == 3, "11311").otherwise("##502"))


def serving_lookups():
    from .serving import Lookups
    return Lookups(
        branch_region={"NATION_0": "R0", "NATION_1": "R1", "NATION_7": "R7"},
        queue_branch={"Q_click": "Branch A", "Q_view": "Branch B", "Q_error": "Branch C"},
        agent_display={f"{AGENT_PREFIXES[u % 4]}{u}L{u % 5}": f"Agent {u}" for u in range(0, 150, 3)},
        agent_prefix_branch={"Amb_": "Branch A", "Bel_": "Branch B", "Dun_": "Branch D"},
        queue_group_key={"AFRICA": "k-af", "ASIA": "k-as", "EUROPE": "k-eu"},
    )


SERVING_BRANCH_FIXES = {"NATION_1": "NATION ONE", "NATION_2": "NATION TWO"}


def telephony_tables(events: DataFrame, nation: DataFrame, region: DataFrame,
                     customer: DataFrame) -> dict[str, DataFrame]:
    """Telephony configuration and facts.  Groups are one per customer
    account, with a reporting code by the account's region; a group's
    members are the ids of its account's nation; agent, queue and
    extension facts are events keyed by ``user_id mod 25``."""
    accounts = customer.join(nation, customer.c_nationkey == nation.n_nationkey) \
        .join(region, nation.n_regionkey == region.r_regionkey)
    groups = accounts.select(F.col("c_custkey").cast("string").alias("pkey"),
                             reporting_code(F.col("r_regionkey")).alias("reporting"),
                             F.col("r_name").alias("name"))
    out = {}
    for kind in ("agent", "queue", "extension"):
        out[f"tblconfig_{kind}group"] = groups
        out[f"tblconfig_{kind}groupmembers"] = customer.select(
            F.col("c_custkey").cast("string").alias(f"fk{kind}group"),
            F.col("c_nationkey").cast("string").alias(f"fk{kind}"))
    uid = F.col("user_id")
    member = (uid % 25).cast("string")
    first = F.concat(F.element_at(F.array(*[F.lit(p) for p in AGENT_PREFIXES]),
                                  (uid % 4 + 1).cast("int")), uid.cast("string"))
    last = F.concat(F.lit("L"), (uid % 5).cast("string"))
    out["agenteventstats"] = events.select(
        "event_id", member.alias("agentid"), first.alias("agentfirstname"),
        last.alias("agentlastname"), F.col("ts").alias("midnightstartdate"))
    out["agentperformancebyperiodstats"] = events.select(
        "event_id", member.alias("agentid"), first.alias("agentfirstname"),
        last.alias("agentlastname"), F.col("ts").alias("midnightstartdate"),
        F.col("value").alias("talktime"))
    out["queueperformancebyperiodstats"] = events.select(
        "event_id", member.alias("queueid"),
        F.concat(F.lit("Q_"), F.col("event_type")).alias("queuename"),
        F.col("ts").alias("midnightstartdate"))
    out["tbldata_extensionperformancebyperiod"] = events.select(
        "event_id", member.alias("fkextension"), F.col("ts").alias("midnightstartdate"))
    c = F.col("c_custkey")
    out["customeraccount"] = customer.select(
        c.cast("string").alias("CustomerNo"),
        F.when(F.col("c_acctbal") < 0, F.lit(1)).otherwise(F.lit(0)).alias("Internal"),
        F.when(c % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
        .alias("expenditure_5yavg_total"),
        F.when(c % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") / 2)
        .alias("expenditure_5yavg_partsnservices"))
    out["global_branch_address"] = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("addressid"), F.col("n_name").alias("branchname"))
    return out


# --- exploration inputs ---------------------------------------------------------

EVENT_CALL_TYPES = {"view": "Queue Call", "click": "Afterhours", "error": "Direct Call",
                    "signup": "Walk In", "purchase": "Queue Call"}


def explore_calls(events: DataFrame) -> DataFrame:
    """Calls for the exploration queries: one per event; ``value`` is the
    duration in hours (exact to the cent, so sums do not depend on order)."""
    et = F.col("event_type")
    ctype = None
    for k, v in EVENT_CALL_TYPES.items():
        ctype = F.when(et == k, v) if ctype is None else ctype.when(et == k, v)
    eid, uid = F.col("event_id"), F.col("user_id")
    return events.select(
        eid.alias("MeetingID"),
        uid.cast("string").alias("CustomerNo"),
        F.concat(F.lit("Customer "), uid.cast("string")).alias("CustomerName"),
        ctype.alias("CallType"),
        F.concat(F.lit("Obj "), (eid % 7).cast("string")).alias("Objective"),
        F.concat(F.lit("Branch "), (uid % 9).cast("string"), F.lit("  ")).alias("Branch"),
        F.concat(F.lit("Contact "), (eid % 5).cast("string")).alias("Contact"),
        F.col("ts").alias("CallStart"),
        F.when(eid % 97 == 0, F.lit(None).cast("decimal(12,2)"))
        .otherwise(F.col("value").cast("decimal(12,2)")).alias("DurationHours"))


def explore_spend(customer: DataFrame) -> DataFrame:
    """Spend per customer; every third customer's row is there twice."""
    bal = F.col("c_acctbal")
    customer = customer.unionByName(customer.where(F.col("c_custkey") % 3 == 0))
    return customer.select(
        F.col("c_custkey").cast("string").alias("CustomerNo"),
        F.when(bal < 1000, "Small").when(bal < 5000, "Medium").otherwise("Large").alias("Size"),
        F.col("c_mktsegment").alias("SupportReliance"),
        F.concat(F.lit("L"), (F.col("c_nationkey") % 3).cast("string")).alias("Loyalty"),
        F.concat(F.lit("P"), (F.col("c_custkey") % 4).cast("string")).alias("Profitability"),
        bal.alias("Expenditure_5YAVG_PartsNServices"),
        (bal * 2 + 100).alias("Expenditure_5YAVG_Total"))
