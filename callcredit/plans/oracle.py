"""Reference SQL for every registered query (DuckDB dialect).

Each query is written from its published definition - joins, aggregates and
self joins as the original SQL / DataFrame code states them - not from the
Spark plan, so a rewrite in the Spark operator (pre-aggregation instead of a
fan-out join, a semi join instead of a collected list) is checked against
the plain form.  The binding CTEs mirror ``bindings.py``.
"""

from __future__ import annotations


def doc(k: str) -> str:
    return (f"(lpad(cast(({k}) % 100 as varchar), 2, '0') || "
            f"(case ({k}) % 3 when 0 then 'C' when 1 then 'S' else 'R' end) || "
            f"lpad(cast(({k}) % 1000000 as varchar), 6, '0'))")


def pad(k: str, width: int) -> str:
    return f"lpad(cast({k} as varchar), {width}, '0')"


NUMBERS = f"""
numbers AS (
  SELECT o_custkey AS MeetingId, {doc('o_orderkey')} AS RootDocumentNumber FROM orders
  UNION ALL
  SELECT o_custkey + 1, {doc('o_orderkey')} FROM orders WHERE o_orderkey % 10 = 0
)"""

_MAKE = "(CASE WHEN o_orderkey % 5 = 0 THEN 'M9' ELSE 'M' || cast(o_custkey % 7 as varchar) END)"

INVOICE_SOURCES = f"""
invoice_header AS (
  SELECT cast(o_orderkey as varchar) AS InvoiceNumber,
         {doc('o_orderkey')} || '-' || o_orderstatus AS DocumentNumber,
         o_orderdate AS OpenDate, cast(o_totalprice as decimal(18,2)) AS TotalParts,
         {_MAKE} AS Make, cast(o_custkey as varchar) AS SerialNumber,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'P' WHEN '3' THEN 'W' ELSE 'C' END AS InvoiceType
  FROM orders),
workorder_header AS (
  SELECT cast(o_orderkey as varchar) AS WONo, o_orderdate AS OpenDate,
         {_MAKE} AS EquipManufCode, cast(o_custkey as varchar) AS SerialNo
  FROM orders),
workorder_partdetail AS (
  SELECT cast(l_orderkey as varchar) AS WONo,
         {doc('l_orderkey')} || '/' || cast(l_linenumber as varchar) AS RefDocumentNo,
         cast(cast(l_extendedprice as decimal(18,2)) + 0.0040 as decimal(18,4)) AS UnitSell,
         CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE 1 END AS InvoiceQty,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS HdrSegInvoiceIndicator
  FROM lineitem),
equipment AS (
  SELECT p_partkey AS EquipmentId, 'M' || cast(p_partkey % 7 as varchar) AS OriginalMakeCode,
         cast(p_partkey as varchar) AS OriginalSerialNumber
  FROM part),
conditionsummary AS (
  SELECT (s_suppkey // 2) * 7 AS EquipmentId,
         cast(make_date(cast(s_suppkey % 5 + 1994 as int), cast(s_suppkey % 12 + 1 as int), 1) as timestamp) AS ContractStart,
         CASE WHEN s_suppkey % 10 = 0 THEN NULL
              ELSE cast(make_date(cast(s_suppkey % 6 + 1996 as int), cast((s_suppkey * 5) % 12 + 1 as int), 28) as timestamp)
         END AS ContractEnd
  FROM supplier)"""

INVOICE_LINES_SQL = """
machine_contract AS (
  SELECT eq.OriginalMakeCode AS make, eq.OriginalSerialNumber AS serial,
         cast(cs.ContractStart as date) AS ContractStart, cast(cs.ContractEnd as date) AS ContractEnd
  FROM equipment eq LEFT JOIN conditionsummary cs ON cs.EquipmentId = eq.EquipmentId),
parts_invoice AS (
  SELECT left(DocumentNumber, 9) AS RootDocumentNumber, cast(OpenDate as date) AS OpenDate,
         cast(TotalParts as decimal(28,6)) AS PartSales, Make AS make, SerialNumber AS serial
  FROM invoice_header
  WHERE InvoiceType IN ('P', 'C') AND substr(DocumentNumber, 3, 1) IN ('C', 'R')),
workorder_part AS (
  SELECT left(d.RefDocumentNo, 9) AS RootDocumentNumber, cast(h.OpenDate as date) AS OpenDate,
         cast(d.UnitSell * d.InvoiceQty as decimal(28,6)) AS PartSales, h.EquipManufCode AS make,
         h.SerialNo AS serial
  FROM workorder_partdetail d JOIN workorder_header h ON h.WONo = d.WONo
  WHERE d.HdrSegInvoiceIndicator IS NULL AND substr(d.RefDocumentNo, 3, 1) = 'S'),
invoice_lines AS (
  SELECT li.RootDocumentNumber, li.OpenDate, li.PartSales, mc.ContractStart, mc.ContractEnd
  FROM (SELECT * FROM parts_invoice UNION ALL SELECT * FROM workorder_part) li
  LEFT JOIN machine_contract mc ON mc.make = li.make AND mc.serial = li.serial)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


REVENUE_STRICT = with_(NUMBERS, INVOICE_SOURCES, INVOICE_LINES_SQL, """
joined AS (
  SELECT n.MeetingId, n.RootDocumentNumber, l.PartSales, l.OpenDate, l.ContractStart, l.ContractEnd
  FROM numbers n LEFT JOIN invoice_lines l USING (RootDocumentNumber)),
per_doc AS (
  SELECT RootDocumentNumber, sum(PartSales) AS PartSales, min(OpenDate) AS OpenDate,
         min(ContractStart) AS ContractStart, max(ContractEnd) AS ContractEnd,
         CASE WHEN min(OpenDate) BETWEEN min(ContractStart) AND max(ContractEnd) THEN 1 ELSE 0 END AS OnContract
  FROM joined GROUP BY RootDocumentNumber)""") + """
SELECT j.MeetingId,
       coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), '') AS RootDocumentNumber,
       cast(sum(j.PartSales) as double) AS PartSales,
       cast(coalesce(sum(a.OnContract), 0) as bigint) AS OnContract,
       nullif(regexp_extract(coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), ''), '([CS])', 0), '') AS SalesType
FROM joined j
LEFT JOIN per_doc a
  ON j.RootDocumentNumber = a.RootDocumentNumber AND j.PartSales = a.PartSales AND j.OpenDate = a.OpenDate
 AND j.ContractStart = a.ContractStart AND j.ContractEnd = a.ContractEnd
GROUP BY j.MeetingId"""

REVENUE_BY_DOCUMENT = with_(NUMBERS, INVOICE_SOURCES, INVOICE_LINES_SQL, """
joined AS (
  SELECT n.MeetingId, n.RootDocumentNumber, l.PartSales
  FROM numbers n LEFT JOIN invoice_lines l USING (RootDocumentNumber)),
per_doc AS (
  SELECT RootDocumentNumber,
         CASE WHEN min(OpenDate) BETWEEN min(ContractStart) AND max(ContractEnd) THEN 1 ELSE 0 END AS OnContract
  FROM invoice_lines GROUP BY RootDocumentNumber)""") + """
SELECT j.MeetingId,
       coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), '') AS RootDocumentNumber,
       cast(sum(j.PartSales) as double) AS PartSales,
       cast(coalesce(sum(a.OnContract), 0) as bigint) AS OnContract,
       nullif(regexp_extract(coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), ''), '([CS])', 0), '') AS SalesType
FROM joined j LEFT JOIN per_doc a USING (RootDocumentNumber)
GROUP BY j.MeetingId"""

INVOICE_LINES = with_(INVOICE_SOURCES, INVOICE_LINES_SQL) + """
SELECT RootDocumentNumber, OpenDate, cast(PartSales as double) AS PartSales, ContractStart, ContractEnd
FROM invoice_lines"""

AGGREGATE_INVOICE = with_(INVOICE_SOURCES, INVOICE_LINES_SQL) + """
SELECT RootDocumentNumber, cast(sum(PartSales) as double) AS PartSales, min(OpenDate) AS OpenDate,
       min(ContractStart) AS ContractStart, max(ContractEnd) AS ContractEnd,
       CASE WHEN min(OpenDate) BETWEEN min(ContractStart) AND max(ContractEnd) THEN 1 ELSE 0 END AS OnContract
FROM invoice_lines GROUP BY RootDocumentNumber"""


# --- document numbers -------------------------------------------------------------

def _field(k: str = "o_orderkey") -> str:
    return f"""(CASE WHEN {k} % 17 = 0 THEN NULL
      WHEN {k} % 8 = 0 THEN {doc(k)}
      WHEN {k} % 8 = 1 THEN {doc(k)} || '-' || {pad(f'({k} + 7) % 100', 2)}
      WHEN {k} % 8 = 2 THEN concat_ws('&', {doc(k)}, {doc(k + ' + 1')}, {doc(k + ' + 2')})
      WHEN {k} % 8 = 3 THEN 'no doc'
      WHEN {k} % 8 = 4 THEN ' ' || lower({doc(k)}) || '/'
      WHEN {k} % 8 = 5 THEN 'DOCUMENT ' || {doc(k)} || ' ' || {pad(f'{k} % 10000', 4)}
      WHEN {k} % 8 = 6 THEN {doc(k)} || cast({k} % 10 as varchar)
      ELSE cast({k} % 1000 as varchar) || ' ' || {doc(k)} || '_X-' || {pad(f'{k} % 1000000', 7)} END)"""


def _notes(k: str = "o_orderkey") -> str:
    return f"""(CASE WHEN {k} % 6 = 0 THEN 'see ' || {doc(k + ' + 3')} || ' and ' || {doc(k + ' + 4')} || '0'
      WHEN {k} % 6 = 1 THEN o_orderpriority
      WHEN {k} % 6 = 2 THEN {doc(k)}
      WHEN {k} % 6 = 3 THEN '<p>' || {doc(k + ' + 5')} || 'A&nbsp; ' || cast({k} as varchar) || '</p>'
      WHEN {k} % 6 = 4 THEN NULL
      ELSE lower({doc(k + ' + 6')}) || ' 12' END)"""


CALL_TEXTS = f"""
call_texts AS (
  SELECT o_orderkey AS MeetingId, {_field()} AS PartsDocumentNumber, {_notes()} AS Notes FROM orders)"""

_FULL = "[0-9]{2}[A-Z][0-9]{6}"
_STRIP = "e' \\t\\n\\r\\x0b\\x0c'"
_ACCEPT = (f"(regexp_extract(t, '{_FULL}', 0) <> '' AND "
           f"(length(t) = 9 OR NOT regexp_matches(substr(t, 10, 1), '^[0-9]$')))")
_SHORT = "regexp_matches(t, '^[0-9]{1,6}$')"


def _fold(text_col: str, complete_short: bool) -> str:
    toks = f"regexp_split_to_array(upper(trim({text_col}, {_STRIP})), '\\W+')"
    if complete_short:
        keep = f"list_filter({toks}, lambda t: {_ACCEPT} OR {_SHORT})"
        body = (f"CASE WHEN {_ACCEPT} THEN list_append(acc, regexp_extract(t, '{_FULL}', 0)) "
                f"WHEN {_SHORT} AND len(acc) > 0 THEN list_append(acc, substr(acc[-1], 1, 9 - length(t)) || t) "
                f"ELSE acc END")
    else:
        keep = f"list_filter({toks}, lambda t: {_ACCEPT})"
        body = f"CASE WHEN {_ACCEPT} THEN list_append(acc, regexp_extract(t, '{_FULL}', 0)) ELSE acc END"
    return f"list_reduce({keep}, lambda acc, t: {body}, []::varchar[])"


def _extract_sql(text_col: str, complete_short: bool) -> str:
    return f"""SELECT MeetingId, unnest({_fold(text_col, complete_short)}) AS RootDocumentNumber
  FROM call_texts WHERE regexp_matches(upper({text_col}), '{_FULL}')"""


ROOT_DOC_SALES_BODY = f"""
SELECT left({doc('l_orderkey')} || '/' || cast(l_linenumber as varchar), 9) AS RootPDN,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) AS TotalPartSales
FROM lineitem GROUP BY 1"""

DOCNUM_FIELD = with_(CALL_TEXTS) + f"""
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('PartsDocumentNumber', True)}) x
WHERE length(RootDocumentNumber) <> 0"""

DOCNUM_NOTES = with_(CALL_TEXTS) + f"""
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) x
WHERE length(RootDocumentNumber) <> 0"""

DOCNUM_ALL_REPEATS = with_(CALL_TEXTS) + f"""
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('PartsDocumentNumber', True)}) x
UNION ALL
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) y"""

DOCNUM_ALL = with_(CALL_TEXTS) + f"""
SELECT DISTINCT MeetingId, RootDocumentNumber FROM (
  SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('PartsDocumentNumber', True)}) x
  UNION ALL
  SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) y) z"""

_LEGACY_FIELD = f"upper(trim(PartsDocumentNumber, {_STRIP}))"
_LEGACY_NOTES = f"upper(trim(Notes, {_STRIP}))"

LEGACY_CTES = (f"""
field_matches AS (
  SELECT MeetingId, regexp_extract_all({_LEGACY_FIELD}, '({_FULL}|\\b[0-9]+)', 1) AS m
  FROM call_texts WHERE coalesce(regexp_matches({_LEGACY_FIELD}, '^{_FULL}'), false)),
field_numbers AS (
  SELECT MeetingId, unnest(list_transform(m, lambda x: CASE WHEN length(x) <= 6
           THEN substr(m[1], 1, 9 - length(x)) || x ELSE x END)) AS RootDocumentNumber
  FROM field_matches),
notes_numbers AS (
  SELECT MeetingId, unnest(regexp_extract_all({_LEGACY_NOTES}, '({_FULL})', 1)) AS RootDocumentNumber
  FROM call_texts WHERE Notes IS NOT NULL),
legacy_numbers AS (
  SELECT DISTINCT MeetingId, RootDocumentNumber FROM (
    SELECT * FROM field_numbers UNION ALL SELECT * FROM notes_numbers) u
  WHERE RootDocumentNumber IS NOT NULL)""")

DOCNUM_LEGACY = with_(CALL_TEXTS, LEGACY_CTES) + "SELECT * FROM legacy_numbers"

CALLS_WITH_REVENUE = with_(CALL_TEXTS, LEGACY_CTES, f"""
sales AS ({ROOT_DOC_SALES_BODY}),
per_call AS (
  SELECT n.MeetingId,
         string_agg(DISTINCT n.RootDocumentNumber, ', ' ORDER BY n.RootDocumentNumber) AS RootPDN,
         coalesce(cast(sum(cast(s.TotalPartSales as decimal(38,6))) as double), 0.0) AS TotalPartSales
  FROM legacy_numbers n LEFT JOIN sales s ON n.RootDocumentNumber = s.RootPDN
  GROUP BY n.MeetingId)""") + """
SELECT c.MeetingId, trim(c.Branch) AS Branch, p.RootPDN, p.TotalPartSales,
       nullif(regexp_extract(p.RootPDN, '([CS])', 0), '') AS SalesType
FROM (SELECT t.MeetingId, 'Branch ' || cast(o.o_custkey % 9 as varchar) || '  ' AS Branch
      FROM call_texts t JOIN orders o ON t.MeetingId = o.o_orderkey) c
LEFT JOIN per_call p ON c.MeetingId = p.MeetingId"""


# --- call table -------------------------------------------------------------------

CALL_SOURCES = f"""
meetings AS (
  SELECT o_orderkey AS MeetingId,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE ' ' || cast(o_custkey as varchar) || ' ' END AS CustomerNo,
         'Customer ' || cast(o_custkey as varchar) AS CustomerName,
         'caller-' || cast(o_orderkey % 97 as varchar) AS CallerId,
         o_orderpriority AS ContactName,
         CASE o_orderkey % 4 WHEN 0 THEN 'Parts Sale' WHEN 1 THEN 'Tracking an order'
              WHEN 2 THEN 'Sale with a part number' ELSE 'General info/other' END AS Objective,
         {_field()} AS PartsDocumentNumber,
         CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'PH' || cast(o_orderkey % 150 as varchar) END AS DialedNumber,
         CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS ActivityTypeId,
         o_orderdate + INTERVAL 20 YEAR AS CallStart,
         o_orderdate + INTERVAL 20 YEAR + to_minutes(o_orderkey % 600) AS EnterDateTime, o_custkey AS EnterXUId,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey END AS PartsCallId
  FROM orders),
x_user AS (
  SELECT c_custkey AS UserId, 'user' || cast(c_nationkey as varchar) AS LoginName,
         CASE WHEN c_custkey % 9 = 0 THEN n_regionkey + 1 ELSE n_regionkey END AS DomainId
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
ad_user_all AS (
  SELECT 'user' || cast(n_nationkey as varchar) AS LoginName, n_regionkey AS DomainId,
         'First' || cast(n_nationkey as varchar) AS FirstName, n_name AS LastName,
         'E' || cast(n_nationkey as varchar) AS SAPID
  FROM nation),
hr_corpdir AS (
  SELECT 'E' || cast(n_nationkey as varchar) AS EmployeeNumber, 'Branch ' || r_name AS PersSubText
  FROM nation JOIN region ON n_regionkey = r_regionkey),
global_branch_phone AS (
  SELECT 'PH' || cast(s_suppkey as varchar) AS PhoneNumber, 'B' || cast(s_nationkey as varchar) AS BranchNo,
         s_name AS BranchName
  FROM supplier),
phonecall_extdetails AS (
  SELECT event_id AS MeetingId, cast(event_type = 'error' as int) AS IsAfterhours,
         cast(event_type = 'view' as int) AS IsService, cast(event_type = 'click' as int) AS IsUsedRestored,
         CASE WHEN value > 300 THEN 1 ELSE 0 END AS IsAgwest,
         'B' || cast(user_id % 25 as varchar) AS BranchNo, props AS Notes,
         CASE WHEN event_type = 'signup' THEN 'EV' || cast(user_id as varchar) END AS PhoneNumber
  FROM events)"""

CALL_TABLE_SQL = """
in_scope AS (
  SELECT * FROM meetings WHERE PartsCallId IS NOT NULL AND year(CallStart) >= 2017),
entered_by AS (
  SELECT usr.UserId, ppl.FirstName || ' ' || ppl.LastName AS Contact, emp.PersSubText AS Branch
  FROM x_user usr
  LEFT JOIN ad_user_all ppl ON ppl.LoginName = usr.LoginName AND ppl.DomainId = usr.DomainId
  LEFT JOIN hr_corpdir emp ON emp.EmployeeNumber = ppl.SAPID),
branch_first_name AS (
  -- first name of each branch number in name order, a missing name first
  SELECT BranchNo, CASE WHEN count(*) > count(BranchName) THEN NULL ELSE min(BranchName) END AS BranchName
  FROM global_branch_phone GROUP BY BranchNo),
call_detail AS (
  SELECT det.MeetingId, det.IsAfterhours, det.IsService, det.IsUsedRestored, det.Notes,
         det.PhoneNumber AS DetailPhone, det.BranchNo AS DetailBranchNo, bfn.BranchName AS DetailBranchName
  FROM phonecall_extdetails det LEFT JOIN branch_first_name bfn ON bfn.BranchNo = det.BranchNo
  WHERE det.IsAgwest = 0),
call_table AS (
  SELECT cl.MeetingId,
         trim(coalesce(cl.CustomerNo, '')) AS CustomerNo,
         cl.CustomerName,
         coalesce(cd.DetailPhone, cl.CallerId) AS CallerId,
         cl.ContactName AS Influencer,
         eb.Contact, eb.Branch,
         cl.Objective, cl.PartsDocumentNumber,
         coalesce(cd.Notes, '') AS Notes,
         cl.DialedNumber,
         coalesce(ph.BranchNo, cd.DetailBranchNo, '') AS DialedBranchNo,
         coalesce(ph.BranchName, cd.DetailBranchName, '') AS DialedBranchName,
         CASE WHEN cl.ActivityTypeId = 2 THEN 'Walk In'
              WHEN cd.IsAfterhours = 1 THEN 'Afterhours'
              WHEN cd.IsService = 1 THEN 'Service'
              WHEN cd.IsUsedRestored = 1 THEN 'Used/Restored'
              WHEN cl.DialedNumber IS NULL THEN 'Direct Call'
              ELSE 'Queue Call' END AS CallType,
         cl.CallStart,
         cl.EnterDateTime AS CallSaved
  FROM in_scope cl
  LEFT JOIN entered_by eb ON eb.UserId = cl.EnterXUId
  LEFT JOIN global_branch_phone ph ON ph.PhoneNumber = cl.DialedNumber
  LEFT JOIN call_detail cd ON cd.MeetingId = cl.MeetingId)"""

CALL_TABLE = with_(CALL_SOURCES, CALL_TABLE_SQL) + "SELECT * FROM call_table"

FIRST_PER_KEY = """
SELECT BranchNo, BranchName FROM (
  SELECT 'B' || cast(s_nationkey as varchar) AS BranchNo, s_name AS BranchName,
         row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name NULLS FIRST) AS rn
  FROM supplier) t WHERE rn = 1"""


# --- serving ----------------------------------------------------------------------

def values_cte(name: str, mapping: dict[str, str]) -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({q(k)}, {q(v)})" for k, v in mapping.items())
    return f"\n{name}(k, v) AS (VALUES {rows})"


def serving_sql():
    from ..config import AGENT_GROUP_CODES, EXTENSION_GROUP_CODES, QUEUE_GROUP_CODES
    from .bindings import AGENT_PREFIXES, SERVING_BRANCH_FIXES, serving_lookups
    lk = serving_lookups()

    def codes(c):
        return ", ".join("'" + x + "'" for x in c)

    prefixes = ", ".join("'" + p + "'" for p in AGENT_PREFIXES)
    groups = """
groups AS (
  SELECT cast(c_custkey as varchar) AS pkey,
         CASE r_regionkey WHEN 0 THEN '520' WHEN 1 THEN '232' WHEN 2 THEN '999' WHEN 3 THEN '11311'
              ELSE '##502' END AS reporting,
         r_name AS name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
members AS (
  SELECT cast(c_custkey as varchar) AS fkgroup, cast(c_nationkey as varchar) AS fkmember FROM customer)"""
    agents = f"""
agents AS (
  SELECT event_id, cast(user_id % 25 as varchar) AS agentid,
         [{prefixes}][user_id % 4 + 1] || cast(user_id as varchar) AS agentfirstname,
         'L' || cast(user_id % 5 as varchar) AS agentlastname, ts AS midnightstartdate, value AS talktime
  FROM events)"""

    def member_in(col, c):
        return (f"{col} IN (SELECT m.fkmember FROM members m JOIN groups g ON m.fkgroup = g.pkey "
                f"WHERE g.reporting IN ({codes(c)}))")

    agent_select = f"""
SELECT a.event_id, a.agentid, a.agentfirstname, a.agentlastname, a.midnightstartdate, {{extra}}
       dn.v AS pop_name, pb.v AS branch, cast(a.midnightstartdate as date) AS date
FROM agents a
LEFT JOIN agent_display dn ON a.agentfirstname || '' || a.agentlastname = dn.k
LEFT JOIN agent_prefix pb ON substr(a.agentfirstname, 1, 4) = pb.k
WHERE {member_in('a.agentid', AGENT_GROUP_CODES)}"""
    agent_ctes = with_(groups, agents, values_cte("agent_display", lk.agent_display),
                       values_cte("agent_prefix", lk.agent_prefix_branch))
    out = {}
    out["serve_agent_events"] = agent_ctes + agent_select.replace("{extra}", "")
    out["serve_agent_performance"] = agent_ctes + agent_select.replace("{extra}", "a.talktime,")
    out["serve_agent_names"] = with_(groups, agents, values_cte("agent_display", lk.agent_display),
                                     CALL_SOURCES, CALL_TABLE_SQL) + f"""
SELECT DISTINCT pop_name FROM (
  SELECT dn.v AS pop_name FROM agents a
  LEFT JOIN agent_display dn ON a.agentfirstname || '' || a.agentlastname = dn.k
  WHERE {member_in('a.agentid', AGENT_GROUP_CODES)}
  UNION ALL
  SELECT Contact FROM call_table) u
WHERE pop_name IS NOT NULL"""
    out["serve_queue_performance"] = with_(groups, values_cte("queue_branch", lk.queue_branch)) + f"""
SELECT e.event_id, cast(e.user_id % 25 as varchar) AS queueid, 'Q_' || e.event_type AS queuename,
       e.ts AS midnightstartdate, qb.v AS branch, cast(e.ts as date) AS date
FROM events e LEFT JOIN queue_branch qb ON 'Q_' || e.event_type = qb.k
WHERE {member_in('cast(e.user_id % 25 as varchar)', QUEUE_GROUP_CODES)}"""
    out["serve_extension_performance"] = with_(groups) + f"""
SELECT event_id, cast(user_id % 25 as varchar) AS fkextension, ts AS midnightstartdate,
       cast(ts as date) AS date
FROM events WHERE {member_in('cast(user_id % 25 as varchar)', EXTENSION_GROUP_CODES)}"""
    for kind in ("agent", "queue", "extension"):
        out[f"serve_{kind}_group_members"] = with_(groups) + f"SELECT fkgroup AS fk{kind}group, fkmember AS fk{kind} FROM members"
        if kind != "queue":
            out[f"serve_{kind}_group"] = with_(groups) + "SELECT * FROM groups"
    out["serve_queue_group"] = with_(groups, values_cte("gk", lk.queue_group_key)) + """
SELECT g.pkey, g.reporting, g.name, coalesce(gk.v, 'not found') AS join_key
FROM groups g LEFT JOIN gk ON g.name = gk.k"""
    fixes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERVING_BRANCH_FIXES.items())
    out["serve_branch_address"] = with_(values_cte("br", lk.branch_region)) + f"""
SELECT c_custkey AS addressid, n_name AS branchname, CASE n_name {fixes} ELSE n_name END AS branch_pbi,
       br.v AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN br ON n_name = br.k"""
    out["serve_customer_account"] = """
SELECT CustomerNo, Internal, coalesce(expenditure_5yavg_total, 0) AS expenditure_5yavg_total,
       coalesce(expenditure_5yavg_partsnservices, 0) AS expenditure_5yavg_partsnservices
FROM (SELECT cast(c_custkey as varchar) AS CustomerNo, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS Internal,
             CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS expenditure_5yavg_total,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal / 2 END AS expenditure_5yavg_partsnservices
      FROM customer) t
WHERE Internal = 0"""
    out["serve_call_table"] = with_(CALL_SOURCES, CALL_TABLE_SQL) + """
SELECT *, CASE WHEN Objective IN ('Sale with a part number', 'Sale without part number', 'Parts Sale')
               THEN 'Direct' ELSE 'Indirect' END AS contribution,
       cast(CallStart as date) AS date
FROM call_table"""
    return out


# --- exploration ------------------------------------------------------------------

EXPLORE_CALLS = """
calls AS (
  SELECT event_id AS MeetingID, cast(user_id as varchar) AS CustomerNo,
         'Customer ' || cast(user_id as varchar) AS CustomerName,
         CASE event_type WHEN 'view' THEN 'Queue Call' WHEN 'click' THEN 'Afterhours'
              WHEN 'error' THEN 'Direct Call' WHEN 'signup' THEN 'Walk In' WHEN 'purchase' THEN 'Queue Call' END AS CallType,
         'Obj ' || cast(event_id % 7 as varchar) AS Objective,
         'Branch ' || cast(user_id % 9 as varchar) || '  ' AS Branch,
         'Contact ' || cast(event_id % 5 as varchar) AS Contact,
         ts AS CallStart,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE cast(value as decimal(12,2)) END AS DurationHours
  FROM events),
queues AS (SELECT * FROM calls WHERE CallType = 'Queue Call'),
afterhours AS (SELECT * FROM calls WHERE CallType = 'Afterhours')"""

EXPLORE_SPEND = """
spend_raw AS (
  SELECT cast(c_custkey as varchar) AS CustomerNo,
         CASE WHEN c_acctbal < 1000 THEN 'Small' WHEN c_acctbal < 5000 THEN 'Medium' ELSE 'Large' END AS Size,
         c_mktsegment AS SupportReliance,
         'L' || cast(c_nationkey % 3 as varchar) AS Loyalty,
         'P' || cast(c_custkey % 4 as varchar) AS Profitability,
         c_acctbal AS Expenditure_5YAVG_PartsNServices,
         c_acctbal * 2 + 100 AS Expenditure_5YAVG_Total
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 3 = 0)),
spend_clean AS (SELECT DISTINCT * FROM spend_raw WHERE Expenditure_5YAVG_PartsNServices >= 0),
spend AS (
  SELECT s.*,
    cast(trunc(rank() OVER (ORDER BY Expenditure_5YAVG_PartsNServices DESC)
         + (count(*) OVER (PARTITION BY Expenditure_5YAVG_PartsNServices) - 1) / 2.0) as int) AS ExpPNSRank,
    cast(trunc(rank() OVER (ORDER BY Expenditure_5YAVG_Total DESC)
         + (count(*) OVER (PARTITION BY Expenditure_5YAVG_Total) - 1) / 2.0) as int) AS ExpTotalRank
  FROM spend_clean s)"""


def per_key_sql(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""(SELECT {k}, count(MeetingID) AS TotalCalls,
        cast(coalesce(sum(DurationHours), 0) as double) AS TotalHours,
        cast(coalesce(sum(DurationHours), 0) as double) / cast(count(MeetingID) as double) * 60.0 AS MinPerCall
      FROM {src} WHERE {nn} GROUP BY {k})"""


def top_sql(src: str, keys: list[str], sort_by: str = "TotalHours", n: int = 10) -> str:
    order = ", ".join([f"{sort_by} DESC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in keys])
    return f"(SELECT * FROM {per_key_sql(src, keys)} p ORDER BY {order} LIMIT {n})"


def top_with_total_sql(src: str, keys: list[str], sort_by: str = "TotalHours") -> str:
    nulls = ", ".join(f"NULL AS {c}" for c in keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys + ["MeetingID", "DurationHours"])
    return with_(EXPLORE_CALLS) + f"""
SELECT *, false AS is_total FROM {top_sql(src, keys, sort_by)} t
UNION ALL
SELECT {nulls}, count(MeetingID), cast(coalesce(sum(DurationHours), 0) as double),
       cast(coalesce(sum(DurationHours), 0) as double) / cast(count(MeetingID) as double) * 60.0, true
FROM {src} WHERE {nn}"""


_CUST = ["CustomerNo", "CustomerName"]

TOP_WITH_TOTAL = top_with_total_sql("queues", _CUST)
TOP_BY_CALLS = top_with_total_sql("afterhours", _CUST, "TotalCalls")
TOP_OBJECTIVES = top_with_total_sql("queues", ["Objective"])
TOP_BRANCHES = top_with_total_sql("afterhours", ["Branch", "Contact"])
TOP_QUEUE_BRANCHES = top_with_total_sql("queues", ["Branch", "Contact"])
TOP_AFTERHOURS_OBJECTIVES = top_with_total_sql("afterhours", ["Objective"])

TOP_MEASURES_SUM = with_(EXPLORE_CALLS) + f"""
SELECT cast(sum(TotalCalls) as bigint) AS TotalCalls, cast(sum(cast(TotalHours as decimal(38,6))) as double) AS TotalHours,
       cast(sum(cast(MinPerCall as decimal(38,10))) as double) AS MinPerCall
FROM {top_sql('calls', _CUST)} t"""

_PIVOT_VALUES = ["Queue Call", "Afterhours", "Direct Call", "Walk In"]


def _pivot_counts() -> str:
    return ", ".join(f"count(CASE WHEN CallType = '{v}' THEN MeetingID END) AS {v.replace(' ', '_')}"
                     for v in _PIVOT_VALUES)


PIVOT_WITH_TOTALS = with_(EXPLORE_CALLS) + f"""
SELECT *, false AS is_total FROM (
  SELECT CustomerNo, CustomerName, {_pivot_counts()},
         count(CASE WHEN CallType IS NOT NULL THEN MeetingID END) AS Total
  FROM calls WHERE CustomerNo IS NOT NULL AND CustomerName IS NOT NULL
  GROUP BY CustomerNo, CustomerName
  ORDER BY Total DESC NULLS LAST, CustomerNo, CustomerName LIMIT 10) t
UNION ALL
SELECT NULL, NULL, {_pivot_counts()}, count(MeetingID), true
FROM calls WHERE CustomerNo IS NOT NULL AND CustomerName IS NOT NULL AND CallType IS NOT NULL
  AND MeetingID IS NOT NULL"""

CALLS_HOURS_BY_CUSTOMER = with_(EXPLORE_CALLS) + """
SELECT CustomerNo, count(MeetingID) AS TotalCalls, cast(coalesce(sum(DurationHours), 0) as double) AS TotalHours
FROM calls WHERE CustomerNo IS NOT NULL GROUP BY CustomerNo"""

CALLS_HOURS_CORR = with_(EXPLORE_CALLS) + """
SELECT round(corr(TotalCalls, TotalHours), 6) AS corr_calls_hours FROM (
  SELECT CustomerNo, count(MeetingID) AS TotalCalls, cast(coalesce(sum(DurationHours), 0) as double) AS TotalHours
  FROM calls WHERE CustomerNo IS NOT NULL GROUP BY CustomerNo) t"""

PARETO = with_(EXPLORE_CALLS) + f"""
, top AS {top_sql('queues', _CUST)},
per_item AS (
  SELECT q.CustomerNo, q.CustomerName, q.Objective, coalesce(sum(q.DurationHours), 0) AS h
  FROM queues q WHERE q.CustomerNo IS NOT NULL AND q.CustomerName IS NOT NULL AND q.Objective IS NOT NULL
    AND EXISTS (SELECT 1 FROM top t WHERE t.CustomerNo = q.CustomerNo AND t.CustomerName = q.CustomerName)
  GROUP BY q.CustomerNo, q.CustomerName, q.Objective),
shares AS (
  SELECT CustomerNo, CustomerName, Objective, cast(h as double) AS TotalHours,
    cast(h as double) / cast(sum(h) OVER (PARTITION BY CustomerNo, CustomerName) as double) * 100.0 AS PctTotal,
    cast(sum(h) OVER (PARTITION BY CustomerNo, CustomerName ORDER BY h DESC, Objective ASC
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) as double)
      / cast(sum(h) OVER (PARTITION BY CustomerNo, CustomerName) as double) * 100.0 AS PctTotalCumSum
  FROM per_item)
SELECT * FROM shares WHERE PctTotalCumSum <= 90.0"""

AVG_RANK = with_(EXPLORE_SPEND) + "SELECT * FROM spend"

_TOP_Q = top_sql("queues", _CUST)

SPEND_PER_HOUR = with_(EXPLORE_CALLS, EXPLORE_SPEND) + f"""
SELECT t.CustomerNo, t.TotalCalls, t.TotalHours, s.Expenditure_5YAVG_PartsNServices, s.ExpPNSRank, s.ExpTotalRank,
       s.Expenditure_5YAVG_PartsNServices / nullif(t.TotalHours, 0) AS ExpPerHour,
       row_number() OVER (ORDER BY t.TotalHours DESC, t.CustomerNo)::INT AS Place
FROM {_TOP_Q} t JOIN spend s ON t.CustomerNo = s.CustomerNo"""

_SEGMENTS = ["Loyalty", "Size", "SupportReliance", "Profitability"]
_SEG_BASE = f"""
, per_customer AS (
  SELECT p.*, {', '.join('s.' + x for x in _SEGMENTS)}
  FROM {per_key_sql('queues', _CUST)} p LEFT JOIN spend s ON p.CustomerNo = s.CustomerNo)"""

SEGMENT_SHARE = with_(EXPLORE_CALLS, EXPLORE_SPEND) + _SEG_BASE + f""",
grouped AS (
  SELECT {', '.join(_SEGMENTS)}, sum(cast(TotalHours as decimal(38,6))) AS m FROM per_customer
  WHERE {' AND '.join(x + ' IS NOT NULL' for x in _SEGMENTS)} GROUP BY {', '.join(_SEGMENTS)})
SELECT {', '.join(_SEGMENTS)},
       cast(m as double) * 100.0 / cast((SELECT sum(m) FROM grouped) as double) AS PctTotalHours
FROM grouped
ORDER BY PctTotalHours DESC NULLS LAST, {', '.join(x + ' ASC NULLS LAST' for x in _SEGMENTS)}
LIMIT 11"""

_EACH = ["Size", "Loyalty", "SupportReliance", "Profitability"]

SEGMENT_SHARE_EACH = with_(EXPLORE_CALLS, EXPLORE_SPEND) + _SEG_BASE + ",\nlong AS (" + \
    " UNION ALL ".join(f"SELECT '{s}' AS segment, cast({s} as varchar) AS value, "
                       f"cast(TotalHours as decimal(38,6)) AS m "
                       f"FROM per_customer WHERE {s} IS NOT NULL" for s in _EACH) + """),
grouped AS (SELECT segment, value, sum(m) AS m FROM long GROUP BY segment, value)
SELECT segment, value,
       cast(m as double) / cast(sum(m) OVER (PARTITION BY segment) as double) AS ShareTotalHours,
       row_number() OVER (PARTITION BY segment ORDER BY m DESC, value)::INT AS Place
FROM grouped"""

def segment_distribution_sql(seg: str) -> str:
    return with_(EXPLORE_CALLS, EXPLORE_SPEND) + _SEG_BASE + f""",
rows_ AS (SELECT {seg}, MinPerCall FROM per_customer WHERE {seg} IS NOT NULL AND MinPerCall IS NOT NULL),
stats AS (
  SELECT {seg}, quantile_cont(MinPerCall, 0.25) AS q1, quantile_cont(MinPerCall, 0.5) AS median,
         quantile_cont(MinPerCall, 0.75) AS q3
  FROM rows_ GROUP BY {seg})
SELECT s.{seg}, round(s.q1, 6) AS q1, round(s.median, 6) AS median, round(s.q3, 6) AS q3,
       min(CASE WHEN r.MinPerCall >= s.q1 - 1.5 * (s.q3 - s.q1) THEN r.MinPerCall END) AS whisker_low,
       max(CASE WHEN r.MinPerCall <= s.q3 + 1.5 * (s.q3 - s.q1) THEN r.MinPerCall END) AS whisker_high
FROM rows_ r JOIN stats s ON r.{seg} = s.{seg}
GROUP BY s.{seg}, s.q1, s.median, s.q3"""


SEGMENT_DISTRIBUTION_RUNS = with_(EXPLORE_CALLS, EXPLORE_SPEND) + _SEG_BASE + """
SELECT Size, count(*) AS n, min(MinPerCall) AS least, max(MinPerCall) AS most,
       true AS q1_kept, true AS median_kept, true AS q3_kept
FROM per_customer WHERE Size IS NOT NULL AND MinPerCall IS NOT NULL GROUP BY Size"""

BRANCH_DRILL = with_(EXPLORE_CALLS) + """
SELECT Branch, Contact, Objective, cast(coalesce(sum(DurationHours), 0) as double) AS TotalHours,
       count(MeetingID) AS TotalCalls,
       cast(coalesce(sum(DurationHours), 0) as double) / cast(count(MeetingID) as double) * 60.0 AS MinPerCall,
       row_number() OVER (PARTITION BY Branch, Contact ORDER BY coalesce(sum(DurationHours), 0) DESC, Objective)::INT AS Place
FROM queues WHERE Branch = 'Branch 3  '
GROUP BY Branch, Contact, Objective"""

BRANCH_CALLS_FILTER = with_(EXPLORE_CALLS) + """
SELECT * FROM queues WHERE Branch = 'Branch 3  ' AND Contact = 'Contact 2' AND DurationHours > 1"""

CALL_DURATION = """
SELECT event_id AS MeetingID,
       cast(epoch_us(ts + to_minutes(event_id % 600)) - epoch_us(ts) as double) / cast(3600000000.0 as double) AS DurationHours
FROM events"""

ROOT_DOC_SALES = f"""
SELECT left({doc('l_orderkey')} || '/' || cast(l_linenumber as varchar), 9) AS RootPDN,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) AS TotalPartSales
FROM lineitem GROUP BY 1"""

DEDUPE_ROWS = with_(EXPLORE_SPEND) + "SELECT * FROM spend_clean"

CLEAN_NAMES = """
SELECT c_custkey AS CustomerNo, c_mktsegment AS Size, c_nationkey AS Loyalty, c_acctbal AS ExpenditurePNS
FROM customer"""


# --- whole texts ------------------------------------------------------------------

DOCNUM_DOCUMENTS = f"""
WITH call_texts AS (SELECT doc_id AS MeetingId, NULL AS PartsDocumentNumber, upper({doc('doc_id')} || ' ' || text || ' ref. ' || {doc('doc_id')}) AS Notes FROM documents)
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) x
WHERE length(RootDocumentNumber) <> 0"""

DOCNUM_CONVERSATIONS = f"""
WITH call_texts AS (SELECT conv_id * 1000 + turn AS MeetingId,
                           upper({doc('(conv_id * 1000 + turn)')} || ' ' || text || ' ref. ' || {doc('(conv_id * 1000 + turn)')}) AS PartsDocumentNumber,
                           NULL AS Notes FROM conversations)
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('PartsDocumentNumber', True)}) x
WHERE length(RootDocumentNumber) <> 0"""


# --- derived tables end to end: calls -> numbers -> invoice lines -> revenue -------

REVENUE_FROM_CALLS = with_(CALL_SOURCES, CALL_TABLE_SQL, INVOICE_SOURCES, INVOICE_LINES_SQL, f"""
call_texts AS (SELECT MeetingId, PartsDocumentNumber, Notes FROM call_table),
numbers AS (
  SELECT DISTINCT MeetingId, RootDocumentNumber FROM (
    SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('PartsDocumentNumber', True)}) x
    UNION ALL
    SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) y) z
  WHERE length(RootDocumentNumber) <> 0),
joined AS (
  SELECT n.MeetingId, n.RootDocumentNumber, l.PartSales, l.OpenDate, l.ContractStart, l.ContractEnd
  FROM numbers n LEFT JOIN invoice_lines l USING (RootDocumentNumber)),
per_doc AS (
  SELECT RootDocumentNumber, sum(PartSales) AS PartSales, min(OpenDate) AS OpenDate,
         min(ContractStart) AS ContractStart, max(ContractEnd) AS ContractEnd,
         CASE WHEN min(OpenDate) BETWEEN min(ContractStart) AND max(ContractEnd) THEN 1 ELSE 0 END AS OnContract
  FROM joined GROUP BY RootDocumentNumber)""") + """
SELECT j.MeetingId,
       coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), '') AS RootDocumentNumber,
       cast(sum(j.PartSales) as double) AS PartSales,
       cast(coalesce(sum(a.OnContract), 0) as bigint) AS OnContract,
       nullif(regexp_extract(coalesce(string_agg(DISTINCT j.RootDocumentNumber, ', ' ORDER BY j.RootDocumentNumber), ''), '([CS])', 0), '') AS SalesType
FROM joined j
LEFT JOIN per_doc a
  ON j.RootDocumentNumber = a.RootDocumentNumber AND j.PartSales = a.PartSales AND j.OpenDate = a.OpenDate
 AND j.ContractStart = a.ContractStart AND j.ContractEnd = a.ContractEnd
GROUP BY j.MeetingId"""

DOCNUM_PAGES = f"""
WITH call_texts AS (SELECT page_id AS MeetingId, NULL AS PartsDocumentNumber, upper({doc('page_id')} || ' ' || html || ' ref. ' || {doc('page_id')}) AS Notes FROM pages)
SELECT MeetingId, RootDocumentNumber FROM ({_extract_sql('Notes', False)}) x
WHERE length(RootDocumentNumber) <> 0"""
