"""Serving transforms on in-line rows."""

from datetime import datetime

from callcredit.plans.serving import Lookups, ServingContext, transform

T = datetime(2024, 3, 5, 0, 0)


def _ctx(spark, tables, **lookups):
    return ServingContext(Lookups(**lookups), tables.__getitem__)


def test_customer_account_filter_and_fill(spark):
    df = spark.createDataFrame([("1", 0, None, 5.0), ("2", 1, 3.0, 4.0), ("3", 0, 7.0, None)],
                               "CustomerNo string, Internal int, expenditure_5yavg_total double, "
                               "expenditure_5yavg_partsnservices double")
    got = sorted(tuple(r) for r in transform(df, "customeraccount", _ctx(spark, {})).collect())
    assert got == [("1", 0, 0.0, 5.0), ("3", 0, 7.0, 0.0)]


def test_branch_address_remap_and_region_on_raw_name(spark):
    df = spark.createDataFrame([("Concord",), ("Ottawa",), ("Nowhere",)], "branchname string")
    ctx = _ctx(spark, {}, branch_region={"Concord": "Central", "Ottawa": "Central"})
    got = {r.branchname: (r.branch_pbi, r.region) for r in transform(df, "global_branch_address", ctx).collect()}
    # the report spelling changes, the region is looked up on the raw name (D-16)
    assert got == {"Concord": ("Concord H.O.", "Central"), "Ottawa": ("Ottawa", "Central"),
                   "Nowhere": ("Nowhere", None)}


def test_queue_group_join_key_default(spark):
    df = spark.createDataFrame([("1", "x", "Parts Q"), ("2", "y", "Other")], "pkey string, reporting string, name string")
    ctx = _ctx(spark, {}, queue_group_key={"Parts Q": "k1"})
    got = {r.pkey: r.join_key for r in transform(df, "tblconfig_queuegroup", ctx).collect()}
    assert got == {"1": "k1", "2": "not found"}


def test_agent_events_member_filter_names_and_prefix(spark):
    groups = spark.createDataFrame([("g1", "520", "a"), ("g2", "777", "b")], "pkey string, reporting string, name string")
    members = spark.createDataFrame([("g1", "11"), ("g2", "22")], "fkagentgroup string, fkagent string")
    stats = spark.createDataFrame([("11", "Windy", "Moss", T), ("22", "Ann", "Lee", T), (None, "X", "Y", T)],
                                  "agentid string, agentfirstname string, agentlastname string, "
                                  "midnightstartdate timestamp_ntz")
    ctx = _ctx(spark, {"tblconfig_agentgroup": groups, "tblconfig_agentgroupmembers": members},
               agent_display={"WindyMoss": "W. Moss"}, agent_prefix_branch={"Win_": "Windsor"})
    rows = transform(stats, "agenteventstats", ctx).collect()
    # only members of groups with a selected code; NULL ids never match
    assert [r.agentid for r in rows] == ["11"]
    r = rows[0]
    # names glued without a separator; the 4-letter prefix "Wind" cannot hit "Win_" (D-15)
    assert r.pop_name == "W. Moss" and r.branch is None and str(r.date) == "2024-03-05"


def test_call_table_contribution(spark):
    df = spark.createDataFrame([("Parts Sale", T), ("General", T), (None, T)], "objective string, callstart timestamp_ntz")
    got = [r.contribution for r in transform(df, "partscallcentre_popup_data", _ctx(spark, {})).collect()]
    assert got == ["Direct", "Indirect", "Indirect"]


def test_unknown_table_passes_unchanged(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert transform(df, "something_else", _ctx(spark, {})) is df
