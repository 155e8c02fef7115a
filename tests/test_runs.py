from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callcredit.config import TableRef
from callcredit.operators import incremental as inc
from callcredit.plans import runs
from callcredit.sources import bronze, snapshot
from callcredit.streaming.incremental import merge_stream

SCHEMA = "id bigint, v string, ETLTimestamp timestamp_ntz"


def test_run_load_order_and_marks():
    calls = []
    done = runs.run_load("full-initial", {"full_load": lambda: calls.append("f"),
                                          "initial_load": lambda: calls.append("i")},
                         record_mark=lambda: calls.append("mark"))
    assert done == ["full_load", "initial_load"] and calls == ["f", "i", "mark"]


def test_incremental_merge_overlap_is_harmless(spark, tmp_path):
    root = str(tmp_path)
    ref = TableRef("db", "dbo", "t")
    src = spark.createDataFrame([(i, "a", datetime(2024, 1, 1 + i)) for i in range(10)], SCHEMA)
    snapshot.write_snapshot(src.where("id < 3"), f"{root}/silver/db/t")
    snapshot.write_snapshot(inc.set_mark(inc.empty_control(spark), "t", datetime(2024, 1, 4)), f"{root}/control")
    kw = dict(bronze_root=f"{root}/bronze", silver_root=f"{root}/silver", control_root=f"{root}/control",
              keys={"t": ["id"]}, overlap_minutes="1440")
    w1 = runs.incremental_merge(spark, ref, src, run_time=datetime(2024, 1, 7, 1),
                                given_end="2024-01-07 00:00:00", **kw)
    assert w1.start == datetime(2024, 1, 3)
    w2 = runs.incremental_merge(spark, ref, src, run_time=datetime(2024, 1, 11), keep_versions=2, **kw)
    assert snapshot.versions(spark, f"{root}/silver/db/t") == [1, 2]
    assert w2.start == datetime(2024, 1, 6)   # stored mark = end used by run 1, minus a day
    out = snapshot.read_snapshot(spark, f"{root}/silver/db/t")
    assert sorted(r.id for r in out.collect()) == list(range(10))


def test_stream_restart_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    ref = TableRef("db", "dbo", "t")
    rows = spark.createDataFrame([(i, "a", datetime(2024, 1, 1)) for i in range(5)], SCHEMA)
    snapshot.write_snapshot(rows.limit(0), f"{root}/silver")
    bronze.write_run(rows, f"{root}/bronze", ref, datetime(2024, 1, 2))
    args = (spark, f"{root}/bronze", rows.schema, ["id"], f"{root}/silver", f"{root}/ckpt")
    merge_stream(*args).awaitTermination()
    v1 = snapshot.latest_version(spark, f"{root}/silver")
    # a restart with nothing new merges nothing
    merge_stream(*args).awaitTermination()
    assert snapshot.latest_version(spark, f"{root}/silver") == v1
    changed = rows.where("id = 2").withColumn("v", F.lit("b"))
    bronze.write_run(changed, f"{root}/bronze", ref, datetime(2024, 1, 3))
    merge_stream(*args).awaitTermination()
    got = {r.id: r.v for r in snapshot.read_snapshot(spark, f"{root}/silver").collect()}
    assert got == {0: "a", 1: "a", 2: "b", 3: "a", 4: "a"}


def test_serve_writes_each_table_and_names(spark):
    from callcredit.plans.serving import Lookups, ServingContext, serve
    calls = spark.createDataFrame([("Ann Lee", "Parts Sale", datetime(2024, 1, 1))],
                                  "Contact string, objective string, callstart timestamp_ntz")
    agents = spark.createDataFrame([("7", "Amb_1", "X", datetime(2024, 1, 1))],
                                   "agentid string, agentfirstname string, agentlastname string, "
                                   "midnightstartdate timestamp_ntz")
    groups = spark.createDataFrame([("g", "520", "n")], "pkey string, reporting string, name string")
    members = spark.createDataFrame([("g", "7")], "fkagentgroup string, fkagent string")
    tables = {"partscallcentre_popup_data": calls, "agentperformancebyperiodstats": agents,
              "tblconfig_agentgroup": groups, "tblconfig_agentgroupmembers": members}
    ctx = ServingContext(Lookups(agent_display={"Amb_1X": "Agent One"}), tables.__getitem__)
    written = {}
    out = serve(["agentperformancebyperiodstats", "partscallcentre_popup_data", "tblconfig_agentgroup"],
                ctx, lambda df, name: written.__setitem__(name, df.count()))
    assert written == {"agentperformancebyperiodstats": 1, "partscallcentre_popup_data": 1,
                       "tblconfig_agentgroup": 1, "agent_name_unique": 2}
    assert out["partscallcentre_popup_data"].first().contribution == "Direct"
    assert sorted(r.pop_name for r in out["agent_name_unique"].collect()) == ["Agent One", "Ann Lee"]


def test_stream_into_buckets(spark, tmp_path):
    from callcredit.sources import buckets as bk
    root = str(tmp_path)
    ref = TableRef("db", "dbo", "t")
    rows = spark.createDataFrame([(i, "a", datetime(2024, 1, 1)) for i in range(20)], SCHEMA)
    bk.write_bucketed(rows, f"{root}/silver", ["id"], 4)
    changed = spark.createDataFrame([(3, "b", datetime(2024, 1, 2)), (3, "c", datetime(2024, 1, 3)),
                                     (25, "d", datetime(2024, 1, 2))], SCHEMA)
    bronze.write_run(changed, f"{root}/bronze", ref, datetime(2024, 1, 4))
    merge_stream(spark, f"{root}/bronze", rows.schema, ["id"], f"{root}/silver", f"{root}/ckpt",
                 newest_by="ETLTimestamp").awaitTermination()
    got = {r.id: r.v for r in bk.read_bucketed(spark, f"{root}/silver").collect()}
    assert len(got) == 21 and got[3] == "c" and got[25] == "d" and got[4] == "a"


def test_delete_runs_check_keys_first(spark, tmp_path):
    import pytest
    with pytest.raises(ValueError):
        runs.delete_runs(spark, [TableRef("db", "dbo", "nokeys")], lambda ref: None, keys={},
                         bronze_root=str(tmp_path), silver_root=str(tmp_path), run_time=datetime(2024, 1, 1))


def test_incremental_merges_over_tables(spark, tmp_path):
    root = str(tmp_path)
    refs = [TableRef("db", "dbo", "a"), TableRef("db", "dbo", "b")]
    src = spark.createDataFrame([(i, "x", datetime(2024, 1, 1 + i)) for i in range(6)], SCHEMA)
    control = inc.empty_control(spark)
    for ref in refs:
        snapshot.write_snapshot(src.where("id < 2"), f"{root}/silver/db/{ref.table}")
        control = inc.set_mark(control, ref.table, datetime(2024, 1, 3))
    snapshot.write_snapshot(control, f"{root}/control")
    windows = runs.incremental_merges(spark, refs, lambda ref: src, bronze_root=f"{root}/bronze",
                                      silver_root=f"{root}/silver", control_root=f"{root}/control",
                                      keys={"a": ["id"], "b": ["id"]}, run_time=datetime(2024, 1, 10))
    assert set(windows) == {"a", "b"}
    for ref in refs:
        assert snapshot.read_snapshot(spark, f"{root}/silver/db/{ref.table}").count() == 6


def test_jdbc_writer_checks_names():
    import pytest

    from callcredit.plans.serving import jdbc_writer
    w = jdbc_writer("jdbc:none://x", schema="dbo")
    with pytest.raises(ValueError):
        w(None, "t; drop")


def test_stream_archives_merged_files(spark, tmp_path):
    import os
    root = str(tmp_path)
    ref = TableRef("db", "dbo", "t")
    rows = spark.createDataFrame([(i, "a", datetime(2024, 1, 1)) for i in range(5)], SCHEMA)
    snapshot.write_snapshot(rows.limit(0), f"{root}/silver")
    bronze.write_run(rows, f"{root}/bronze", ref, datetime(2024, 1, 2))
    merge_stream(spark, f"{root}/bronze", rows.schema, ["id"], f"{root}/silver", f"{root}/ckpt",
                 archive_dir=f"{root}/archive").awaitTermination()
    assert snapshot.read_snapshot(spark, f"{root}/silver").count() == 5
    # a later batch triggers the clean-up of files already merged
    bronze.write_run(rows.where("id = 1"), f"{root}/bronze", ref, datetime(2024, 1, 3))
    merge_stream(spark, f"{root}/bronze", rows.schema, ["id"], f"{root}/silver", f"{root}/ckpt",
                 archive_dir=f"{root}/archive").awaitTermination()
    archived = [f for _, _, fs in os.walk(f"{root}/archive") for f in fs if f.endswith(".parquet")]
    assert archived


def test_set_mark_keeps_other_rows(spark):
    control = spark.createDataFrame([("a", datetime(2024, 1, 1)), (None, datetime(2024, 1, 2)),
                                     ("b", datetime(2024, 1, 3))],
                                    "table_name string, watermark_value timestamp_ntz")
    out = sorted(((r.table_name or ""), r.watermark_value)
                 for r in inc.set_mark(control, "a", datetime(2024, 2, 1)).collect())
    assert out == [("", datetime(2024, 1, 2)), ("a", datetime(2024, 2, 1)), ("b", datetime(2024, 1, 3))]


def test_window_bounds_are_inclusive(spark):
    from callcredit.config import LoadWindow
    w = LoadWindow(datetime(2024, 1, 2), datetime(2024, 1, 4))
    df = spark.createDataFrame([(i, "x", datetime(2024, 1, 1 + i)) for i in range(5)], SCHEMA)
    got = sorted(r.id for r in inc.window_scan(df, w).collect())
    assert got == [1, 2, 3]   # both border rows are read (and absorbed by the upsert when read twice)


def test_marks_of_overlapping_runs_both_stay(spark, tmp_path):
    from callcredit.sources import marks
    root = f"{tmp_path}/control"
    base = inc.set_mark(inc.set_mark(inc.empty_control(spark), "a", datetime(2024, 1, 1)), "b", datetime(2024, 1, 1))
    snapshot.write_snapshot(base, root)
    read = lambda: {r.table_name: r.watermark_value for r in marks.read_marks(spark, root).collect()}
    before = marks.read_marks(spark, root)  # both runs read the marks first
    assert inc.stored_mark(before, "a") == inc.stored_mark(before, "b") == datetime(2024, 1, 1)
    marks.advance(spark, root, "a", datetime(2024, 1, 5))
    marks.advance(spark, root, "b", datetime(2024, 1, 6))
    marks.advance(spark, root, "c", datetime(2024, 1, 7))
    want = {"a": datetime(2024, 1, 5), "b": datetime(2024, 1, 6), "c": datetime(2024, 1, 7)}
    assert read() == want
    with pytest.raises(marks.MarkError):
        marks.advance(spark, root, "a", datetime(2024, 1, 4))
    marks.advance(spark, root, "a", datetime(2024, 1, 5))
    marks.compact(spark, root)
    assert read() == want
    marks.compact(spark, root)
    marks.advance(spark, root, "a", datetime(2024, 2, 1))
    assert read() == want | {"a": datetime(2024, 2, 1)}


def test_delete_run_on_buckets_reads_only_those_that_differ(spark, tmp_path, monkeypatch):
    from callcredit.sources import buckets
    root = f"{tmp_path}/t"
    rows = [(i, f"v{i}") for i in range(200)] + [(None, "no key")]
    df = spark.createDataFrame(rows, "id bigint, v string")
    buckets.write_bucketed(df, root, ["id"], 16)
    read = lambda: sorted((r.id is None, r.id, r.v) for r in buckets.read_bucketed(spark, root).collect())
    everything = read()
    more = df.select("id").union(spark.range(1000, 1010).select("id"))
    assert buckets.delete_bucketed(spark, root, more, ["id"]) == [] and read() == everything
    of = {r.id: r.b for r in df.select("id", buckets.bucket_of(["id"], 16).alias("b")).collect()}
    gone = {7, 8} | {i for i in range(200) if of[i] == of[9]}  # a whole bucket among them
    touched = buckets.delete_bucketed(spark, root, df.where(~df.id.isin(*gone)).select("id"), ["id"])
    assert touched == sorted({of[i] for i in gone})
    assert read() == [r for r in everything if r[1] not in gone]
    stored = []
    monkeypatch.setattr(buckets.mutate, "keep_live", lambda *a: stored.append(a))
    assert buckets.delete_bucketed(spark, root, df.where(~df.id.isin(*gone)).select("id"), ["id"]) == [] and not stored
    monkeypatch.undo()
    buckets.upsert_bucketed(spark, root, spark.createDataFrame([(7, "back"), (300, "new")], "id bigint, v string"), ["id"])
    assert buckets.delete_bucketed(spark, root, spark.createDataFrame([(7,)], "id bigint"), ["id"])
    assert read() == [(False, 7, "back"), (True, None, "no key")]
    assert buckets.delete_bucketed(spark, root, df.select("id").limit(0), ["id"]) and read() == [(True, None, "no key")]
    with pytest.raises(buckets.LayoutError):
        buckets.delete_bucketed(spark, root, df, ["v"])
