from datetime import datetime

import pytest

from callcredit import config as c
from callcredit.sources.files import read_files


def test_table_ref():
    t = c.TableRef.parse("branchdb.dbo.$global_branch_address")
    assert t.source_name == "[$global_branch_address]" and t.target_name == "global_branch_address"
    assert t.qualified_source == "dbo.[$global_branch_address]" and t.plain_source == "dbo.global_branch_address"
    with pytest.raises(ValueError):
        c.TableRef.parse("db.table")


def test_load_steps_and_marks():
    assert c.load_steps("full-initial") == ["full_load", "initial_load"]
    assert c.sets_mark("initial_load") and not c.sets_mark("full_load")
    with pytest.raises(ValueError):
        c.load_steps("delta_load")


def test_primary_keys():
    assert c.primary_keys(c.DEFAULT_PRIMARY_KEYS, "wo_f_workorder_partdetail") == ["WONo", "SegmentNo", "PartNo", "SeqNo"]
    with pytest.raises(ValueError):
        c.primary_keys(c.DEFAULT_PRIMARY_KEYS, "unknown")


def test_window_resolution():
    w = c.LoadWindow.resolve(stored_mark=datetime(2020, 7, 1, 12), given_start=None, given_end=None,
                             run_time=datetime(2020, 7, 2, 12), overlap_minutes="30",
                             source_zone="America/New_York")
    # defaults are shifted from UTC into the source zone (summer: -4 h)
    assert w.start == datetime(2020, 7, 1, 7, 30) and w.end == datetime(2020, 7, 2, 8)
    w2 = c.LoadWindow.resolve(stored_mark=None, given_start="2020-01-01 00:00:00",
                              given_end="2020-01-02 00:00:00", run_time=datetime(2020, 1, 3), overlap_minutes=0)
    assert w2.start == datetime(2020, 1, 1) and w2.end == datetime(2020, 1, 2)
    with pytest.raises(ValueError):
        c.LoadWindow.resolve(stored_mark=datetime(2020, 1, 1), given_start=None, given_end=None,
                             run_time=datetime(2020, 1, 2), overlap_minutes="-5")
    with pytest.raises(ValueError):
        c.LoadWindow.parse_time("2020/01/01")


def test_run_folder():
    t = c.TableRef("db", "dbo", "tbl")
    assert c.run_folder("/lake/raw", t, "2020-09-01 14:20:55") == \
        "/lake/raw/db/tbl/2020_09_01/2020_09_01-14_20_55"


def test_bad_source(spark):
    with pytest.raises(ValueError):
        read_files(spark, "avro", "/nowhere")


def test_source_queries():
    from callcredit.operators.incremental import key_query, window_query
    ref = c.TableRef("db", "dbo", "$t")
    w = c.LoadWindow(datetime(2020, 1, 1), datetime(2020, 1, 2, 3, 4, 5))
    assert window_query(ref, w) == ("SELECT * FROM dbo.t WHERE ETLTimestamp BETWEEN "
                                    "'2020-01-01 00:00:00' AND '2020-01-02 03:04:05'")
    assert key_query(ref, ["WONo", "SeqNo"]) == "SELECT WONo, SeqNo FROM dbo.t"
    assert key_query(ref, ["WONo"], bracket=True) == "SELECT WONo FROM dbo.[$t]"
    with pytest.raises(ValueError):
        key_query(ref, ["a; drop table x"])


def test_cluster_conf_sizing():
    from callcredit.session import cluster_conf
    big = cluster_conf(100 << 40)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 4096)
    assert cluster_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1 << 40)["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"


def test_time_specs_go_by_table_name():
    from callcredit.config import time_spec
    assert ("CallStart", "EST") in time_spec("SalesLink_WAP_Meetings").zones
    assert time_spec("equipment").formats and time_spec("orders") is None
