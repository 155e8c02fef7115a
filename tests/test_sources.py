import os
from datetime import datetime

import pytest

from callcredit.config import TableRef
from callcredit.sources import bronze, files, jdbc, snapshot


def test_snapshot_versions_skip_incomplete(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(5)
    assert snapshot.write_snapshot(df, root) == 0
    assert snapshot.write_snapshot(df.where("id > 2"), root) == 1
    # a version folder without _SUCCESS (a failed writer) is ignored ...
    os.makedirs(os.path.join(root, "v=2"))
    assert snapshot.versions(spark, root) == [0, 1]
    assert snapshot.read_snapshot(spark, root).count() == 2
    assert snapshot.read_snapshot(spark, root, version=0).count() == 5
    # ... and overwritten by the next write
    assert snapshot.write_snapshot(df, root) == 2
    with pytest.raises(FileNotFoundError):
        snapshot.read_snapshot(spark, str(tmp_path / "missing"))


def test_partitioned_write_layout(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "x int, k string")
    files.write_files(df, "parquet", path, partition_by=["k"])
    assert sorted(d for d in os.listdir(path) if d.startswith("k=")) == ["k=a", "k=b"]
    back = files.read_files(spark, "parquet", path)
    assert sorted((r.x, r.k) for r in back.collect()) == [(1, "a"), (2, "b"), (3, "a")]


def test_csv_with_schema_and_file_count(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(i, f"n{i}", datetime(2024, 1, 1 + i % 20)) for i in range(50)],
                               "id bigint, name string, ts timestamp_ntz")
    files.write_files(df, "csv", path, num_files=4)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 4
    back = files.read_files(spark, "csv", path, schema=df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_bronze_run_folder(spark, tmp_path):
    ref = TableRef("db", "dbo", "$tbl")
    path = bronze.write_run(spark.range(3), str(tmp_path), ref, "2020-09-01 14:20:55")
    assert path.endswith("/db/tbl/2020_09_01/2020_09_01-14_20_55")
    assert bronze.read_run(spark, str(tmp_path), ref, datetime(2020, 9, 1, 14, 20, 55)).count() == 3


def test_jdbc_arguments_checked_before_any_connection(spark):
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:none://x", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:none://x")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:none://x", table="t", partition_column="id")


def test_catalog_roundtrip_external(spark, tmp_path):
    from callcredit.sources import catalog as cat
    cat.create_database(spark, "cc_test_db", str(tmp_path / "db"))
    cat.write_table(spark.range(4), "cc_test_db", "t", path=str(tmp_path / "t"))
    assert cat.read_table(spark, "cc_test_db", "t", columns=["id"]).count() == 4
    with pytest.raises(ValueError):
        cat.read_table(spark, "cc_test_db", "t; drop table x")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    from callcredit.sources import catalog as cat
    cat.create_database(spark, "cc_bucket_db", str(tmp_path / "db"))
    a = spark.range(5000).select(F.col("id").alias("MeetingId"), (F.col("id") % 7).alias("x"))
    b = spark.range(5000).select(F.col("id").alias("MeetingId"), (F.col("id") % 5).alias("y"))
    cat.write_table(a, "cc_bucket_db", "a", path=str(tmp_path / "a"), bucket_by=(8, ["MeetingId"]))
    cat.write_table(b, "cc_bucket_db", "b", path=str(tmp_path / "b"), bucket_by=(8, ["MeetingId"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = cat.read_table(spark, "cc_bucket_db", "a").join(cat.read_table(spark, "cc_bucket_db", "b"),
                                                            "MeetingId", "left")
        assert j.count() == 5000
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_call_table_over_bucketed_tables_keeps_colocation(spark):
    """With broadcasts off (as for tables too large to broadcast), the join
    of calls and details reads both bucketed tables without an exchange."""
    import re

    import __spark_entry__ as entry
    from conftest import SF_SMALL
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["call_table_bucketed"](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        idx = [i for i, l in enumerate(lines) if re.search(r"SortMergeJoin \[MeetingId#\d+L\], \[MeetingId", l)]
        assert idx, plan
        # the two children of that join are Sort -> Project/Filter -> scan, no Exchange
        below = "\n".join(lines[idx[0] + 1: idx[0] + 9])
        assert "Exchange" not in below and below.count("FileScan") == 2, below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_snapshot_marker_written_even_when_committer_skips_it(spark, tmp_path):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    old = hconf.get(key)
    hconf.set(key, "false")
    try:
        root = str(tmp_path / "s")
        assert snapshot.write_snapshot(spark.range(3), root) == 0
        assert snapshot.versions(spark, root) == [0]
    finally:
        hconf.set(key, old or "true")


def test_csv_inferred_schema_by_default(spark, tmp_path):
    path = str(tmp_path / "inf")
    files.write_files(spark.createDataFrame([(1, 2.5, "a")], "i int, d double, s string"), "csv", path)
    back = files.read_files(spark, "csv", path)
    assert dict(back.dtypes) == {"i": "int", "d": "double", "s": "string"}
    assert dict(files.read_files(spark, "csv", path, infer_schema=False).dtypes)["i"] == "string"


def test_snapshot_vacuum_keeps_newest(spark, tmp_path):
    root = str(tmp_path / "v")
    for i in range(4):
        snapshot.write_snapshot(spark.range(i + 1), root)
    os.makedirs(os.path.join(root, "v=1x"))          # not a version: untouched
    assert snapshot.vacuum(spark, root, keep=2) == [0, 1]
    assert snapshot.versions(spark, root) == [2, 3]
    assert snapshot.read_snapshot(spark, root).count() == 4
    with pytest.raises(ValueError):
        snapshot.vacuum(spark, root, keep=0)
