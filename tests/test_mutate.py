import pytest
from pyspark.sql import functions as F

from callcredit.operators import mutate

SCHEMA = "k int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], SCHEMA)
    changes = spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], SCHEMA)
    got = rows(mutate.upsert(target, changes, ["k"]))
    # NULL keys never match: the old NULL row stays, the new one is added
    assert got == rows(spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")], SCHEMA))


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    changes = spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA)
    once = mutate.upsert(target, changes, ["k"])
    twice = mutate.upsert(once, changes, ["k"])
    assert rows(once) == rows(twice)


def test_duplicate_changes_raise(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    changes = spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA)
    with pytest.raises(mutate.DuplicateChangeError):
        mutate.upsert(target, changes, ["k"])


def test_newest_by(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, v string, t int")
    changes = spark.createDataFrame([(1, "x", 5), (1, "y", 9), (2, "z", 1)], "k int, v string, t int")
    got = rows(mutate.upsert(target, changes, ["k"], newest_by="t"))
    assert got == [(1, "y", 9), (2, "z", 1)]


def test_delete_leaves_live_keys(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], SCHEMA)
    live = spark.createDataFrame([(1,), (3,)], "k int")
    gone = mutate.deleted_keys(current, live, ["k"])
    # EXCEPT is NULL-safe: the NULL key is listed ...
    assert sorted(rows(gone), key=repr) == sorted([(2,), (None,)], key=repr)
    left = mutate.delete_keys(current, gone, ["k"])
    # ... but plain equality does not delete it
    assert rows(left) == rows(spark.createDataFrame([(1, "a"), (3, "c"), (None, "n")], SCHEMA))


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA)
    got = rows(mutate.insert_if_absent(target, new, ["k", "v"]))
    assert got == [(1, "a"), (1, "b"), (2, "c")]


def test_upsert_plan_has_no_python(spark):
    target = spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    changes = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("w").alias("v"))
    plan = mutate.upsert(target, changes, ["k"], check=False)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_bucketed_upsert_touches_only_its_buckets(spark, tmp_path):
    import os

    from callcredit.sources import buckets as bk
    root = str(tmp_path / "t")
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    bk.write_bucketed(target, root, ["k"], 16)
    before = {d: os.stat(os.path.join(root, d)).st_mtime_ns for d in os.listdir(root) if d.startswith("bucket=")}
    changes = spark.createDataFrame([(5, "b"), (2000, "c")], "k bigint, v string")
    touched = bk.upsert_bucketed(spark, root, changes, ["k"], 16)
    assert 1 <= len(touched) <= 2
    after = {d: os.stat(os.path.join(root, d)).st_mtime_ns for d in os.listdir(root) if d.startswith("bucket=")}
    untouched = [d for d in before if int(d.split("=")[1]) not in touched]
    assert untouched and all(before[d] == after[d] for d in untouched)
    got = {r.k: r.v for r in bk.read_bucketed(spark, root).collect()}
    assert len(got) == 1001 and got[5] == "b" and got[2000] == "c" and got[6] == "a"
    # the same batch again changes nothing
    bk.upsert_bucketed(spark, root, changes, ["k"], 16)
    assert {r.k: r.v for r in bk.read_bucketed(spark, root).collect()} == got


def test_upsert_delete_match_python_model(spark):
    """Random tables with NULL keys, against a plain Python statement of
    MERGE (update matched, insert unmatched) and DELETE ... EXISTS."""
    import random
    rng = random.Random(9)
    for _ in range(4):
        tgt_keys = rng.sample(range(30), 15) + [None, None]
        target = [(k, f"t{k}") for k in tgt_keys]
        ch_keys = rng.sample(range(20, 45), 10) + [None]
        changes = [(k, f"c{k}") for k in ch_keys]
        want = [(k, v) for k, v in target if k is None or k not in {c for c, _ in changes if c is not None}]
        want += changes
        got = mutate.upsert(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(changes, SCHEMA), ["k"])
        assert rows(got) == sorted(want, key=repr)

        live = set(rng.sample(range(30), 12))
        cur = spark.createDataFrame(target, SCHEMA)
        gone = mutate.deleted_keys(cur, spark.createDataFrame([(k,) for k in live], "k int"), ["k"])
        left = mutate.delete_keys(cur, gone, ["k"])
        assert rows(left) == sorted([(k, v) for k, v in target if k is None or k in live], key=repr)


def test_bucket_layout_is_checked(spark, tmp_path):
    import pytest

    from callcredit.sources import buckets as bk
    root = str(tmp_path / "t")
    bk.write_bucketed(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")), root, ["k"], 8)
    changes = spark.createDataFrame([(5, "b")], "k bigint, v string")
    for keys, n in ((["k"], 16), (["v"], None)):
        with pytest.raises(bk.LayoutError):
            bk.upsert_bucketed(spark, root, changes, keys, n)
    assert bk.layout(spark, root) == (8, ["k"]) and bk.read_bucketed(spark, root).count() == 100


def test_insert_if_absent_takes_one_of_repeats(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    new = spark.createDataFrame([(1, "x"), (2, "c"), (2, "b"), (2, "b"), (None, "n"), (None, "n")], SCHEMA)
    assert rows(mutate.insert_if_absent(target, new, ["k"])) == sorted([(1, "a"), (2, "b"), (None, "n"), (None, "n")], key=repr)
    keys_only = spark.createDataFrame([(3,), (3,), (1,)], "k int")
    assert sorted(r.k for r in mutate.insert_if_absent(keys_only.where("k = 1"), keys_only, ["k"]).collect()) == [1, 3]


def test_keep_live_equals_except_then_delete(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], SCHEMA)
    live = spark.createDataFrame([(2,), (2,), (7,)], "k int")
    assert rows(mutate.keep_live(current, live, ["k"])) == sorted([(2, "b"), (None, "c")], key=repr)

