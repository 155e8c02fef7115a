from pyspark.sql import functions as F

from callcredit.functions import lookup as lk


def test_lookup_is_the_same_at_any_size(spark):
    df = spark.range(600).select(F.col("id").cast("string").alias("k"), F.lit("mine").alias("_lk"), F.lit("kept").alias("_lv"))
    for n in (10, 300, 10000):
        table = {str(i): f"v{i}" for i in range(0, 2 * n, 2)}
        out = lk.lookup(df, F.col("k"), table, "out", default="none")
        assert out.columns == ["k", "_lk", "_lv", "out"]
        got = {r.k: r for r in out.collect()}
        assert len(got) == 600 and all(r.out == table.get(k, "none") and r._lk == "mine" for k, r in got.items())
    assert lk.lookup(df, F.col("k"), {}, "k").where("k is null").count() == 600  # replaces a column in place


def test_dates_that_do_not_parse_are_null(spark):
    df = spark.createDataFrame([("2020-12-31",), ("31-12-2020",), ("n/a",), (None,)], "t string")
    assert [str(r.d) for r in df.select(lk.date_of(F.col("t")).alias("d")).collect()] == ["2020-12-31", "None", "None", "None"]
    assert [str(r.d) for r in df.select(lk.date_of(F.col("t"), "dd-MM-yyyy").alias("d")).collect()] == ["None", "2020-12-31", "None", "None"]


def test_remap_and_two_way(spark):
    df = spark.createDataFrame([("Concord",), ("Ottawa",), (None,)], "b string")
    out = df.select(lk.remap(F.col("b"), {"Concord": "Concord H.O."}).alias("x"),
                    lk.two_way(F.col("b"), ("Ottawa",), "Direct", "Indirect").alias("y")).collect()
    assert [(r.x, r.y) for r in out] == [("Concord H.O.", "Indirect"), ("Ottawa", "Direct"), (None, "Indirect")]


def test_prefix_and_glue(spark):
    df = spark.createDataFrame([("Winnie", "Lee"), ("Al", None)], "f string, l string")
    out = df.select(lk.prefix(F.col("f"), 4).alias("p"), lk.glue(F.col("f"), F.lit(""), F.col("l")).alias("g")).collect()
    assert [(r.p, r.g) for r in out] == [("Winn", "WinnieLee"), ("Al", None)]
