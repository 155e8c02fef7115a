"""A hot document: a third of all mentions and a third of all invoice lines.

The published plan joins every mention with every line of its document
(here 10,000 x 10,000 = 10^8 rows for one key, in one task).  The operator
pre-aggregates per document, so its work stays linear in the input.
"""

import time

from pyspark.sql import functions as F

from callcredit.operators import revenue


def test_hot_document_is_linear(spark):
    n = 30000
    hot = "00C000001"
    numbers = spark.range(n).select(
        (F.col("id") % 5000).alias("MeetingId"),
        F.when(F.col("id") % 3 == 0, F.lit(hot))
        .otherwise(F.format_string("%02dS%06d", F.col("id") % 100, F.col("id"))).alias("RootDocumentNumber"))
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot))
        .otherwise(F.format_string("%02dS%06d", F.col("id") % 100, F.col("id"))).alias("RootDocumentNumber"),
        (F.col("id") % 97 + 0.25).alias("PartSales"),
        F.lit("2020-01-01").alias("OpenDate"), F.lit("2019-01-01").alias("ContractStart"),
        F.lit("2021-01-01").alias("ContractEnd"))
    t0 = time.time()
    out = revenue.attribute_revenue(numbers, lines)
    rows = out.agg(F.count("*").alias("n"), F.sum("OnContract").alias("flags")).first()
    assert rows.n == 5000
    # every non-hot document: one mention, one line, inside its contract
    assert rows.flags == 2 * n // 3
    assert time.time() - t0 < 120
    hot_sum = lines.where(F.col("RootDocumentNumber") == hot).agg(F.sum("PartSales")).first()[0]
    # meeting 0 names the hot document twice (ids 0 and 15000) and four others
    first = out.where(F.col("MeetingId") == 0).first()
    others = sum(i % 97 + 0.25 for i in (5000, 10000, 20000, 25000))
    assert round(first.PartSales, 2) == round(2 * hot_sum + others, 2)
    assert first.RootDocumentNumber.count(",") == 4


def test_hot_key_operators_reduce_before_the_shuffle(spark):
    """Newest change per key is an aggregate (partial + final), and first row
    per key carries a group limit below the exchange: a key holding a third
    of the rows never reaches one task whole."""
    from callcredit.operators import mutate
    from callcredit.plans.calls import first_per_key
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("t"), (F.col("id") % 11).cast("string").alias("v"))
    newest = mutate.latest_per_key(df, ["k"], "t")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan
    got = {r.k: r.t for r in newest.collect()}
    assert got[0] == max(i for i in range(n) if i % 3 == 0) and len(got) == n - n // 3 + 1

    first = first_per_key(df, "k", "t", ["k", "t"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r.k: r.t for r in first.collect()}[0] == 0


def test_hot_document_is_split_in_the_final_plan(spark, tmp_path):
    """Broadcasting off, a third of the mentions on one document: the last
    join's shuffle partitions of that document are split."""
    n = 300000
    doc = F.when(F.col("id") % 3 == 0, F.lit("00C000001")).otherwise(F.format_string("%02dS%06d", F.col("id") % 100, F.col("id") % 5000))
    numbers = spark.range(n).select((F.col("id") % 50000).alias("MeetingId"), doc.alias("RootDocumentNumber"))
    lines = spark.range(5000).select(doc.alias("RootDocumentNumber"), F.lit(1.5).alias("PartSales"), F.lit("2020-01-01").alias("OpenDate"),
                                     F.lit("2019-01-01").alias("ContractStart"), F.lit("2021-01-01").alias("ContractEnd"))
    numbers.write.parquet(str(tmp_path / "numbers"))
    numbers = spark.read.parquet(str(tmp_path / "numbers"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for mode in ("strict", "by_document"):
            out = revenue.attribute_revenue(numbers, lines, mode=mode)
            assert len(out.collect()) == 50000
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString(), mode
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
