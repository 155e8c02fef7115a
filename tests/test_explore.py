from callcredit.operators import explore as ex

CALLS = "MeetingID bigint, CustomerNo string, Objective string, DurationHours double"


def test_total_row_rule(spark):
    # groups of 2 and 2, but one call lacks hours: the total counts 3
    df = spark.createDataFrame([(1, "a", "x", 1.0), (2, "a", "x", 2.0), (3, "b", "y", 3.0),
                                (4, "b", "y", None), (5, None, "z", 4.0)], CALLS)
    out = {r.CustomerNo: r for r in ex.top_with_total(df, ["CustomerNo"]).collect()}
    assert out["a"].TotalCalls == 2 and out["b"].TotalCalls == 2
    assert out[None].is_total and out[None].TotalCalls == 3 and out[None].TotalHours == 6.0
    assert out["a"].MinPerCall == 1.5 / 1 * 60 / 1  # 3 hours / 2 calls * 60


def test_top_n_limit_and_ties(spark):
    df = spark.createDataFrame([(i, f"c{i % 5}", "x", 1.0) for i in range(20)], CALLS)
    out = ex.top_with_total(df, ["CustomerNo"], top_n=3).where("not is_total").collect()
    assert sorted(r.CustomerNo for r in out) == ["c0", "c1", "c2"]


def test_average_rank(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 7, 7, 3, 7, 3])], "id int, x double")
    got = {r.id: r.r for r in ex.average_rank_desc(df, "x", "r", partitions=3).collect()}
    assert [got[i] for i in range(6)] == [4, 2, 2, 5, 2, 5]


def test_pareto_drops_crossing_row(spark):
    df = spark.createDataFrame([(1, "a", "o1", 50.0), (2, "a", "o2", 30.0), (3, "a", "o3", 20.0)], CALLS)
    got = [(r.Objective, r.PctTotalCumSum) for r in ex.pareto(df, ["CustomerNo"], "Objective", 85.0).collect()]
    assert sorted(got) == [("o1", 50.0), ("o2", 80.0)]


def test_pivot_totals(spark):
    df = spark.createDataFrame([(1, "a", "Queue Call"), (2, "a", "Walk In"), (3, "b", "Queue Call")],
                               "MeetingID bigint, CustomerNo string, CallType string")
    out = {r.CustomerNo: r for r in ex.pivot_with_totals(df, ["CustomerNo"], "CallType",
                                                         ["Queue Call", "Walk In"]).collect()}
    assert out["a"].Total == 2 and out["a"].Queue_Call == 1 and out[None].Total == 3


def test_clean_names(spark):
    df = spark.createDataFrame([(1, "s")], "`Customer No` int, `Size_ClusterDesc` string")
    assert ex.clean_names(df, "_ClusterDesc").columns == ["CustomerNo", "Size"]


def test_exact_quantiles_match_numpy(spark):
    import random

    import numpy as np
    rng = random.Random(5)
    rows = [(g, float(rng.randint(0, 40))) for g in ("a", "b", "c") for _ in range(rng.randint(1, 300))]
    rows += [("hot", 7.0)] * 500 + [("hot", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in ex.exact_quantiles(df, "g", "v", {"q1": 0.25, "median": 0.5, "q3": 0.75},
                                              partitions=5).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for gg, v in rows if gg == g])
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            assert abs(getattr(got[g], name) - np.quantile(vals, p)) < 1e-9, (g, name)


def test_segment_shares(spark):
    rows = [(f"c{i}", float(i + 1), "S" if i % 2 else "L", f"L{i % 3}", "R", "P") for i in range(20)]
    rows.append(("cx", 5.0, None, "L0", "R", "P"))      # missing segment: left out of the shares
    df = spark.createDataFrame(rows, "CustomerNo string, TotalHours double, Size string, Loyalty string, "
                                     "SupportReliance string, Profitability string")
    segs = ["Loyalty", "Size", "SupportReliance", "Profitability"]
    top = ex.segment_share(df, segs, top_n=3).collect()
    assert len(top) == 3 and top[0].PctTotalHours >= top[1].PctTotalHours >= top[2].PctTotalHours
    full = ex.segment_share(df, segs, top_n=100).collect()
    assert abs(sum(r.PctTotalHours for r in full) - 100.0) < 1e-9
    each = ex.segment_share_each(df, ["Size", "Loyalty"]).collect()
    for seg in ("Size", "Loyalty"):
        assert abs(sum(r.ShareTotalHours for r in each if r.segment == seg) - 1.0) < 1e-9
    # the row without a Size still counts for Loyalty
    loyalty_total = sum(r[1] for r in rows)
    l0 = sum(r[1] for r in rows if r[3] == "L0")
    got = {r.value: 100 * r.ShareTotalHours for r in each if r.segment == "Loyalty"}
    assert abs(got["L0"] - l0 * 100 / loyalty_total) < 1e-9


def test_average_rank_matches_pandas_on_random_ties(spark):
    import random

    import pandas as pd
    rng = random.Random(21)
    vals = [float(rng.randint(0, 60)) for _ in range(700)] + [7.0] * 300     # one value with many ties
    df = spark.createDataFrame(list(enumerate(vals)), "id int, x double")
    got = {r.id: r.r for r in ex.average_rank_desc(df, "x", "r", partitions=6).collect()}
    want = pd.Series(vals).rank(ascending=False).astype("int")
    assert [got[i] for i in range(len(vals))] == list(want)


def test_pareto_matches_pandas_statement(spark):
    """The published per-customer computation, in pandas, on rows without
    ties in hours (its sort does not fix an order among ties)."""
    import random

    import pandas as pd
    rng = random.Random(4)
    rows, hours_used = [], set()
    for i in range(300):
        h = round(rng.uniform(0.01, 9.99), 2)
        while h in hours_used:
            h = round(h + 0.01, 2)
        hours_used.add(h)
        rows.append((i, f"c{rng.randint(0, 4)}", f"o{rng.randint(0, 30)}", h))
    df = spark.createDataFrame(rows, CALLS)
    got = sorted((r.CustomerNo, r.Objective) for r in ex.pareto(df, ["CustomerNo"], "Objective", 90.0).collect())
    pdf = pd.DataFrame(rows, columns=["MeetingID", "CustomerNo", "Objective", "DurationHours"])
    want = []
    for cust, part in pdf.groupby("CustomerNo"):
        o = part.groupby("Objective")["DurationHours"].sum().sort_values(ascending=False)
        pct = o * 100 / o.sum()
        keep = pct.cumsum() <= 90
        want += [(cust, obj) for obj in o.index[keep.values]]
    assert got == sorted(want)


def test_top_with_total_matches_pandas_pivot_margins(spark):
    """``pivot_table(..., margins=True)`` as the published helper calls it,
    on rows with missing hours and missing keys."""
    import random

    import numpy as np
    import pandas as pd
    rng = random.Random(8)
    rows = []
    for i in range(400):
        key = rng.choice([f"k{j}" for j in range(12)] + [None])
        hours = None if rng.random() < 0.1 else float(rng.randint(1, 400)) / 4   # exact in binary
        rows.append((i, key, "o", hours))
    df = spark.createDataFrame(rows, CALLS)
    out = ex.top_with_total(df, ["CustomerNo"], top_n=5).collect()
    got_total = [(r.TotalCalls, r.TotalHours) for r in out if r.is_total][0]
    got_keys = {r.CustomerNo: (r.TotalCalls, r.TotalHours) for r in out if not r.is_total}

    pdf = pd.DataFrame(rows, columns=["MeetingID", "CustomerNo", "Objective", "DurationHours"])
    piv = pd.pivot_table(pdf, values=["MeetingID", "DurationHours"], index=["CustomerNo"],
                         aggfunc={"MeetingID": "count", "DurationHours": "sum"}, fill_value=0,
                         margins=True, margins_name="Total")
    assert got_total == (int(piv.loc["Total", "MeetingID"]), float(piv.loc["Total", "DurationHours"]))
    body = piv.drop(index="Total").reset_index()
    body = body.sort_values(["DurationHours", "CustomerNo"], ascending=[False, True]).head(5)
    want = {r.CustomerNo: (int(r.MeetingID), float(r.DurationHours)) for r in body.itertuples()}
    assert got_keys == want
    assert np.isfinite(got_total[1])


def test_pivot_matches_pandas_pivot_margins(spark):
    import random

    import pandas as pd
    rng = random.Random(13)
    types = ["Queue Call", "Afterhours", "Direct Call", "Walk In", "Service"]
    rows = [(i, f"c{rng.randint(0, 15)}", rng.choice(types)) for i in range(500)]
    df = spark.createDataFrame(rows, "MeetingID bigint, CustomerNo string, CallType string")
    shown = ["Queue Call", "Afterhours", "Direct Call", "Walk In"]
    out = ex.pivot_with_totals(df, ["CustomerNo"], "CallType", shown, top_n=6).collect()
    pdf = pd.DataFrame(rows, columns=["MeetingID", "CustomerNo", "CallType"])
    piv = pd.pivot_table(pdf, values="MeetingID", index=["CustomerNo"], columns=["CallType"], aggfunc="count",
                         fill_value=0, margins=True, margins_name="Total")
    cols = ["Total"] + shown
    total = [r for r in out if r.is_total][0]
    assert [total.Total, total.Queue_Call, total.Afterhours, total.Direct_Call, total.Walk_In] == \
        [int(piv.loc["Total", c]) for c in cols]
    body = piv.drop(index="Total").reset_index().sort_values(["Total", "CustomerNo"], ascending=[False, True]).head(6)
    want = {r["CustomerNo"]: [int(r[c]) for c in cols] for _, r in body.iterrows()}
    got = {r.CustomerNo: [r.Total, r.Queue_Call, r.Afterhours, r.Direct_Call, r.Walk_In] for r in out if not r.is_total}
    assert got == want


def test_segment_share_matches_pandas(spark):
    import random

    import pandas as pd
    rng = random.Random(23)
    segs = ["Loyalty", "Size", "SupportReliance", "Profitability"]
    rows = [(f"c{i}", rng.randint(1, 10 ** 6) / 100, rng.choice("AB"), rng.choice("XYZ"), rng.choice("PQ"),
             rng.choice("MN")) for i in range(400)]
    df = spark.createDataFrame(rows, "CustomerNo string, TotalHours double, Loyalty string, Size string, "
                                     "SupportReliance string, Profitability string")
    got = [(tuple(r[s] for s in segs), round(r.PctTotalHours, 9)) for r in ex.segment_share(df, segs).collect()]
    pdf = pd.DataFrame(rows, columns=["CustomerNo", "TotalHours"] + segs)
    c = pdf.groupby(segs).agg({"TotalHours": "sum"}).sort_values("TotalHours", ascending=False)
    share = (c * 100 / c.sum()).iloc[:11]
    want = [(idx, round(v, 9)) for idx, v in zip(share.index, share["TotalHours"])]
    assert got == want


def test_duration_hours(spark):
    from datetime import datetime

    from pyspark.sql import functions as F
    df = spark.createDataFrame([(datetime(2024, 3, 10, 1, 0), datetime(2024, 3, 10, 4, 30)),
                                (datetime(2024, 1, 1, 0, 0), datetime(2024, 1, 1, 0, 0, 36))],
                               "s timestamp_ntz, e timestamp_ntz")
    got = [r.h for r in df.select(ex.duration_hours(F.col("s"), F.col("e")).alias("h")).collect()]
    assert got == [3.5, 0.01]


def test_calls_hours_and_correlation_match_pandas(spark):
    import random

    import pandas as pd
    rng = random.Random(31)
    rows = [(i, f"c{rng.randint(0, 40)}", "o", rng.randint(1, 4000) / 8) for i in range(1500)]
    df = spark.createDataFrame(rows, CALLS)
    pdf = pd.DataFrame(rows, columns=["MeetingID", "CustomerNo", "Objective", "DurationHours"])
    per = pdf.groupby("CustomerNo").agg({"MeetingID": "count", "DurationHours": "sum"})
    got = {r.CustomerNo: (r.TotalCalls, r.TotalHours) for r in ex.calls_hours(df, "CustomerNo").collect()}
    assert got == {k: (int(v.MeetingID), float(v.DurationHours)) for k, v in per.iterrows()}
    corr = ex.calls_hours_corr(df, "CustomerNo").first().corr_calls_hours
    assert abs(corr - per["MeetingID"].corr(per["DurationHours"])) < 1e-6


def test_drill_matches_pandas_order(spark):
    import random

    import pandas as pd
    rng = random.Random(41)
    rows = [(i, "B1", f"p{rng.randint(0, 3)}", f"o{rng.randint(0, 5)}", rng.randint(1, 10 ** 5) / 100)
            for i in range(200)]
    df = spark.createDataFrame(rows, "MeetingID bigint, Branch string, Contact string, Objective string, "
                                     "DurationHours double")
    got = [(r.Contact, r.Objective, r.TotalCalls) for r in ex.drill(df, ["Branch", "Contact", "Objective"]).collect()]
    pdf = pd.DataFrame(rows, columns=["MeetingID", "Branch", "Contact", "Objective", "DurationHours"])
    agg = (pdf.groupby(["Branch", "Contact", "Objective"])
           .agg({"DurationHours": "sum", "MeetingID": "count"})
           .groupby(level=1, group_keys=False).apply(lambda x: x.sort_values("DurationHours", ascending=False)))
    want = [(c, o, int(n)) for (_, c, o), n in zip(agg.index, agg["MeetingID"])]
    assert got == want
