from pyspark.sql import functions as F

from callcredit.config import MemberFilter
from callcredit.operators.membership import filter_members


def test_semi_join_equals_collected_list(spark):
    groups = spark.createDataFrame([("g1", "520"), ("g2", "999"), ("g3", "232")], "pkey string, reporting string")
    members = spark.createDataFrame([("g1", "a1"), ("g2", "a2"), ("g3", "a3"), ("g3", None), ("g1", "a1")],
                                    "fkagentgroup string, fkagent string")
    facts = spark.createDataFrame([("a1", 1), ("a2", 2), ("a3", 3), (None, 4), ("a1", 5)], "agentid string, x int")
    spec = MemberFilter("fkagentgroup", "pkey", "fkagent", ("520", "232"))
    got = sorted(r.x for r in filter_members(facts, "agentid", members, groups, spec).collect())
    ids = [r[0] for r in members.join(groups.where(F.col("reporting").isin("520", "232")),
                                      members.fkagentgroup == groups.pkey).select("fkagent").distinct().collect()]
    want = sorted(r.x for r in facts.where(F.col("agentid").isin(ids)).collect())
    assert got == want == [1, 3, 5]
