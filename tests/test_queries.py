"""Every registered query runs on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from callcredit.plans import catalog
from conftest import SF_SMALL


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["MeetingId", "RootDocumentNumber", "PartSales", "OnContract", "SalesType"]
    assert df.count() > 0


def test_every_query_has_oracle_or_reason():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_stays_in_the_jvm_without_pair_joins(spark, name):
    """No Python evaluation and no nested-loop / cartesian join in any plan."""
    df = catalog.QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan
