import random

import pytest
from pyspark.sql import functions as F

from callcredit.operators import sketches


@pytest.fixture()
def rows(spark):
    rng = random.Random(3)
    values = [("hot", rng.lognormvariate(0, 2)) for _ in range(30_000)] + [("small", float(i)) for i in range(100)]
    values += [("same", 7.0)] * 5_000 + [(None, 1.0), ("small", None)]
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "id int, g string, v double")


def test_merged_runs_keep_the_stated_error(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for run in range(4):
        sketches.write_run(rows.where(F.col("id") % 4 == run), path, str(run), ["g"], "v", k=256)
    found = sketches.merged_quantiles(spark, path, ["g"])
    got = {r.g: r for r in found.collect()}
    assert {g: r.n for g, r in got.items()} == {"hot": 30_000, "small": 100, "same": 5_000}
    assert (got["same"].q1, got["same"].q3, got["same"].least, got["small"].most) == (7.0, 7.0, 7.0, 99.0)
    for r in sketches.rank_errors(rows, found, ["g"], "v").collect():
        bound = 0 if r.g == "same" else 0.01 if r.g == "small" else 2 * sketches.rank_error(256)
        assert max(r.q1_error, r.median_error, r.q3_error) <= bound, r


def test_repeated_run_replaces_itself_only(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for run, part in (("a", rows.where("g = 'small'")), ("b", rows.where("g = 'same'")), ("a", rows.where("g = 'small' and v < 50"))):
        sketches.write_run(part, path, run, ["g"], "v")
    assert {r.g: r.n for r in sketches.merged_quantiles(spark, path, ["g"]).collect()} == {"small": 50, "same": 5_000}
    assert [r.g for r in sketches.merged_quantiles(spark, path, ["g"], runs=["b"]).collect()] == ["same"]
