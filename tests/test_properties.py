"""Property tests (hypothesis) for the pure parts and the token fold."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callcredit.config import LoadWindow, TableRef, run_folder
from callcredit.functions import docnum as dn
from test_docnum import _model

TIMES = st.datetimes(min_value=datetime(2000, 1, 1), max_value=datetime(2030, 1, 1)).map(
    lambda d: d.replace(microsecond=0))


@given(mark=TIMES, span=st.integers(0, 10 ** 6), overlap=st.integers(0, 10 ** 4))
def test_window_start_is_mark_minus_overlap(mark, span, overlap):
    end = mark + timedelta(seconds=span)
    w = LoadWindow.resolve(stored_mark=mark, given_start=None, given_end=end.strftime("%Y-%m-%d %H:%M:%S"),
                           run_time=end, overlap_minutes=str(overlap))
    assert w.start == mark - timedelta(minutes=overlap) and w.end == end and w.start <= w.end


@given(run=TIMES, table=st.from_regex(r"\$?[a-z][a-z_]{0,10}", fullmatch=True))
def test_run_folder_layout(run, table):
    path = run_folder("/r", TableRef("db", "dbo", table), run)
    parts = path.split("/")
    assert parts[:4] == ["", "r", "db", table.replace("$", "")]
    assert parts[4] == run.strftime("%Y_%m_%d") and parts[5].startswith(parts[4] + "-")
    assert datetime.strptime(parts[5], "%Y_%m_%d-%H_%M_%S") == run


TOKENS = st.sampled_from(["00C074511", "12", "1234567", "3", "AB", "03C5263414", "03C526333A", "",
                          "45S000001", "999999", "0", "X1", "9Z000000"])


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(toks=st.lists(TOKENS, max_size=12), short=st.booleans())
def test_fold_equals_model(spark, toks, short):
    df = spark.createDataFrame([(toks,)], "toks array<string>")
    got = df.select(dn.parse_tokens(F.col("toks"), short).alias("o")).first().o
    assert got == _model(toks, short)
