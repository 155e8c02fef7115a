from datetime import datetime

from callcredit.config import TimeSpec
from callcredit.functions.timezone import normalise_times


def test_fixed_and_summer_time(spark):
    df = spark.createDataFrame([(datetime(2020, 7, 1, 12), datetime(2020, 7, 1, 12)),
                                (datetime(2020, 1, 1, 12), datetime(2020, 1, 1, 12))],
                               "a timestamp_ntz, b timestamp_ntz")
    out = normalise_times(df, TimeSpec(zones=(("a", "EST"), ("b", "America/New_York")))).collect()
    assert out[0].a == datetime(2020, 7, 1, 17) and out[0].b == datetime(2020, 7, 1, 16)
    assert out[1].a == datetime(2020, 1, 1, 17) and out[1].b == datetime(2020, 1, 1, 17)


def test_offset_text(spark):
    df = spark.createDataFrame([("2020-07-01 12:00:00 -05:00",)], "m string")
    out = normalise_times(df, TimeSpec(formats=(("m", "yyyy-MM-dd HH:mm:ss z"),))).first()
    assert out.m == datetime(2020, 7, 1, 17)


def test_untouched_without_spec(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert normalise_times(df, None) is df
