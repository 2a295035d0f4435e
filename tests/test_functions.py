from pyspark.sql import functions as F

from tidemark.functions.stats import age_365, percent_1dp
from tidemark.functions.text import mask_phone, prefix_millis, query_terms, strip_marker, tokens
from tidemark.functions.timefmt import (datetime_date, datetime_hour, log_date, log_hour,
                                        ntz_to_epoch_ms, previous_day, previous_day_str)


def test_phone_mask(spark):
    df = spark.createDataFrame([("13812345678",), ("1381",), ("13",), ("",), (None,)], "tel string")
    got = [r[0] for r in df.select(mask_phone("tel")).collect()]
    assert got == ["1381*******", "1381*******", "13*******", "*******", None]


def test_epoch_ms_to_date_hour_boundaries(spark):
    # 2024-01-01 23:59:59.999 and 2024-01-02 00:00:00.000 UTC
    df = spark.createDataFrame([(1704153599999,), (1704153600000,)], "ts long")
    got = df.select(log_date("ts"), log_hour("ts")).collect()
    assert [tuple(r) for r in got] == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_epoch_ms_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1704153600000,)], "ts long")
        assert tuple(df.select(log_date("ts"), log_hour("ts")).first()) == ("2024-01-02", "00")
        nt = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 00:00:00' AS t")
        assert nt.select(ntz_to_epoch_ms("t")).first()[0] == 1704153600000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_datetime_split_malformed_is_null(spark):
    df = spark.createDataFrame([("2019-03-04 13:05:06",), ("2019-03-04",), (None,), ("x y",)],
                               "t string")
    got = [tuple(r) for r in df.select(datetime_date("t"), datetime_hour("t")).collect()]
    assert got == [("2019-03-04", "13"), ("2019-03-04", None), (None, None), ("x", "y")]


def test_previous_day(spark):
    df = spark.createDataFrame([("2024-03-01",), ("2024-01-01",)], "d string")
    assert [r[0] for r in df.select(previous_day("d")).collect()] == ["2024-02-29", "2023-12-31"]
    assert previous_day_str("2024-03-01") == "2024-02-29"


def test_percent_half_up(spark):
    df = spark.createDataFrame([(1, 3), (49, 400), (0, 0), (2, 2), (1, 8)], "n long, total long")
    got = [r[0] for r in df.select(percent_1dp("n", "total")).collect()]
    # 1/3 -> 33.3; 49/400 = 12.25 -> 12.3 (half up); total 0 -> 0.0; 1/8 = 12.5
    assert got == [33.3, 12.3, 0.0, 100.0, 12.5]


def test_age_in_365_day_years(spark):
    as_of = "2024-01-01"
    days = [0, 364, 365, 7299, 7300, 11314, 11315, -10]
    data = [(d,) for d in days] + [(None,)]
    df = spark.createDataFrame(data, "d int").select(
        F.when(F.col("d").isNull(), F.lit(None)).otherwise(
            F.date_format(F.date_sub(F.lit(as_of).cast("date"), F.col("d")), "yyyy-MM-dd")).alias("b"))
    got = [r[0] for r in df.select(age_365("b", as_of)).collect()]
    assert got == [0, 0, 1, 19, 20, 30, 31, 0, None]


def test_marker_strip(spark):
    m = "atguigu>>>"
    df = spark.createDataFrame([("plain",), (m + "a",), (m + "a" + m + "b",), (m,)], "v string")
    assert [r[0] for r in df.select(strip_marker("v")).collect()] == ["plain", "a", "ab", ""]


def test_prefix_millis(spark):
    df = spark.sql("SELECT 'v' AS value, timestamp_millis(1704153600123) AS ts")
    assert df.select(prefix_millis("value", "ts")).first()[0] == "1704153600123-v"


def test_tokens_lower_split_cjk(spark):
    df = spark.createDataFrame([("Red Widget-2",), ("小米手机 pro",), ("",)], "s string")
    got = [r[0] for r in df.select(tokens("s")).collect()]
    assert got == [["red", "widget", "2"], ["小", "米", "手", "机", "pro"], []]
    assert query_terms("RED  widget") == ["red", "widget"]
    assert query_terms("小米") == ["小", "米"]
    assert query_terms("  ") == []
