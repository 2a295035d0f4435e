from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import dedup as DD
from tidemark.operators import metrics as ME
from tidemark.operators.orders import clean_orders
from tidemark.operators.parse import accepted, parse_json, rejected
from tidemark.schemas import STARTUP_LOG

DAY1 = 1704067200000  # 2024-01-01 00:00:00 UTC
H = 3_600_000


def _logs(spark, data):
    df = spark.createDataFrame(data, "mid string, uid string, ch string, ts long")
    for c in ("appid", "area", "os", "type", "vs"):
        df = df.withColumn(c, F.lit(c))
    return DD.with_log_date_hour(df.select("mid", "uid", "appid", "area", "os", "ch", "type",
                                           "vs", "ts"))


def test_first_log_per_device_and_day(spark):
    logs = _logs(spark, [
        ("m1", "u1", "b", DAY1 + 5 * H), ("m1", "u1", "a", DAY1 + 2 * H),   # same day twice
        ("m1", "u1", "z", DAY1 + 26 * H),                                    # next day
        ("m2", "u2", "y", DAY1 + H), ("m2", "u2", "x", DAY1 + H),            # equal ts: tie on ch
    ])
    got = rows(DD.first_logs(logs), "logdate", "mid", "ch", "loghour")
    assert got == [("2024-01-01", "m1", "a", "02"), ("2024-01-01", "m2", "x", "01"),
                   ("2024-01-02", "m1", "z", "02")]


def test_not_seen_and_incremental(spark):
    seen = _logs(spark, [("m1", "u1", "a", DAY1 + H)])
    batch = _logs(spark, [("m1", "u1", "b", DAY1 + 3 * H),       # seen today -> dropped
                          ("m1", "u1", "c", DAY1 + 25 * H),      # next day -> new
                          ("m3", "u3", "d", DAY1 + 4 * H), ("m3", "u3", "e", DAY1 + 5 * H)])
    got = rows(DD.incremental_first_logs(batch, seen), "logdate", "mid", "ch")
    assert got == [("2024-01-01", "m3", "d"), ("2024-01-02", "m1", "c")]
    counts = rows(DD.stage_counts(batch, DD.not_seen(batch, seen),
                                  DD.incremental_first_logs(batch, seen)))
    assert counts == [(1, "raw", 4), (2, "after_seen_filter", 3), (3, "after_batch_dedup", 2)]


def test_new_devices(spark):
    logs = _logs(spark, [("m1", "u", "a", DAY1), ("m1", "u", "a", DAY1 + 24 * H),
                         ("m2", "u", "a", DAY1 + 24 * H)])
    got = rows(DD.new_devices_by_date(DD.first_logs(logs)))
    assert got == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_parse_rejects_bad_json_and_reads_numbers_as_text(spark):
    recs = spark.createDataFrame([('{"mid":"m1","uid":7,"ts":5}',), ("{bad",)], "value string")
    parsed = parse_json(recs, STARTUP_LOG)
    ok = accepted(parsed)
    assert rows(ok, "mid", "uid", "ts") == [("m1", "7", 5)]
    assert rows(rejected(parsed)) == [("{bad",)]


def test_hours_compare_fills_24_hours(spark):
    dau = spark.createDataFrame([("2024-01-02", "03"), ("2024-01-02", "03"), ("2024-01-01", "23")],
                                "logdate string, loghour string")
    out = {r["hour"]: (r["today"], r["yesterday"]) for r in
           ME.hours_compare(dau, "2024-01-02", "logdate", "loghour").collect()}
    assert len(out) == 24 and out["03"] == (2, 0) and out["23"] == (0, 1) and out["00"] == (0, 0)


def test_order_amounts_and_null_sum(spark):
    o = spark.createDataFrame([("1", "2019-03-04 10:00:00", 10.5, "13800000001"),
                               ("2", "2019-03-04 10:59:00", 1.25, "1"),
                               ("3", "2019-03-03 23:00:00", 4.0, None)],
                              "id string, create_time string, total_amount double, consignee_tel string")
    c = clean_orders(o)
    assert rows(c, "id", "consignee_tel", "create_date", "create_hour")[0] == (
        "1", "1380*******", "2019-03-04", "10")
    assert ME.order_amount_total(c, "2019-03-04").first()[0] == 11.75
    assert ME.order_amount_total(c, "2000-01-01").first()[0] is None      # no rows -> null
    assert rows(ME.order_amount_by_hour(c, "2019-03-04")) == [("10", 11.75)]
    hc = {r[0]: (r[1], r[2]) for r in ME.hours_for("order_amount", None, c, "2019-03-04").collect()}
    assert hc["10"] == (11.75, 0.0) and hc["23"] == (0.0, 4.0)
    assert ME.hours_for("other", None, c, "2019-03-04") is None


def test_realtime_total_and_provinces(spark):
    dau = spark.createDataFrame([("2024-01-02", "m1"), ("2024-01-02", "m2"), ("2024-01-01", "m1")],
                                "logdate string, mid string")
    new = DD.new_devices_by_date(dau)
    orders = spark.createDataFrame([("2019-03-04", 2.5, "1"), ("2019-03-04", 1.0, "2"),
                                    ("2019-03-04", 150.0, "1")],
                                   "create_date string, total_amount double, province_id string")
    got = {r["id"]: (r["name"], r["value"]) for r in
           ME.realtime_total(dau, new, orders, "2024-01-02", "2019-03-04").collect()}
    assert got["dau"][1] == 2.0 and got["new_mid"][1] == 1.0 and got["order_amount"][1] == 153.5
    nations = spark.createDataFrame([(1, "ONE"), (2, "TWO")], "n_nationkey int, n_name string")
    prov = ME.province_amount(orders, nations)
    assert rows(prov) == [("1", "ONE", 152.5, 2), ("2", "TWO", 1.0, 1)]
    assert rows(ME.province_bands(prov, "amount", 100)) == [(0, "0-100", 1), (1, "100-200", 1)]
