from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import sales as SA
from tidemark.operators import search as SE

ORD = "id string, order_status string, create_time string, user_id string, create_date string, arrival timestamp_ntz"
DET = "id string, order_id string, sku_id string, sku_name string, order_price string, arrival timestamp_ntz"


def _orders(spark, data):
    return spark.createDataFrame(data, ORD)


def _details(spark, data):
    return spark.createDataFrame(data, DET)


def _ts(s):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def test_interval_join_limits(spark):
    o = _orders(spark, [("o1", "1", "2019-03-04 10:00:00", "u1", "2019-03-04", _ts("2019-03-04 10:00:00")),
                        ("o2", "1", "2019-03-04 11:00:00", "u1", "2019-03-04", _ts("2019-03-04 11:00:00"))])
    d = _details(spark, [
        ("d1", "o1", "s1", "red cup", "1.50", _ts("2019-03-04 10:00:00")),   # together
        ("d2", "o1", "s2", "blue cup", "2.00", _ts("2019-03-04 10:05:00")),  # 300 s after: in
        ("d3", "o1", "s3", "big cup", "3.00", _ts("2019-03-04 09:54:59")),   # 301 s before: out
        ("d4", "o9", "s4", "lost cup", "4.00", _ts("2019-03-04 10:00:00")),  # no order
        ("d5", "o1", "s5", "bad price", "x", _ts("2019-03-04 10:00:01")),    # price not a number
    ])
    got = rows(SA.sale_detail(o, d, 300), "order_detail_id", "order_id", "sku_price", "dt")
    assert got == [("d1", "o1", 1.5, "2019-03-04"), ("d2", "o1", 2.0, "2019-03-04"),
                   ("d5", "o1", None, "2019-03-04")]
    assert SA.sale_detail(o, d).count() == 4           # plain equi-join keeps d3


def test_outer_join_per_batch(spark):
    o = _orders(spark, [("o1", "1", "", "u", "", _ts("2019-03-04 10:59:59")),
                        ("o2", "1", "", "u", "", _ts("2019-03-04 10:10:00"))])
    d = _details(spark, [("d1", "o1", "s", "n", "1", _ts("2019-03-04 11:00:01")),   # next batch
                         ("d2", "o1", "s", "n", "1", _ts("2019-03-04 10:59:00"))])
    got = rows(SA.order_detail_outer(o, d, 3600).withColumn("b", F.col("batch_id") % 1000),
               "order_id", "order_detail_id", "order_status")
    assert got == [("o1", "d1", None), ("o1", "d2", "1"), ("o2", None, "1")]


def test_latest_user_and_merge(spark):
    ch = spark.createDataFrame([
        ("u1", "a", "L1", "2000-01-01", "M", "INSERT", _ts("2023-01-01 00:00:00"), 1),
        ("u1", "a", "L2", "2000-01-01", "M", "UPDATE", _ts("2023-01-02 00:00:00"), 2),
        ("u2", "b", "L1", "1990-06-01", "F", "INSERT", _ts("2023-01-01 00:00:00"), 3),
        ("u2", "b", "L9", "1990-06-01", "F", "UPDATE", _ts("2023-01-01 00:00:00"), 4),  # same ts, higher seq
        ("u3", "c", "L1", "1990-06-01", "F", "DELETE", _ts("2023-01-03 00:00:00"), 5),
    ], "id string, login_name string, user_level string, birthday string, gender string, "
       "event_type string, change_ts timestamp_ntz, seq long")
    users = SA.latest_users(ch)
    assert rows(users, "id", "user_level") == [("u1", "L2"), ("u2", "L9")]
    sales = spark.createDataFrame([("d1", "o", "1", "t", "u1", "s", 1.0, "n", "dt"),
                                   ("d2", "o", "1", "t", "u3", "s", 1.0, "n", "dt")],
                                  "order_detail_id string, order_id string, order_status string, "
                                  "create_time string, user_id string, sku_id string, sku_price double, "
                                  "sku_name string, dt string")
    merged = SA.with_users(sales, users, "2024-01-01")
    assert rows(merged, "order_detail_id", "user_gender", "user_age", "user_level") == [
        ("d1", "M", 24, "L2")]                          # u3 has no user: dropped


def _index(spark):
    data = [("d1", "Red Cup", "M", 15, "2019-03-04"), ("d2", "red big cup", "F", 25, "2019-03-04"),
            ("d3", "blue cup", "F", 35, "2019-03-04"), ("d4", "小米手机", None, 30, "2019-03-04"),
            ("d5", "red cup", "M", 20, "2019-03-05")]
    return spark.createDataFrame(data, "order_detail_id string, sku_name string, user_gender string, "
                                       "user_age int, dt string")


def test_keyword_match(spark):
    idx = _index(spark)

    def ids(kw):
        return [r[0] for r in rows(SE.search(idx, "2019-03-04", kw), "order_detail_id")]
    assert ids("red") == ["d1", "d2"]
    assert ids("cup red") == ["d1", "d2"] and ids("RED CUP") == ["d1", "d2"]
    assert ids("green") == []
    assert ids("") == [] and ids("  ") == []            # empty keyword matches nothing
    assert ids(None) == ["d1", "d2", "d3", "d4"]        # no keyword clause
    assert ids("手机") == ["d4"]


def test_paging_and_ranking(spark):
    idx = _index(spark)
    r = SE.ranked(idx, "2019-03-04", "red")
    scores = dict(rows(r, "order_detail_id", "score"))
    assert scores["d1"] > scores["d2"] > 0             # shorter name scores higher
    p1 = [x[0] for x in SE.page(idx, "2019-03-04", "cup", 1, 2).select("order_detail_id").collect()]
    p2 = [x[0] for x in SE.page(idx, "2019-03-04", "cup", 2, 2).select("order_detail_id").collect()]
    p9 = SE.page(idx, "2019-03-04", "cup", 9, 2).count()
    assert p1 == ["d1", "d3"] and p2 == ["d2"] and p9 == 0


def test_terms_and_shares(spark):
    idx = _index(spark)
    hits = SE.search(idx, "2019-03-04", None)
    assert rows(SE.gender_terms(hits)) == [("F", 2), ("M", 1)]
    assert SE.total(hits).first()[0] == 4
    g = {r["name"]: r["value"] for r in SE.gender_share(hits).collect()}
    assert g == {"男": 25.0, "女": 50.0}                 # null gender only in the total
    a = [tuple(r) for r in SE.age_share(hits).collect()]
    assert [x[2] for x in a] == [25.0, 50.0, 25.0]      # 15 | 25, 30 | 35
    none = SE.search(idx, "2019-03-04", "zzz")
    assert [r["value"] for r in SE.gender_share(none).collect()] == [0.0, 0.0]
    only_m = SE.search(idx, "2019-03-05", None)
    assert [r["value"] for r in SE.gender_share(only_m).collect()] == [100.0, 0.0]
    four = SE.sale_search(idx, "2019-03-04", "cup", 1, 20)
    assert set(four) == {"detail", "total", "gender", "age"} and four["total"].first()[0] == 3


def test_salted_join_equals_plain_join_on_a_hot_order(spark):
    base = _ts("2019-03-04 10:00:00")
    o = _orders(spark, [("hot", "1", "t", "u1", "2019-03-04", base),
                        ("cold", "1", "t", "u1", "2019-03-04", base)])
    d = _details(spark, [(f"d{i}", "hot", "s", "n", "1.00", base) for i in range(50)]
                 + [("c1", "cold", "s", "n", "1.00", base)])
    plain = rows(SA.sale_detail(o, d, 300), "order_detail_id", "order_id")
    so, sd = SA.salt_pair(o, d, 4)
    salted = rows(SA.sale_detail(so, sd, 300), "order_detail_id", "order_id")
    assert salted == plain and len(plain) == 51
    spread = sd.where(F.col("order_id") == "hot").select("_salt").distinct().count()
    assert spread > 1                                   # the hot order's details are split
