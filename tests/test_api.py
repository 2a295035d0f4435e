import json

from tidemark import api
from tidemark.operators import search as SE


def test_hours_json_shape(spark):
    dau = spark.createDataFrame([("2019-03-04", "03"), ("2019-03-03", "23")],
                                "logdate string, loghour string")
    hours = api.realtime_hours("dau", dau, None)                 # default date 2019-03-04
    doc = json.loads(api.hours_as_json(hours).first()[0])
    assert list(doc) == ["yesterday", "today"]
    assert len(doc["today"]) == 24 and doc["today"]["03"] == 1 and doc["yesterday"]["23"] == 1
    assert api.realtime_hours("other", dau, None) is None


def test_sale_detail_defaults_and_stat_json(spark):
    idx = spark.createDataFrame([("d1", "red cup", "M", 15, "2019-03-04")],
                                "order_detail_id string, sku_name string, user_gender string, "
                                "user_age int, dt string")
    res = api.sale_detail(idx)                                    # keyword "" matches nothing
    assert res["total"].first()[0] == 0
    res = api.sale_detail(idx, keyword="RED")
    assert res["total"].first()[0] == 1
    doc = json.loads(api.stats_as_json(res["gender"]).first()[0])
    assert doc == {"title": SE.GENDER_TITLE, "options": [{"name": "男", "value": 100.0},
                                                         {"name": "女", "value": 0.0}]}


def test_search_over_materialized_index(spark):
    from tidemark.operators.keyed import KeyedTable
    from tidemark.schemas import SALE_ROW
    from tidemark.session import run_dir
    rows_ = [("d1", "o1", "1", "t", "u1", "s", "M", 25, "L", 1.0, "red cup", "2019-03-04"),
             ("d2", "o2", "1", "t", "u2", "s", "F", 35, "L", 2.0, "blue cup", "2019-03-04"),
             ("d3", "o3", "1", "t", "u3", "s", "F", 15, "L", 3.0, "red cup", "2019-03-05")]
    index = KeyedTable(spark, run_dir(spark, "index-test"), SALE_ROW, ["order_detail_id"], part="dt")
    index.upsert(spark.createDataFrame(rows_, SALE_ROW), 0)
    res = api.search_index(index, keyword="cup")
    assert res["total"].first()[0] == 2
    assert [r[0] for r in res["detail"].select("order_detail_id").collect()] == ["d1", "d2"]
    assert [r["value"] for r in res["age"].collect()] == [0.0, 50.0, 50.0]


def test_realtime_total_default_date(spark):
    dau = spark.createDataFrame([("2019-03-04", "m1"), ("2019-03-03", "m1"), ("2019-03-04", "m2")],
                                "logdate string, mid string")
    orders = spark.createDataFrame([("2019-03-04", 10.0), ("2019-03-04", 2.5)],
                                   "create_date string, total_amount double")
    got = {r["id"]: r["value"] for r in api.realtime_total(dau, orders).collect()}
    assert got == {"dau": 2.0, "new_mid": 1.0, "order_amount": 12.5}   # m1 was new the day before
