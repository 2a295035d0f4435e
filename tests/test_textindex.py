"""The kept search index against searches of plain frames."""

import random

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import search as SE
from tidemark.operators.textindex import SearchIndex
from tidemark.schemas import SALE_ROW
from tidemark.session import run_dir

WORDS = ["red", "blue", "big", "手机", "small", "x9"]


def _rows(r, ids, dates=("d1", "d2", "d3")):
    out = []
    for i in ids:
        name = None if r.random() < 0.1 else " ".join(r.choices(WORDS, k=r.randint(0, 5)))
        out.append((str(i), "o", "1", "t", f"u{i % 7}", "s", r.choice("MF"), 20 + i % 30, "L", 1.5, name, r.choice(dates)))
    return out


def _jobs(spark):
    return set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def _same(index, frame):
    for date, keywords in (("d1", ("Red big", "red red", "手 机 x9", None)), ("d2", ("red", "absent", "!")), ("d9", ("red",))):
        for keyword in keywords:
            assert rows(index.total(date, keyword)) == rows(SE.total(SE.search(frame, date, keyword))), (date, keyword)
            assert rows(index.ranked(date, keyword), *frame.columns, "score") == rows(SE.ranked(frame, date, keyword), *frame.columns, "score")
    assert [tuple(x) for x in index.page("d1", "red", 2, 3).select("order_detail_id", "score").collect()] == \
        [tuple(x) for x in SE.page(frame, "d1", "red", 2, 3).select("order_detail_id", "score").collect()]


def test_index_follows_batches_changes_and_replays(spark):
    r = random.Random(4)
    index = SearchIndex(spark, run_dir(spark, "t-index"), buckets=4)
    first = _rows(r, range(60))
    second = _rows(r, range(40, 90))          # 20 rows change name or date
    index.upsert(spark.createDataFrame(first, SALE_ROW), 0)
    _same(index, spark.createDataFrame(first, SALE_ROW))
    index.upsert(spark.createDataFrame(second, SALE_ROW), 1)
    index.upsert(spark.createDataFrame(second, SALE_ROW), 1)      # written again
    now = {x[0]: x for x in first + second}
    frame = spark.createDataFrame(list(now.values()), SALE_ROW)
    _same(index, frame)
    index.compact()
    index.upsert(spark.createDataFrame(first, SALE_ROW), 0)       # replay of a compacted batch
    third = _rows(r, [3, 200])
    index.upsert(spark.createDataFrame(third, SALE_ROW), 2)
    now.update((x[0], x) for x in third)
    _same(index, spark.createDataFrame(list(now.values()), SALE_ROW))


def test_search_reads_one_date_and_plans_without_a_job(spark):
    r = random.Random(5)
    index = SearchIndex(spark, run_dir(spark, "t-index-plan"))
    index.upsert(spark.createDataFrame(_rows(r, range(50)), SALE_ROW), 0)
    index.compact()
    before = _jobs(spark)
    total, page = index.total("d1", "red big"), index.page("d1", "red big")
    assert _jobs(spark) == before
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        total.explain("formatted")
        page.explain("formatted")
    plan = buf.getvalue()
    assert "EqualTo(dt,d1)" in plan and "In(term, [" in plan
    assert page.count() >= 0 and total.first()[0] >= 0


def test_index_of_nothing(spark):
    index = SearchIndex(spark, run_dir(spark, "t-index-none"))
    assert rows(index.total("d1", "red")) == [(0,)] and index.ranked("d1", "red").count() == 0
    index.upsert(spark.createDataFrame([], SALE_ROW), 0)
    assert rows(index.total("d1", None)) == [(0,)] and index.page("d1", "red").count() == 0
    assert index.hits("d1", "red").where(F.lit(True)).count() == 0


def test_postings_are_made_in_place(spark):
    from tidemark.operators.textindex import postings_of
    df = spark.createDataFrame([("1", "d", "Red red blue"), ("2", "d", None), ("3", None, "blue")],
                               "order_detail_id string, dt string, sku_name string")
    made = postings_of(df, "sku_name")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, made.collect())) == sorted(map(str, spark.createDataFrame(
        [("red", "1", "d", 2, 3), ("blue", "1", "d", 1, 3), ("blue", "3", None, 1, 1)], made.schema).collect()))
