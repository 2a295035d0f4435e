"""Plan-shape checks: the scale properties the operators are written for."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E
from tidemark.operators import cells as CE
from tidemark.operators import dedup as DD
from tidemark.operators.parse import accepted, parse_json
from tidemark.schemas import STARTUP_LOG

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dated_queries_push_ranges_into_scans(spark):
    p = plan(E.queries()["dau_total"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in p and "LessThan(ts,2024-01-16T00:00)" in p
    p = plan(E.queries()["order_amount_by_hour"](spark, SF))
    assert "GreaterThan(o_orderdate,1997-08-22T00:00)" in p


def test_columns_pruned_at_scan(spark):
    p = plan(E.queries()["delivery_counts"](spark, SF))
    assert "ReadSchema: struct<event_type:string>" in p


def test_first_log_pre_aggregates_before_shuffle(spark):
    logs = spark.createDataFrame([("m", "u", "a", "b", "c", "d", "e", "f", 1)], STARTUP_LOG)
    p = plan(DD.first_logs(DD.with_log_date_hour(logs)))
    assert p.index("partial_min") > p.index("Exchange")   # listed bottom-up after the exchange
    assert "Window" not in p


def test_json_parsed_once(spark):
    recs = spark.createDataFrame([('{"mid":"m"}',)], "value string")
    p = plan(accepted(parse_json(recs, STARTUP_LOG)))
    head = p.split("\n\n")[0]
    assert "Generate" in head
    assert p.count("from_json(") == 1


def test_sorted_cells_use_range_partitioning(spark):
    cells = spark.createDataFrame([("1", "f", "q", "v")], "rowkey string, family string, "
                                                          "qualifier string, value string")
    p = plan(CE.sort_cells(cells, 4))
    assert "rangepartitioning(rowkey" in p and "qualifier" in p


@pytest.mark.parametrize("name", ["sale_detail_users", "order_detail_outer", "dau_incremental"])
def test_no_explicit_broadcast_hint_on_growing_sides(spark, name):
    # joins are size-decided (AQE); only the 24-row hour aggregate carries a hint
    p = plan(E.queries()[name](spark, SF))
    assert "BroadcastHint" not in p and "broadcast(" not in p.lower().replace("broadcastexchange", "")


@pytest.mark.parametrize("name, most", [("sale_detail", 4), ("sale_detail_interval", 5), ("order_amount_total", 1),
                                        ("order_amount_by_hour", 1), ("order_hours_compare", 2), ("pipeline_counts", 2)])
def test_exchanges_without_broadcast(spark, name, most):
    """lineitem is dealt by part and by order, once each; totals don't meet the customers."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        buf = io.StringIO()
        with redirect_stdout(buf):
            E.queries()[name](spark, SF).explain("simple")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert buf.getvalue().count("Exchange ") <= most


def test_stage_counts_agree_with_the_stages(spark):
    from pyspark.sql import functions as F
    logs = spark.createDataFrame([("d1", "a", 1), ("d1", "a", 5), ("d1", "b", 6), ("d1", "b", 7), ("d2", "a", 8), (None, "c", 1),
                                  (None, "c", 9), (None, "c", 9), ("d1", None, 2), ("d1", None, 7)], "logdate string, mid string, ts long")
    batch, seen = logs.where("ts >= 5"), logs.where("ts < 5")
    after = DD.not_seen(batch, seen)
    want = DD.stage_counts(batch, after, DD.first_logs(after))
    got = DD.stage_counts_at_once(logs, F.col("ts") < 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert [r["n"] for r in DD.stage_counts_at_once(logs.limit(0), F.col("ts") < 5).collect()] == [0, 0, 0]
