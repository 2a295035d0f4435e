"""Streaming jobs on hand-made topic files, one file per trigger."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import dedup as DD
from tidemark.operators.keyed import KeyedTable
from tidemark.schemas import TOPIC_RECORD
from tidemark.session import run_dir
from tidemark.streaming import jobs as J

DAY1 = 1704067200000  # 2024-01-01 00:00:00 UTC
H = 3_600_000


def _write_batches(spark, path, batches):
    """Each batch is a list of (topic, value dict, epoch ms) -> one parquet file."""
    for b in batches:
        data = [(t, 0, i, None, json.dumps(v), dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc))
                for i, (t, v, ms) in enumerate(b)]
        spark.createDataFrame(data, TOPIC_RECORD).coalesce(1).write.mode("append").parquet(path)


def _log(mid, ms, ch="c"):
    return ("gmall_startup", {"mid": mid, "uid": "u", "appid": "a", "area": "x", "os": "ios",
                              "ch": ch, "type": "startup", "vs": "1", "ts": ms}, ms)


def test_dau_stream_equals_batch_and_drops_late(spark):
    base = run_dir(spark, "t-dau")
    b1 = [_log("m1", DAY1 + 5 * H, "late-in-batch"), _log("m1", DAY1 + 2 * H, "first"),
          _log("m2", DAY1 + 3 * H)]
    b2 = [_log("m1", DAY1 + 1 * H, "earlier-next-batch"), _log("m3", DAY1 + 30 * H)]
    b3 = [_log("m9", DAY1 + 100 * H), _log("m1", DAY1 + 60 * H)]
    b4 = [_log("m7", DAY1 + 2 * H)]   # 4 days behind the newest day: past a 1-day watermark
    _write_batches(spark, f"{base}/in", [b1, b2, b3, b4])
    kt = KeyedTable(spark, f"{base}/t", J.STARTUP_ROW, ["logdate", "mid"], part="logdate")
    q = J.dau_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), kt, f"{base}/ck",
                  delay="1 day")
    J._finish(q)
    assert len(q.recentProgress) >= 4
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1                                   # the late m7 log, counted
    got = rows(kt.read(), "logdate", "mid", "ch")
    assert got == [("2024-01-01", "m1", "earlier-next-batch"), ("2024-01-01", "m2", "c"),
                   ("2024-01-02", "m3", "c"), ("2024-01-03", "m1", "c"), ("2024-01-05", "m9", "c")]
    # the same logs as one batch frame, minus the late row, give the same first logs
    batch = spark.read.schema(TOPIC_RECORD).parquet(f"{base}/in")
    from tidemark.operators.parse import accepted, parse_json
    from tidemark.schemas import STARTUP_LOG
    logs = DD.with_log_date_hour(accepted(parse_json(batch, STARTUP_LOG)))
    expect = rows(DD.first_logs(logs).where(F.col("mid") != "m7"), "logdate", "mid", "ch")
    assert got == expect


def _order(oid, ms):
    return ("gmall_order_info", {"id": oid, "user_id": "u1", "order_status": "1",
                                 "create_time": "2024-01-01 00:00:00", "total_amount": 1.0,
                                 "consignee_tel": "13800000000"}, ms)


def _detail(did, oid, ms):
    return ("gmall_order_detail", {"id": did, "order_id": oid, "sku_id": "s", "sku_name": "n",
                                   "order_price": "2.5"}, ms)


def test_sale_join_stream_across_batches(spark):
    base = run_dir(spark, "t-join")
    T0 = DAY1
    s = 1000
    orders = [[_order("o1", T0), _order("o2", T0 + 10 * s)], [_order("o3", T0 + 400 * s)], []]
    details = [[_detail("d1", "o1", T0 + 5 * s)],                       # together
               [_detail("d2", "o2", T0 + 310 * s),                      # later batch, 300 s: in
                _detail("d3", "o1", T0 + 301 * s),                      # 301 s: out
                _detail("d4", "o3", T0 + 200 * s)],                     # detail before order: in
               [_detail("d5", "o9", T0 + 500 * s)]]                     # no order
    _write_batches(spark, f"{base}/o", orders[:2])
    _write_batches(spark, f"{base}/d", details)
    q = J.sale_join_job(J.file_stream(spark, f"{base}/o", TOPIC_RECORD, 1),
                        J.file_stream(spark, f"{base}/d", TOPIC_RECORD, 1),
                        f"{base}/out", f"{base}/ck", delay="10 minutes")
    J._finish(q)
    got = rows(spark.read.parquet(f"{base}/out"), "order_detail_id", "order_id", "sku_price")
    assert got == [("d1", "o1", 2.5), ("d2", "o2", 2.5), ("d4", "o3", 2.5)]


def test_alert_stream_update_mode_matches_batch(spark):
    from tidemark.operators import alerts as AL
    from tidemark.operators.parse import accepted, parse_json
    from tidemark.schemas import EVENT_LOG
    base = run_dir(spark, "t-alert")
    T0, s = DAY1, 1000

    def ev(uid, evid, ms):
        return ("gmall_event", {"mid": "m", "uid": uid, "evid": evid, "itemid": 1, "ts": ms}, ms)
    batches = [[ev("u1", "coupon", T0 + s), ev("u2", "coupon", T0 + 2 * s)],
               [ev("u3", "coupon", T0 + 3 * s)],
               [ev("u4", "clickItem", T0 + 62 * s)]]   # click later: only windows holding it lose
    _write_batches(spark, f"{base}/in", batches)
    probe = AL.window_aggregate(AL.with_event_time(accepted(parse_json(
        spark.createDataFrame([], TOPIC_RECORD), EVENT_LOG))), "60 seconds", "5 seconds")
    kt = KeyedTable(spark, f"{base}/t", probe.schema, ["mid", "window_start_ts"])
    J._finish(J.alert_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), kt, f"{base}/ck",
                          "60 seconds", "5 seconds", "2 minutes"))
    streamed = rows(AL.alerts(kt.read()))
    batch = spark.read.schema(TOPIC_RECORD).parquet(f"{base}/in")
    expect = rows(AL.coupon_alerts(accepted(parse_json(batch, EVENT_LOG)), "60 seconds", "5 seconds"))
    assert streamed == expect and len(expect) == 12


def test_alert_stream_lists_events_of_any_id(spark):
    from tidemark.operators import alerts as AL
    from tidemark.operators.parse import accepted, parse_json
    from tidemark.schemas import EVENT_LOG
    base = run_dir(spark, "t-alert-ids")
    T0, s = DAY1, 1000

    def ev(uid, evid, ms):
        return ("gmall_event", {"mid": "m", "uid": uid, "evid": evid, "itemid": 1, "ts": ms}, ms)
    batches = [[ev("u1", "coupon", T0 + s), ev("u2", "coupon", T0 + 2 * s), ev("u2", "share", T0 + 2 * s)],
               [ev("u3", "coupon", T0 + 3 * s), ev("u3", "share", T0 + 3 * s), ev("u3", None, T0 + 3 * s)],
               [ev("u1", "scan", T0 + 4 * s)]]
    _write_batches(spark, f"{base}/in", batches)
    probe = AL.window_aggregate(AL.with_event_time(accepted(parse_json(
        spark.createDataFrame([], TOPIC_RECORD), EVENT_LOG))), "60 seconds", "5 seconds")
    kt = KeyedTable(spark, f"{base}/t", probe.schema, ["mid", "window_start_ts"])
    J._finish(J.alert_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), kt, f"{base}/ck",
                          "60 seconds", "5 seconds", "2 minutes"))
    streamed = rows(AL.alerts(kt.read()))
    batch = spark.read.schema(TOPIC_RECORD).parquet(f"{base}/in")
    assert streamed == rows(AL.coupon_alerts(accepted(parse_json(batch, EVENT_LOG)), "60 seconds", "5 seconds"))
    assert "coupon:3,null:1,scan:1,share:2" in {r["events"] for r in AL.alerts(kt.read()).collect()}


def test_processing_time_trigger_and_observed_counts(spark):
    base = run_dir(spark, "t-trigger")
    _write_batches(spark, f"{base}/in", [[_log("m1", DAY1 + H), _log("m2", DAY1 + 2 * H)]])
    spark.createDataFrame([("gmall_startup", 0, 9, None, "{bad", None)], TOPIC_RECORD) \
        .write.mode("append").parquet(f"{base}/in")
    kt = KeyedTable(spark, f"{base}/t", J.STARTUP_ROW, ["logdate", "mid"], part="logdate")
    q = J.dau_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 10), kt, f"{base}/ck",
                  available_now=False)      # the 5-second processing-time trigger
    try:
        q.processAllAvailable()
        observed = [p.get("observedMetrics", {}).get("dau_input") for p in q.recentProgress]
        observed = [o for o in observed if o]
        assert observed and observed[0]["raw"] == 3 and observed[0]["rejected"] == 1
    finally:
        q.stop()
    assert rows(kt.read(), "mid") == [("m1",), ("m2",)]


def test_order_stream_rejects_and_sale_users_rejects(spark):
    base = run_dir(spark, "t-rejects")
    _write_batches(spark, f"{base}/in", [[_order("o1", DAY1), _order("o2", DAY1 + 1000)]])
    spark.createDataFrame([("gmall_order_info", 0, 9, None, "{broken", None)], TOPIC_RECORD) \
        .write.mode("append").parquet(f"{base}/in")
    kt = KeyedTable(spark, f"{base}/t", J.ORDER_SINK_ROW, ["ID"], part="CREATE_DATE")
    J._finish(J.orders_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 10), kt,
                           f"{base}/ck", rejects=f"{base}/rej"))
    assert rows(kt.read(), "ID", "CONSIGNEE_TEL") == [("o1", "1380*******"), ("o2", "1380*******")]
    assert rows(spark.read.parquet(f"{base}/rej"), "value") == [("{broken",)]
    # sales of an unknown user are kept apart, not dropped silently
    users = KeyedTable(spark, f"{base}/u", J.USER_ROW, ["id"], ["change_ts", "seq"])
    users.upsert(spark.createDataFrame(
        [("u1", "n", "L", "2000-01-01", "F", dt.datetime(2023, 1, 1), 1)], J.USER_ROW), 0)
    _write_batches(spark, f"{base}/o", [[_order("o1", DAY1), ("gmall_order_info", {
        "id": "o2", "user_id": "u9", "order_status": "1", "create_time": "2024-01-01 00:00:00",
        "total_amount": 1.0, "consignee_tel": "1"}, DAY1)]])
    _write_batches(spark, f"{base}/d", [[_detail("d1", "o1", DAY1), _detail("d2", "o2", DAY1)],
                                        [_detail("d1", "o1", DAY1 + 1000)]])   # d1 replayed
    index = KeyedTable(spark, f"{base}/index", J.SALE_ROW, ["order_detail_id"], part="dt")
    J._finish(J.sale_users_job(J.file_stream(spark, f"{base}/o", TOPIC_RECORD, 1),
                               J.file_stream(spark, f"{base}/d", TOPIC_RECORD, 1), users, index,
                               f"{base}/ck2", "10 minutes", "2024-01-01", rejects=f"{base}/nu"))
    assert rows(index.read(), "order_detail_id", "user_gender") == [("d1", "F")]   # once
    assert rows(spark.read.parquet(f"{base}/nu"), "order_detail_id", "user_id") == [("d2", "u9")]


def test_apps_launcher_drains_a_topic_folder(spark):
    from tidemark import apps
    base = run_dir(spark, "t-apps")
    _write_batches(spark, f"{base}/topics", [[_log("m1", DAY1 + H), _log("m2", DAY1 + 2 * H)],
                                             [_order("o1", DAY1)]])
    q = apps.start(spark, "dau", kind="files", path=f"{base}/topics", out=f"{base}/dau",
                   checkpoint=f"{base}/ck", once=True)
    J._finish(q)
    kt = KeyedTable(spark, f"{base}/dau", J.STARTUP_ROW, ["logdate", "mid"], part="logdate")
    assert rows(kt.read(), "mid") == [("m1",), ("m2",)]          # order record not subscribed


def test_apps_cdc_and_logs(spark):
    from tidemark import apps
    from tidemark.schemas import CDC_CHANGE
    base = run_dir(spark, "t-apps2")
    spark.createDataFrame([("user_info", "ROWDATA", "UPDATE", {"id": "1"}, dt.datetime(2024, 1, 1), 1),
                           ("order_info", "ROWDATA", "DELETE", {"id": "2"}, dt.datetime(2024, 1, 1), 2)],
                          CDC_CHANGE).write.parquet(f"{base}/cdc")
    J._finish(apps.start(spark, "cdc", kind="files", path=f"{base}/cdc", out=f"{base}/routed",
                         checkpoint=f"{base}/ck1", once=True))
    assert rows(spark.read.parquet(f"{base}/routed"), "topic", "value") == [
        ("gmall_user_info", '{"id":"1"}')]
    spark.createDataFrame([('{"type":"startup","mid":"m"}', 1704153600000), ("{bad", 1)],
                          apps.LOG_INPUT).write.parquet(f"{base}/logs")
    J._finish(apps.start(spark, "logs", kind="files", path=f"{base}/logs", out=f"{base}/out",
                         checkpoint=f"{base}/ck2", once=True))
    daily = [r[0] for r in spark.read.text(f"{base}/out/daily").collect()]
    assert daily == ['{"type":"startup","mid":"m","ts":1704153600000}']


def test_staged_replay_is_in_order_of_time(spark):
    path = run_dir(spark, "t-order") + "/in"
    recs = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).withColumn(
        "at", F.when(F.col("v") % 50 == 0, None).otherwise(F.timestamp_seconds("v")))
    J.stage_in_order(recs.repartition(6), path, "at")
    import os
    folder = path.removeprefix("file:")
    files = sorted((f for f in os.listdir(folder) if f.endswith(".parquet")), key=lambda f: os.stat(f"{folder}/{f}").st_mtime_ns)
    seen = [spark.read.parquet(f"{path}/{f}").agg(F.count("*"), F.min("at"), F.max("at")).first() for f in files]
    assert len(files) >= 4 and sum(n for n, _, _ in seen) == 5000
    bounds = [(a, b) for _, a, b in seen if a is not None]
    assert all(x[1] <= y[0] for x, y in zip(bounds, bounds[1:]))
    assert spark.read.parquet(f"{path}/{files[0]}").where("at is null").count() == 100


def test_join_memory_is_given_back(spark):
    """A replay over years keeps 300 s and the delay in state, not what it has read."""
    import __spark_entry__ as E
    got = E.queries()["stream_sale_join"](spark, "/root/testdata/sf0.001").count()
    state = J.STATE_ROWS["stream_sale_join"]
    assert got > 0 and state["batches"] >= 3 and state["late"] == 0
    assert state["removed"] > 0 and state["last"] < state["most"] / 10


def _memory(spark, base, delay="10 minutes"):
    from tidemark.operators import sales as SA
    from tidemark.operators.joinmemory import JoinMemory
    return JoinMemory(spark, f"{base}/memory", (J.JOIN_ORDER, J.JOIN_DETAIL), lambda o, d: SA.sale_detail(o, d, 300), delay, 300)


def _at(seconds):
    return None if seconds is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def _side_rows(spark, orders, details):
    o = spark.createDataFrame([(i, "1", "c", "u", "2024-01-01", _at(s)) for i, s in orders], J.JOIN_ORDER)
    d = spark.createDataFrame([(i, o, "s", "1.5", "n", _at(s)) for i, o, s in details], J.JOIN_DETAIL)
    return o, d


def test_join_memory_against_all_pairs(spark):
    """Batches out of order inside the delay, each record once or twice: every pair of 300 s, as often as its
    records came; the memory keeps the delay and 300 s, and a replayed batch changes nothing."""
    import random
    base, r = run_dir(spark, "t-memory"), random.Random(7)
    orders, details = [], []
    for k in range(60):
        at = r.randrange(6000)
        orders += [(f"o{k}", at)] * r.choice([1, 1, 2])
        details += [(f"d{k}-{j}", f"o{k}" if r.random() < 0.9 else "o1", at + r.randint(-400, 400)) for j in range(r.randint(0, 4))]
    due = lambda row: (row[-1] + r.randint(0, 500)) // 1000      # noqa: E731  the batch it comes in, late by 500 s at most
    by_batch = {}
    for side, recs in ((0, orders), (1, details)):
        for rec in recs:
            by_batch.setdefault(max(0, due(rec)), ([], []))[side].append(rec)
    got = {}
    for n in sorted(by_batch):
        for _ in range(2 if n == 3 else 1):
            memory = _memory(spark, base)                        # a restart: all that counts is in the files
            memory.join(memory.both(*_side_rows(spark, *by_batch[n])), n, lambda pairs: got.__setitem__(
                n, [tuple(x) for x in pairs.select("order_id", "order_detail_id").collect()]))
            last = min(max(x[-1] for m in by_batch if m <= n for x in by_batch[m][k]) for k in (0, 1))
            kept = [x["arrival"] for s in ("left", "right") for x in spark.read.parquet(f"{base}/memory/kept/batch_id={n}/{s}").collect()]
            assert all(x > _at(last - 900) for x in kept) and memory.rows[-1]["held"] == len(kept) and memory.rows[-1]["late"] == 0
    want = sorted((o, i) for o, a in orders for i, of, b in details if o == of and abs(a - b) <= 300)
    assert sorted(x for pairs in got.values() for x in pairs) == want and len(want) > 50


def test_join_memory_refuses_late_rows_and_forgets(spark):
    base = run_dir(spark, "t-late")
    memory, got = _memory(spark, base), []

    def batch(n, orders, details):
        memory.join(memory.both(*_side_rows(spark, orders, details)), n, lambda pairs: got.append(rows(pairs, "order_id", "order_detail_id")))
        return memory.rows[-1]
    assert batch(0, [("o1", 0), ("o2", 0), ("none", None)], [])["held"] == 2        # no watermark before both sides have a row
    assert batch(1, [], [("d1", "o1", 300), ("d2", "o1", 301), ("x", None, 5), ("y", "none", None)])["late"] == 0
    assert batch(2, [("o3", 5000)], [("d3", "o3", 5100)]) == {"held": 2, "most": 7, "removed": 5, "late": 0}
    assert batch(3, [("o4", 4400)], [("d4", "o3", 4401)])["late"] == 1              # at the watermark, 5000 - 600 s; above it
    assert batch(4, [], [])["held"] == memory.rows[-2]["held"]
    assert got == [[], [("o1", "d1")], [("o3", "d3")], [], []]


def test_sale_streams_hold_no_state_store(spark):
    """A look-up and two writes of a state store for each row took most of the join's time."""
    base = run_dir(spark, "t-no-store")
    _write_batches(spark, f"{base}/o", [[_order("o1", DAY1)]])
    _write_batches(spark, f"{base}/d", [[_detail("d1", "o1", DAY1)]])
    q = J.sale_join_job(J.file_stream(spark, f"{base}/o", TOPIC_RECORD), J.file_stream(spark, f"{base}/d", TOPIC_RECORD),
                        f"{base}/out", f"{base}/ck", "10 minutes")
    J._finish(q, "t-no-store")
    assert not any(p["stateOperators"] for p in q.recentProgress)
    assert J.STATE_ROWS.pop("t-no-store") == {"removed": 0, "late": 0, "most": 2, "last": 2, "batches": 1}
    assert rows(spark.read.parquet(f"{base}/out"), "order_detail_id") == [("d1",)]


def test_apps_users_and_sale_users_read_the_buckets_of_a_batch(spark):
    from tidemark import apps
    base = run_dir(spark, "t-sale-app")
    user = lambda k, level, ms=DAY1: ("gmall_user_info", {"id": f"u{k}", "login_name": "n", "user_level": level,
                                                 "birthday": "2000-01-01", "gender": "F"}, ms)
    _write_batches(spark, f"{base}/users_in", [[user(k, "L") for k in range(200)], [user(1, "M", DAY1 + 1)]])
    J._finish(apps.start(spark, "users", kind="files", path=f"{base}/users_in", out=f"{base}/users",
                         checkpoint=f"{base}/ck1", once=True))
    apps.main(["compact", "--table", "users", "--out", f"{base}/users"])
    users = J.users_table(spark, f"{base}/users")
    assert users._base() is not None and not [f for f in users._batches(users._base()).values() if f]
    found = users.lookup(spark.createDataFrame([("u1",), ("u9",), (None,), ("absent",)], "id string"))
    assert rows(found, "id", "user_level") == [("u1", "M"), ("u9", "L")]
    opened = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert 1 <= len(opened) <= 3
    _write_batches(spark, f"{base}/o", [[_order("o1", DAY1), _order("o2", DAY1 + 1000)]])
    _write_batches(spark, f"{base}/d", [[_detail("d1", "o1", DAY1), _detail("d2", "o2", DAY1)]])
    J._finish(apps.start(spark, "sale_users", kind="files", path=f"{base}/o", detail_path=f"{base}/d", users=f"{base}/users",
                         out=f"{base}/index", checkpoint=f"{base}/ck2", once=True))
    assert rows(J.sale_index(spark, f"{base}/index").read(), "order_detail_id", "user_level") == [("d1", "M"), ("d2", "M")]


def test_devices_are_remembered_across_batches_and_a_restart(spark):
    from tidemark.operators.rollup import Dashboard
    base = run_dir(spark, "t-devices")
    D = 24 * H

    def run():
        """A process: new objects, the same folders."""
        kept = Dashboard(spark, f"{base}/kept")
        q = J.first_seen_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), kept, f"{base}/ck")
        J._finish(q, "t-devices")
        return kept

    def dau(kept, day):
        return [r["value"] for r in kept.realtime_total(day).collect()][:2]

    b1 = [_log("m1", DAY1 + 5 * H), _log("m1", DAY1 + 3 * H), _log("m2", DAY1 + 6 * H), _log("m2", DAY1 + 6 * H)]
    b2 = [_log("m1", DAY1 + 2 * H), _log("m3", DAY1 + 20 * H), _log("m1", DAY1 + D + H)]
    b3 = [_log("m2", DAY1 + D + 2 * H), _log("m4", DAY1 + 2 * D), _log("m1", DAY1 + 2 * D)]
    _write_batches(spark, f"{base}/in", [b1, b2])
    kept = run()
    assert rows(kept.new_devices()) == [("2024-01-01", 3)]
    assert rows(kept.first_logs.read(), "logdate", "mid", "loghour") == [
        ("2024-01-01", "m1", "02"), ("2024-01-01", "m2", "06"), ("2024-01-01", "m3", "20"), ("2024-01-02", "m1", "01")]
    kept.compact()
    _write_batches(spark, f"{base}/in", [b3, []])
    kept = run()                                   # restarted: goes on where it stopped
    assert rows(kept.new_devices()) == [("2024-01-01", 3), ("2024-01-03", 1)]
    assert dau(kept, "2024-01-01") == [3.0, 3.0] and dau(kept, "2024-01-02") == [2.0, 0.0] and dau(kept, "2024-01-03") == [2.0, 1.0]
    hours = {r["hour"]: (r["today"], r["yesterday"]) for r in kept.hours("dau", "2024-01-02").collect()}
    assert hours["01"] == (1, 0) and hours["02"] == (1, 1) and hours["06"] == (0, 1) and len(hours) == 24
    assert kept.hours("other", "2024-01-02") is None
    # the checkpoint is lost as well: all logs come again, nothing counts twice
    kept.compact()
    again = J.first_seen_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), kept, f"{base}/ck-new")
    J._finish(again)
    assert rows(kept.new_devices()) == [("2024-01-01", 3), ("2024-01-03", 1)]


def test_order_totals_follow_changed_and_replayed_orders(spark):
    from tidemark.operators.rollup import Dashboard
    from tidemark.schemas import ORDER_SINK_COLUMNS

    def orders(*some):
        full = [tuple({"ID": i, "CREATE_DATE": d, "CREATE_HOUR": h, "TOTAL_AMOUNT": a}.get(c) for c in ORDER_SINK_COLUMNS) for i, d, h, a in some]
        return spark.createDataFrame(full, J.ORDER_SINK_ROW)

    kept = Dashboard(spark, run_dir(spark, "t-order-totals"), buckets=2)
    assert kept.realtime_total("d1").collect()[2]["value"] is None
    kept.add_orders(orders(("o1", "d1", "01", 10.0), ("o2", "d1", "02", 5.0), ("o3", None, None, 9.0)), 0)
    second = orders(("o1", "d2", "03", 11.0), ("o4", "d1", "02", 1.5), ("o2", "d1", "02", None))
    kept.add_orders(second, 1)
    kept.add_orders(second, 1)                     # written again
    total = lambda day: kept.realtime_total("x", day).collect()[2]["value"]
    assert (total("d1"), total("d2")) == (1.5, 11.0)
    kept.compact()
    kept.add_orders(second, 1)                     # replay of a compacted batch
    kept.add_orders(orders(("o1", "d1", "01", 2.0)), 2)
    assert (total("d1"), total("d2")) == (3.5, None)
    assert rows(kept.orders.rollups["totals"].read(), "CREATE_DATE", "CREATE_HOUR", "n") == [("d1", "01", 1), ("d1", "02", 2)]


def test_kept_dashboards_read_kept_tables_only(spark):
    import __spark_entry__ as E
    for name in ("kept_realtime_total", "kept_new_devices", "kept_dau_hours", "kept_order_hours"):
        files = E.queries()[name](spark, "/root/testdata/sf0.001").inputFiles()
        assert files and all("_totals/" in f for f in files)


def test_closed_alerts_equal_batch_and_state_does_not_follow_traffic(spark):
    from tidemark.operators import alerts as AL
    from tidemark.operators.parse import accepted, parse_json
    from tidemark.schemas import EVENT_LOG
    T0, s = DAY1, 1000
    most = []
    for busy in (1, 40):
        base = run_dir(spark, "t-alert-closed")

        def ev(uid, evid, ms):
            return ("gmall_event", {"mid": "m", "uid": uid, "evid": evid, "itemid": 1, "ts": ms}, ms)
        batches = [[ev("u1", "coupon", T0 + s), ev("u2", "coupon", T0 + 2 * s)] + [ev("u2", "share", T0 + 2 * s)] * busy,
                   [ev("u3", "coupon", T0 + 3 * s), ev("u3", None, T0 + 3 * s)] + [ev("u3", "scan", T0 + 9 * s)] * busy,
                   [ev("u4", "clickItem", T0 + 62 * s)], [ev(None, None, T0 + 999 * s)]]
        _write_batches(spark, f"{base}/in", batches)
        q = J.closed_alert_job(J.file_stream(spark, f"{base}/in", TOPIC_RECORD, 1), f"{base}/out", f"{base}/ck",
                               "60 seconds", "5 seconds", "30 seconds")
        J._finish(q, "t-alert-closed")
        batch = spark.read.schema(TOPIC_RECORD).parquet(f"{base}/in")
        expect = rows(AL.coupon_alerts(accepted(parse_json(batch, EVENT_LOG)), "60 seconds", "5 seconds"))
        assert rows(spark.read.schema(AL.ALERT_SCHEMA).parquet(f"{base}/out")) == expect and len(expect) == 12
        most.append(J.STATE_ROWS["t-alert-closed"]["most"])
        assert J.STATE_ROWS["t-alert-closed"]["removed"] > 0
        del J.STATE_ROWS["t-alert-closed"]
    assert most[0] == most[1]


def test_two_topics_of_different_schema_and_lateness(spark):
    """A topic that is behind holds the watermark back: its logs are not late."""
    base = run_dir(spark, "t-two-topics")

    def ev(ms):
        return ("gmall_event", {"mid": "m", "uid": "u", "evid": "coupon", "itemid": 7, "ts": ms}, ms)
    _write_batches(spark, f"{base}/s", [[_log("a", DAY1), _log("b", DAY1 + 50 * H)], [_log("a", DAY1 + 51 * H)], [_log("a", DAY1 + 52 * H)]])
    _write_batches(spark, f"{base}/e", [[ev(DAY1 + 1000)], [ev(DAY1 + 2000), ev(DAY1 + 2 * H)], [ev(DAY1 + 3 * H)]])
    kt = KeyedTable(spark, f"{base}/t", J.LOG_COUNT, ["topic", "hour_start"])
    J._finish(J.log_counts_job(J.file_stream(spark, f"{base}/s", TOPIC_RECORD, 1), J.file_stream(spark, f"{base}/e", TOPIC_RECORD, 1),
                               kt, f"{base}/ck", "10 minutes", "2 hours"), "t-two-topics")
    assert J.STATE_ROWS.pop("t-two-topics")["late"] == 0
    got = {(r["topic"], int(r["hour_start"].replace(tzinfo=dt.timezone.utc).timestamp() * 1000 - DAY1) // H): r["logs"] for r in kt.read().collect()}
    assert got == {("gmall_startup", 0): 1, ("gmall_startup", 50): 1, ("gmall_startup", 51): 1, ("gmall_startup", 52): 1,
                   ("gmall_event", 0): 2, ("gmall_event", 2): 1, ("gmall_event", 3): 1}


def test_transfer_app_writes_the_target_topic(spark):
    from tidemark import apps
    base = run_dir(spark, "t-transfer")
    recs = [("first", 0, 1, "k", "atguigu>>>a atguigu>>>b", None), ("first", 0, 2, None, None, None), ("other", 0, 3, "k", "c", None)]
    spark.createDataFrame(recs, TOPIC_RECORD).write.parquet(f"{base}/in")
    J._finish(apps.start(spark, "transfer", kind="files", path=f"{base}/in", out=f"{base}/out", checkpoint=f"{base}/ck", once=True))
    got = spark.read.parquet(f"{base}/out").select("topic", "key", "value").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("second", "k", "a b"), ("second", None, None)], key=str)


def test_offsets_app_keeps_the_raw_topic(spark):
    from tidemark import apps
    base = run_dir(spark, "t-offsets-app")
    recs = [("first", p, o, None, f"v{o}", None) for p in (0, 1) for o in range(50)]
    spark.createDataFrame(recs, TOPIC_RECORD).repartition(4).write.parquet(f"{base}/in")
    for _ in range(2):   # a restart from the checkpoint appends nothing again
        J._finish(apps.start(spark, "offsets", kind="files", path=f"{base}/in", out=f"{base}/out", checkpoint=f"{base}/ck", once=True))
    got = apps.TABLES["offsets"](spark, f"{base}/out").fetch("first", 1, 40, 6).collect()
    assert sorted(map(tuple, got)) == [(40, "v40"), (41, "v41")]


def test_a_batch_that_meets_itself_is_not_made_again(spark, monkeypatch):
    """The batch's sales and the ids that look up their users are read from files: no plan reaches the join's state."""
    import __spark_entry__ as E
    plans, split = [], J.SA.with_users_split

    def seen(*args):
        out = split(*args)
        plans.append(out[0]._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(J.SA, "with_users_split", seen)
    assert E.queries()["stream_sale_users"](spark, "/root/testdata/sf0.001").count() > 0
    assert plans and not any("ExistingRDD" in p for p in plans)


def test_a_staged_slice_has_files_for_more_than_one_core(spark):
    from tidemark.operators.keyed import list_children
    path = run_dir(spark, "t-cores") + "/in"
    J.stage_in_order(spark.range(100_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                                 F.timestamp_seconds("id").alias("at")), path, "at")
    assert sum(n.endswith(".parquet") for n in list_children(spark, path)) >= 16
    assert spark.read.parquet(path).count() == 100_000


def test_rows_new_to_a_kept_table_are_marked_and_read_without_an_aggregate(spark):
    from tidemark.operators.keyed import KeyedTable, list_children
    from tidemark.operators.rollup import FIRST_SEEN, KeptTable, Rollup
    path = run_dir(spark, "t-kept")
    kept = KeptTable(KeyedTable(spark, f"{path}/rows", FIRST_SEEN, ["mid"]),
                     {"totals": Rollup(spark, f"{path}/totals", ["logdate"])})
    for n, mids in enumerate((["a", "b"], ["c"])):
        kept.upsert(spark.createDataFrame([(m, 1, f"d{n}") for m in mids], FIRST_SEEN), n)
    assert "Aggregate" not in kept.read()._jdf.queryExecution().executedPlan().toString()
    assert sorted(r[0] for r in kept.read().collect()) == ["a", "b", "c"]
    kept.upsert(spark.createDataFrame([("a", 1, "d2")], FIRST_SEEN), 2)
    assert sorted((r[0], r[2]) for r in kept.read().collect()) == [("a", "d2"), ("b", "d0"), ("c", "d1")]
    assert {r["logdate"]: r["n"] for r in kept.rollups["totals"].read().collect()} == {"d0": 1, "d1": 1, "d2": 1}
    assert [list_children(spark, f"{path}/rows/log/batch_id={n}")[0].endswith("-fresh") for n in (1, 2)] == [True, False]
