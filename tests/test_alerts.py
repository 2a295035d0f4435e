"""Coupon alert on hand-made rows with the reference's 60 s window / 5 s slide."""

from tests.conftest import rows
from tidemark.operators import alerts as AL

T0 = 1704067200000  # 2024-01-01 00:00:00 UTC
S = 1000


def _events(spark, data):
    return spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts long")


def _alert_windows(spark, data):
    return AL.coupon_alerts(_events(spark, data), "60 seconds", "5 seconds", 3)


def test_three_coupon_uids_alert(spark):
    ev = [("m", "u1", "coupon", "1", T0 + 1 * S), ("m", "u2", "coupon", "2", T0 + 2 * S),
          ("m", "u3", "coupon", "2", T0 + 3 * S)]
    out = _alert_windows(spark, ev)
    got = rows(out, "window_start", "uids", "itemids", "events", "event_count")
    # every 60 s window (5 s slide) holding all three events alerts
    assert len(got) == 12
    assert got[-1] == ("2024-01-01 00:00:00", "u1,u2,u3", "1,2", "coupon:3", 3)


def test_click_suppresses_alert(spark):
    ev = [("m", "u1", "coupon", "1", T0 + 1 * S), ("m", "u2", "coupon", "2", T0 + 2 * S),
          ("m", "u3", "coupon", "2", T0 + 3 * S), ("m", "u1", "clickItem", "9", T0 + 4 * S)]
    assert _alert_windows(spark, ev).count() == 0


def test_two_uids_or_non_coupon_uid_no_alert(spark):
    ev = [("m", "u1", "coupon", "1", T0 + 1 * S), ("m", "u2", "coupon", "2", T0 + 2 * S),
          ("m", "u2", "coupon", "3", T0 + 3 * S), ("m", "u3", "addCart", "2", T0 + 3 * S),
          ("m", None, "coupon", "4", T0 + 4 * S)]      # null uid is not counted
    assert _alert_windows(spark, ev).count() == 0


def test_click_61_seconds_before_only_blocks_its_windows(spark):
    ev = [("m", "u0", "clickItem", "9", T0), ("m", "u1", "coupon", "1", T0 + 61 * S),
          ("m", "u2", "coupon", "1", T0 + 62 * S), ("m", "u3", "coupon", "1", T0 + 63 * S)]
    got = rows(_alert_windows(spark, ev), "window_start", "window_end")
    assert got and all(ws > "2024-01-01 00:00:00" for ws, _ in got)
    assert ("2024-01-01 00:00:05", "2024-01-01 00:01:05") in got


def test_keyed_alert_one_per_mid_minute(spark):
    ev = [("m", "u1", "coupon", "1", T0 + 1 * S), ("m", "u2", "coupon", "2", T0 + 2 * S),
          ("m", "u3", "coupon", "2", T0 + 3 * S)]
    keyed = AL.keyed_alerts(_alert_windows(spark, ev))
    got = rows(keyed, "doc_id", "window_end")
    # 12 window ends: 00:00:05 .. 00:01:00 -> minutes 0 (11 ends) and 1 (1 end)
    m0 = str((T0 // 60000))
    assert [d for d, _ in got] == [f"m_{m0}", f"m_{int(m0) + 1}"]
    assert got[0][1] == "2024-01-01 00:00:55"      # latest window end of minute 0 wins


def test_pane_aggregation_equals_window_aggregation(spark):
    import random
    rnd = random.Random(7)
    evs = ["coupon", "coupon", "addCart", "clickItem", "addFavor"]
    data = [(f"m{rnd.randrange(4)}", f"u{rnd.randrange(6)}", rnd.choice(evs), str(rnd.randrange(5)),
             T0 + rnd.randrange(0, 600) * S) for _ in range(400)]
    ev = AL.with_event_time(_events(spark, data))
    direct = AL.window_aggregate(ev, "60 seconds", "5 seconds")
    panes = AL.window_aggregate_panes(ev, "60 seconds", "5 seconds")
    cols = ["mid", "window_start_ts", "window_end_ts", "event_count", "has_click", "n_coupon"]
    from pyspark.sql import functions as F
    norm = [F.array_sort("uids").alias("u"), F.array_sort("itemids").alias("i")]
    assert rows(direct.select(*cols, *norm)) == rows(panes.select(*cols, *norm))
    assert rows(AL.alerts(direct)) == rows(AL.alerts(panes))


def test_events_of_any_id_are_listed(spark):
    ev = [("m", f"u{k}", "coupon", "1", T0 + k * S) for k in range(3)]
    ev += [("m", "u1", e, "1", T0 + 40 * S + k) for k, e in enumerate(["share", "share", "scan", "addCart", None])]
    for window, slide in (("60 seconds", "5 seconds"), ("60 seconds", "7 seconds")):
        got = AL.coupon_alerts(_events(spark, ev), window, slide, 3).where("event_count = 8")
        assert {r["events"] for r in got.collect()} == {"addCart:1,coupon:3,null:1,scan:1,share:2"}
    frame = AL.with_event_time(_events(spark, ev))
    direct = AL.window_aggregate(frame, "60 seconds", "5 seconds")
    assert rows(AL.alerts(direct)) == rows(_alert_windows(spark, ev))
