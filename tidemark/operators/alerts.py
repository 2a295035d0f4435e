"""Coupon-abuse alert over sliding windows.

Per device and window: distinct uids and item ids of coupon events, per-event
counts and whether any item was clicked. Aggregations are planned with a
partial (map-side) aggregate, so a hot device is reduced before the shuffle.
The same function runs on a batch frame or a watermarked stream.

The event list of the reference is kept as counts per event id: it carries
the same multiset, and its size is bounded by the event ids seen instead of
growing with a device's traffic. The known ids (``EVENT_IDS``) have a column
each; ids beyond them, and events without an id, are in ``others``. A batch
counts by event id first. A stream in update mode may aggregate only once, so
its state holds the others' ids event by event until the window closes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import ALERT_MIN_UIDS, ALERT_SLIDE, ALERT_WINDOW, CLICK, COUPON, EVENT_IDS
from tidemark.functions.timefmt import instant_to_ntz

MIN_UIDS, WINDOW, SLIDE = ALERT_MIN_UIDS, ALERT_WINDOW, ALERT_SLIDE
ALERT_SCHEMA = ("mid string, window_start string, window_end string, uids string, itemids string, "
                "events string, event_count bigint")


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``event_time`` (TIMESTAMP instant) from epoch-ms ``ts``."""
    return events.withColumn("event_time", F.timestamp_millis(F.col(ts)))


def _is_other() -> Column:
    """Whether an event has none of the known ids, or no id at all."""
    return ~F.coalesce(F.col("evid").isin(*EVENT_IDS), F.lit(False))


def _sets() -> list[Column]:
    is_coupon = F.col("evid") == COUPON
    return [F.collect_set(F.when(is_coupon, F.col(c))).alias(f"{c}s") for c in ("uid", "itemid")]


def _merged(*rest: Column) -> list[Column]:
    return [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("uids", "itemids")] + list(rest)


def _together(by_event: DataFrame, *keys: str) -> DataFrame:
    """The ingredients per key, from rows per key and event id."""
    evid, n = F.col("evid"), F.col("n")
    return by_event.groupBy(*keys).agg(*_merged(
        F.sum("n").alias("event_count"),
        F.bool_or(evid == CLICK).alias("has_click"),
        *[F.coalesce(F.sum(F.when(evid == e, n)), F.lit(0).cast("bigint")).alias(f"n_{e}") for e in EVENT_IDS],
        F.array_sort(F.collect_list(F.when(_is_other(), F.struct(evid, n)))).alias("others")))


def window_aggregate(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """One row per (mid, window) with the alert ingredients."""
    evid = F.col("evid")
    # Grouped by the window struct itself so a stream's watermark can evict it.
    w = F.window("event_time", window, slide).alias("w")
    if events.isStreaming:
        agg = events.groupBy("mid", w).agg(
            *_sets(), F.count(F.lit(1)).alias("event_count"), F.bool_or(evid == CLICK).alias("has_click"),
            *[F.count_if(evid == e).alias(f"n_{e}") for e in EVENT_IDS],
            F.collect_list(F.when(_is_other(), F.struct(evid))).alias("_list"))
        counted = F.transform(F.array_sort(F.array_distinct("_list")), lambda x: F.struct(
            x["evid"].alias("evid"),
            F.size(F.filter("_list", lambda y: y["evid"].eqNullSafe(x["evid"]))).cast("bigint").alias("n")))
        agg = agg.withColumn("others", counted).drop("_list")
    else:
        agg = _together(events.groupBy("mid", w, "evid").agg(*_sets(), F.count(F.lit(1)).alias("n")), "mid", "w")
    rest = [c for c in agg.columns if c not in ("mid", "w")]
    return agg.select("mid", F.col("w.start").alias("window_start_ts"),
                      F.col("w.end").alias("window_end_ts"), *rest)


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * mult[unit.rstrip("s").lower()]


def window_aggregate_panes(events: DataFrame, window: str = WINDOW,
                           slide: str = SLIDE) -> DataFrame:
    """Batch form of ``window_aggregate`` built from panes.

    Events are aggregated once per (mid, slide-long pane, event id); each
    window is then assembled from its panes (window / slide of them, so the
    fan-out multiplies pane rows, not events) by merging sets and adding counts.
    Same output as ``window_aggregate``; needs window a multiple of slide.
    """
    w_s, s_s = _seconds(window), _seconds(slide)
    if w_s % s_s:
        return window_aggregate(events, window, slide)
    pane = F.window("event_time", slide).start
    panes = events.groupBy("mid", pane.alias("pane"), "evid").agg(*_sets(), F.count(F.lit(1)).alias("n"))
    # every window holding the pane: starts pane - i*slide, i = 0..window/slide-1
    i = F.explode(F.sequence(F.lit(0), F.lit(w_s // s_s - 1))).alias("_i")
    spread = panes.select("*", i).withColumn(
        "window_start_ts", F.timestamp_add("SECOND", -F.col("_i") * s_s, F.col("pane")))
    by_event = spread.groupBy("mid", "window_start_ts", "evid").agg(*_merged(F.sum("n").alias("n")))
    agg = _together(by_event, "mid", "window_start_ts")
    rest = [c for c in agg.columns if c not in ("mid", "window_start_ts")]
    return agg.select("mid", "window_start_ts",
                      F.timestamp_add("SECOND", F.lit(w_s), F.col("window_start_ts")).alias("window_end_ts"), *rest)


def window_aggregate_chained(events: DataFrame, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """Append-mode stream form: panes, then windows over the closed panes.

    Two stateful aggregations in a row. The first holds a row for each (mid,
    open pane, event id); the second adds closed panes to their windows, so the
    sliding fan-out multiplies pane rows and the state has a number for each event
    id, however often it occurs. Rows appear when the watermark has passed their window. Same
    output as ``window_aggregate``; needs window a multiple of slide.
    """
    if _seconds(window) % _seconds(slide):
        raise ValueError("the window must be a multiple of the slide")
    panes = events.groupBy("mid", F.window("event_time", slide).alias("pane"), "evid").agg(
        *_sets(), F.count(F.lit(1)).alias("n")).withColumn("at", F.window_time("pane"))
    evid, n = F.col("evid"), F.col("n")
    agg = panes.groupBy("mid", F.window("at", window, slide).alias("w")).agg(*_merged(
        F.sum("n").alias("event_count"), F.bool_or(evid == CLICK).alias("has_click"),
        *[F.coalesce(F.sum(F.when(evid == e, n)), F.lit(0).cast("bigint")).alias(f"n_{e}") for e in EVENT_IDS],
        F.collect_list(F.when(_is_other(), F.struct(evid, n))).alias("_list")))     # a row for each pane and id
    ids = F.array_distinct(F.transform("_list", lambda x: x["evid"]))
    others = F.array_sort(F.transform(ids, lambda e: F.struct(e.alias("evid"), F.aggregate(
        F.filter("_list", lambda y: y["evid"].eqNullSafe(e)), F.lit(0).cast("bigint"), lambda a, y: a + y["n"]).alias("n"))))
    agg = agg.withColumn("others", others).drop("_list")
    rest = [c for c in agg.columns if c not in ("mid", "w")]
    return agg.select("mid", F.col("w.start").alias("window_start_ts"), F.col("w.end").alias("window_end_ts"), *rest)


def _fmt(ts):
    return F.date_format(instant_to_ntz(ts), "yyyy-MM-dd HH:mm:ss")


def alerts(agg: DataFrame, min_uids: int = MIN_UIDS) -> DataFrame:
    """Windows with no item click and at least ``min_uids`` distinct coupon uids.

    Output: mid, window_start, window_end, uids, itemids (sorted, comma
    joined), events ('evid:count' for each event id seen: the known ids in
    their order, then the others by name; 'null:count' for events without an
    id), event_count.
    """
    # concat_ws skips the nulls of event ids that did not occur, and a null array
    ev = F.concat_ws(",", *[
        F.when(F.col(f"n_{e}") > 0, F.concat(F.lit(e + ":"), F.col(f"n_{e}").cast("string")))
        for e in EVENT_IDS],
        F.transform("others", lambda x: F.concat(F.coalesce(x["evid"], F.lit("null")), F.lit(":"), x["n"].cast("string"))))
    return agg.where(~F.col("has_click") & (F.size("uids") >= min_uids)).select(
        "mid", _fmt(F.col("window_start_ts")).alias("window_start"),
        _fmt(F.col("window_end_ts")).alias("window_end"),
        F.array_join(F.array_sort("uids"), ",").alias("uids"),
        F.array_join(F.array_sort("itemids"), ",").alias("itemids"),
        ev.alias("events"), "event_count")


def coupon_alerts(events: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                  min_uids: int = MIN_UIDS) -> DataFrame:
    """Batch alerts (pane-based aggregation)."""
    return alerts(window_aggregate_panes(with_event_time(events), window, slide), min_uids)


def keyed_alerts(alert_rows: DataFrame) -> DataFrame:
    """Document id ``mid_<minute of window end>``; a later alert of the same
    id replaces the earlier one (latest window end wins)."""
    end_ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                              F.to_timestamp_ntz(F.col("window_end")))
    doc = F.concat(F.col("mid"), F.lit("_"), F.floor(end_ms / 60000).cast("string"))
    cols = [c for c in alert_rows.columns]
    m = F.max(F.struct(*[F.col(c) for c in ["window_end"] + [c for c in cols if c != "window_end"]]))
    return alert_rows.withColumn("doc_id", doc).groupBy("doc_id").agg(m.alias("_m")).select(
        "doc_id", *[F.col(f"_m.{c}").alias(c) for c in cols])

