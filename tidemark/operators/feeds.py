"""Feed routing and rewriting: CDC routing, log intake routing, marker strip,
time prefix, offset-range read, delivery counts. All stateless projections
and filters except the offset-range byte cap (S4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed import (FETCH_BYTES, FIXED_PARTITION, MARKER, TOPIC_EVENT,
                            TOPIC_ORDER_DETAIL, TOPIC_ORDER_INFO, TOPIC_STARTUP, TOPIC_USER_INFO)
from tidemark.functions.text import prefix_millis, strip_marker
from tidemark.functions.timefmt import log_date
from tidemark.operators.parse import accepted

def cdc_topic(table, event_type):
    """Routing rule: order_info INSERT, order_detail INSERT, user_info INSERT or
    UPDATE; every other change is dropped (null topic)."""
    tb, ev = F.col(table), F.col(event_type)
    return (F.when((tb == "order_info") & (ev == "INSERT"), F.lit(TOPIC_ORDER_INFO))
            .when((tb == "order_detail") & (ev == "INSERT"), F.lit(TOPIC_ORDER_DETAIL))
            .when((tb == "user_info") & ev.isin("INSERT", "UPDATE"), F.lit(TOPIC_USER_INFO)))


def cdc_route(changes: DataFrame) -> DataFrame:
    """Row changes -> (topic, value) with value = JSON object of after-image text."""
    rows = changes.where(F.col("entry_type") == "ROWDATA")
    routed = rows.select(cdc_topic("table", "event_type").alias("topic"),
                         F.to_json(F.col("after")).alias("value"))
    return routed.where(F.col("topic").isNotNull())


def log_lines(raw: DataFrame, arrival_ms: str = "arrival_ms") -> DataFrame:
    """Client log lines as ``line`` (every field as it came), ``_corrupt`` set for
    lines that are not a JSON object, and the intake time as ``_a``."""
    value = F.col("value")
    parsed = F.struct(F.from_json(value, "map<string,variant>").alias("line"), value.alias("_raw"))
    out = raw.select(F.col(arrival_ms).alias("_a"), F.inline(F.array(parsed)))  # parsed once, as in parse_json
    bad = F.when(F.trim("_raw") == "", F.lit("")).otherwise(F.coalesce("_raw", F.lit("")))
    return out.select("_a", "line", F.when(F.col("line").isNull() | (F.trim("_raw") == ""), bad).alias("_corrupt"))


def log_route(raw: DataFrame, arrival_ms: str = "arrival_ms", zone: str = "UTC") -> DataFrame:
    """Client log lines -> (topic, value, dt): intake time stamped into ``ts``
    (replacing the client's, whatever it is), all other fields as they came;
    startup logs to the startup topic and every other line (missing type
    included) to the event topic; ``dt`` names the daily log file. Lines that
    are not a JSON object are not routed (``rejected(log_lines(raw))`` returns
    them)."""
    lines = accepted(log_lines(raw, arrival_ms))
    rest = F.to_json(F.map_filter("line", lambda k, _: k != "ts"))
    stamp = F.concat(F.lit('"ts":'), F.col("_a").cast("string"), F.lit("}"))
    value = F.when(rest == "{}", F.concat(F.lit("{"), stamp)).otherwise(
        F.concat(F.substring(rest, F.lit(1), F.length(rest) - 1), F.lit(","), stamp))
    kind = F.try_variant_get(F.element_at("line", "type"), "$", "string")
    topic = F.when(kind == "startup", F.lit(TOPIC_STARTUP)).otherwise(F.lit(TOPIC_EVENT))
    return lines.select(topic.alias("topic"), value.alias("value"), log_date("_a", zone).alias("dt"))


def strip_topic(records: DataFrame, marker: str = MARKER) -> DataFrame:
    """Topic-to-topic rewrite: remove the marker from every value, key kept."""
    return records.select("topic", "partition", "offset", "key",
                          strip_marker("value", marker).alias("value"))


def prefix_time(records: DataFrame, partition: int = FIXED_PARTITION) -> DataFrame:
    """Producer-side rewrite: value -> '<ms>-<value>'; fixed target partition."""
    return records.select("topic", F.lit(partition).cast("int").alias("partition"), "key",
                          prefix_millis("value", "timestamp").alias("value"))


def offset_range(records: DataFrame, topic: str, partition: int, start: int,
                 max_bytes: int = FETCH_BYTES, chunk: int = 1 << 20) -> DataFrame:
    """Records of one topic partition from offset ``start`` while the running
    total of value bytes stays within ``max_bytes``.

    The running total is computed in two levels so no task holds the whole
    partition: byte sums per offset chunk, a running sum over the (small)
    chunk list, then row-level running sums only inside chunks that start
    within the cap.
    """
    r = records.where((F.col("topic") == topic) & (F.col("partition") == partition)
                      & (F.col("offset") >= start)).select(
        "offset", "value",
        F.coalesce(F.octet_length("value"), F.lit(0)).cast("long").alias("_b"),
        F.floor((F.col("offset") - start) / chunk).cast("long").alias("_c"))
    per_chunk = r.groupBy("_c").agg(F.sum("_b").alias("_cb"))
    before = per_chunk.select(
        "_c", (F.sum("_cb").over(Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, 0))
               - F.col("_cb")).alias("_before"))
    live = before.where(F.col("_before") <= max_bytes)
    rows = r.join(live, "_c", "inner")
    run = F.sum("_b").over(Window.partitionBy("_c").orderBy("offset")
                           .rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("offset", "value", (F.col("_before") + run).alias("_upto")).where(
        F.col("_upto") <= max_bytes).select("offset", "value")


def delivery_counts(results: DataFrame, ok: str = "acked") -> DataFrame:
    """Totals of acknowledged and failed sends."""
    return results.agg(F.count_if(F.col(ok)).alias("success"),
                       F.count_if(~F.col(ok)).alias("failure"))
