"""Registered batch queries: (spark, data folder) -> DataFrame.

Each query builds its plan from the driver tables through the adapters and
operators; nothing is collected. Streaming variants live in
``tidemark.streaming.jobs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import alerts as AL
from tidemark.operators import cells as CE
from tidemark.operators.celltable import CellTable
from tidemark.operators import dedup as DD
from tidemark.operators import feeds as FE
from tidemark.operators import metrics as ME
from tidemark.operators import sales as SA
from tidemark.operators import search as SE
from tidemark.operators.keyed import KeyedTable, stamp
from tidemark.operators.orders import clean_orders, to_order_sink
from tidemark.operators.offsetlog import OffsetLog
from tidemark.operators.rollup import Dashboard
from tidemark.operators.parse import accepted, parse_json
from tidemark.operators.textindex import SearchIndex
from tidemark.plans import params as P
from tidemark.schemas import ORDER_INFO, STARTUP_LOG, USER_INFO
from tidemark.fixed import TOPIC_STRIPPED
from tidemark.functions.timefmt import log_date, log_hour, ntz_to_epoch_ms, previous_day_str
from tidemark.session import run_dir
from tidemark.sources import adapters as AD
from tidemark.sources.tables import tables


class Ctx:
    """Lazy derived frames for one data folder. ``days`` narrows the scans
    to what a dated dashboard query can touch (exact date filters follow)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.t = tables(spark, root)

    # ---- daily active devices
    def startup(self, days=None) -> DataFrame:
        topic = AD.log_topic(AD.startup_logs(self.t, days), AD.TOPIC_STARTUP)
        return DD.with_log_date_hour(accepted(parse_json(topic, STARTUP_LOG)))

    def dau(self, days=None) -> DataFrame:
        return DD.first_logs(self.startup(days))

    # ---- orders
    def orders(self, days=None, customer: bool = False) -> DataFrame:
        """Cleaned orders; ``customer`` where the province or consignee is used."""
        return clean_orders(AD.order_infos(self.t, days, customer))

    def details(self, days=None, arrival: bool = True) -> DataFrame:
        return AD.order_details(self.t, days, arrival)

    def users(self) -> DataFrame:
        return SA.latest_users(AD.user_changes(self.t))

    def sales(self, days=None) -> DataFrame:
        return SA.with_users(SA.sale_detail(self.orders(days), self.details(days), P.JOIN_SECONDS),
                             self.users(), P.AS_OF)

    def hits(self) -> DataFrame:
        return SE.search(self.sales([P.ORDER_DATE]), P.ORDER_DATE, P.KEYWORD)


def _ctx(spark, root):
    return Ctx(spark, root)


# ----------------------------------------------------------------------- DAU

def q_dau_first_log(spark, root):
    return DD.to_dau_sink(_ctx(spark, root).dau())


def _cut_ms():
    return ntz_to_epoch_ms(F.lit(P.SEEN_CUTOFF).cast("timestamp_ntz"))


def _seen_and_batch(c: Ctx):
    """Logs before the cutoff (earlier batches, the seen set) and after it."""
    logs = c.startup()
    return (logs.where(F.col("ts") < _cut_ms()).select("logdate", "mid"),
            logs.where(F.col("ts") >= _cut_ms()))


def q_dau_incremental(spark, root):
    seen, batch = _seen_and_batch(_ctx(spark, root))
    return DD.to_dau_sink(DD.incremental_first_logs(batch, seen))


def q_dau_total(spark, root):
    return ME.dau_total(_ctx(spark, root).dau([P.DAU_DATE]), P.DAU_DATE)


def q_dau_by_hour(spark, root):
    return ME.dau_by_hour(_ctx(spark, root).dau([P.DAU_DATE]), P.DAU_DATE)


def q_dau_hours_compare(spark, root):
    days = [previous_day_str(P.DAU_DATE), P.DAU_DATE]
    return ME.hours_compare(_ctx(spark, root).dau(days), P.DAU_DATE, "logdate", "loghour")


def q_new_devices(spark, root):
    return DD.new_devices_by_date(_ctx(spark, root).dau())


def q_pipeline_counts(spark, root):
    logs = _ctx(spark, root).startup()
    return DD.stage_counts_at_once(logs, F.col("ts") < _cut_ms())


# -------------------------------------------------------------------- orders

def q_order_info_clean(spark, root):
    c = _ctx(spark, root)
    raw = AD.order_infos(c.t)
    topic = raw.select(F.to_json(F.struct(*[f.name for f in ORDER_INFO.fields])).alias("value"))
    return to_order_sink(clean_orders(accepted(parse_json(topic, ORDER_INFO))))


def q_order_amount_total(spark, root):
    return ME.order_amount_total(_ctx(spark, root).orders([P.ORDER_DATE]), P.ORDER_DATE)


def q_order_amount_by_hour(spark, root):
    return ME.order_amount_by_hour(_ctx(spark, root).orders([P.ORDER_DATE]), P.ORDER_DATE)


def q_order_hours_compare(spark, root):
    days = [previous_day_str(P.ORDER_DATE), P.ORDER_DATE]
    return ME.hours_compare(_ctx(spark, root).orders(days), P.ORDER_DATE, "create_date",
                            "create_hour", "total_amount", 0.0)


def q_realtime_total(spark, root):
    c = _ctx(spark, root)
    # new devices need every day's first logs; the other two rows one day each
    return ME.realtime_total(c.dau([P.DAU_DATE]), DD.new_devices_by_date(c.dau()),
                             c.orders([P.ORDER_DATE]), P.DAU_DATE, P.ORDER_DATE)


def _derived(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once and read back: both batches are taken from it, not derived twice."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Kept dashboards of this session, by the state of the tables that they were made from.
_DASHBOARDS: dict[tuple, Dashboard] = {}


def kept_dashboard(spark: SparkSession, root: str) -> Dashboard:
    """The dashboards' tables of a data folder, kept in the shared folder: logs in two
    batches (before the cutoff, and after), orders in two (before the day, and
    after), compacted; made when first asked for, and again when a table changes."""
    c = _ctx(spark, root)
    key = (spark.sparkContext.applicationId, tuple(stamp(spark, c.t.path(name)) for name in ("events", "orders", "customer")))
    if key not in _DASHBOARDS:
        kept = Dashboard(spark, run_dir(spark, "dashboard"))
        startup = _derived(c.startup(), f"{kept.path}/derived/logs")
        for n, logs in enumerate((startup.where(F.col("ts") < _cut_ms()), startup.where(F.col("ts") >= _cut_ms()))):
            kept.add_logs(logs, n)
        rows = _derived(to_order_sink(c.orders(customer=True)), f"{kept.path}/derived/orders")
        earlier = F.coalesce(F.col("CREATE_DATE") < P.ORDER_DATE, F.lit(True))
        for n, orders in enumerate((rows.where(earlier), rows.where(~earlier))):
            kept.add_orders(orders, n)
        kept.compact()
        _DASHBOARDS[key] = kept
    return _DASHBOARDS[key]


def q_kept_realtime_total(spark, root):
    return kept_dashboard(spark, root).realtime_total(P.DAU_DATE, P.ORDER_DATE)


def q_kept_new_devices(spark, root):
    return kept_dashboard(spark, root).new_devices()


def q_kept_dau_hours(spark, root):
    return kept_dashboard(spark, root).hours("dau", P.DAU_DATE)


def q_kept_order_hours(spark, root):
    return kept_dashboard(spark, root).hours("order_amount", P.ORDER_DATE)


def q_province_amount(spark, root):
    c = _ctx(spark, root)
    return ME.province_amount(c.orders(customer=True), c.t.nation)


def q_province_bands(spark, root):
    c = _ctx(spark, root)
    return ME.province_bands(ME.province_amount(c.orders(customer=True), c.t.nation), "order_count",
                             P.BAND_WIDTH)


# --------------------------------------------------------------------- sales

def q_order_detail_outer(spark, root):
    c = _ctx(spark, root)
    return SA.order_detail_outer(AD.order_infos(c.t, customer=False), c.details(), P.BATCH_SECONDS)


def q_sale_detail(spark, root):
    c = _ctx(spark, root)
    return SA.sale_detail(c.orders(), c.details(arrival=False))


def q_sale_detail_interval(spark, root):
    c = _ctx(spark, root)
    return SA.sale_detail(c.orders(), c.details(), P.JOIN_SECONDS)


def q_latest_user(spark, root):
    return _ctx(spark, root).users()


def q_sale_detail_users(spark, root):
    return _ctx(spark, root).sales()


def q_sale_search_total(spark, root):
    return SE.total(_ctx(spark, root).hits())


def q_sale_search_page(spark, root):
    c = _ctx(spark, root)
    return SE.page(c.sales([P.ORDER_DATE]), P.ORDER_DATE, P.KEYWORD, P.PAGE_NO, P.PAGE_SIZE,
                   corpus=c.sales())


def q_sale_search_ranked(spark, root):
    c = _ctx(spark, root)
    return SE.ranked(c.sales([P.ORDER_DATE]), P.ORDER_DATE, P.KEYWORD, corpus=c.sales())


def q_sale_gender_terms(spark, root):
    return SE.gender_terms(_ctx(spark, root).hits())


def q_sale_age_terms(spark, root):
    return SE.age_terms(_ctx(spark, root).hits())


def q_sale_stat_gender(spark, root):
    return SE.gender_share(_ctx(spark, root).hits())


def q_sale_stat_age(spark, root):
    return SE.age_share(_ctx(spark, root).hits())


#: Search indexes kept by this session, by the state of the tables that they were made from.
_INDEXES: dict[tuple, SearchIndex] = {}


def kept_index(spark: SparkSession, root: str) -> SearchIndex:
    """The sale index of a data folder, kept in the shared folder: written in two
    batches (sales before the searched day, and the rest) and compacted when it is
    first asked for, and again when a table changes; searches then read it."""
    c = _ctx(spark, root)
    made_from = tuple(stamp(spark, c.t.path(name)) for name in ("orders", "lineitem", "customer", "part"))
    key = (spark.sparkContext.applicationId, made_from)
    if key not in _INDEXES:
        index = SearchIndex(spark, run_dir(spark, "sale-index"))
        sales = _derived(c.sales(), f"{index.path}/derived")
        earlier = F.coalesce(F.col("dt") < P.ORDER_DATE, F.lit(True))
        index.upsert(sales.where(earlier), 0)
        index.upsert(sales.where(~earlier), 1)
        index.compact()
        _INDEXES[key] = index
    return _INDEXES[key]


def q_sale_index_total(spark, root):
    return kept_index(spark, root).total(P.ORDER_DATE, P.KEYWORD)


def q_sale_index_page(spark, root):
    return kept_index(spark, root).page(P.ORDER_DATE, P.KEYWORD, P.PAGE_NO, P.PAGE_SIZE)


def q_sale_index_ranked(spark, root):
    return kept_index(spark, root).ranked(P.ORDER_DATE, P.KEYWORD)


def q_sale_index_stat_age(spark, root):
    return SE.age_share(kept_index(spark, root).hits(P.ORDER_DATE, P.KEYWORD))


# -------------------------------------------------------------------- alerts

def q_coupon_alert(spark, root):
    c = _ctx(spark, root)
    return AL.coupon_alerts(AD.event_logs(c.t), P.ALERT_WINDOW, P.ALERT_SLIDE, P.ALERT_MIN_UIDS)


def q_coupon_alert_keyed(spark, root):
    return AL.keyed_alerts(q_coupon_alert(spark, root))


# --------------------------------------------------------------------- feeds

def q_cdc_route(spark, root):
    return FE.cdc_route(AD.cdc_changes(_ctx(spark, root).t, timed=False))


def q_log_route(spark, root):
    return FE.log_route(AD.raw_logs(_ctx(spark, root).t))


def q_topic_strip(spark, root):
    return FE.strip_topic(AD.topic_records(_ctx(spark, root).t))


def q_topic_transfer(spark, root):
    records = FE.strip_topic(AD.topic_records(_ctx(spark, root).t))
    return records.select(F.lit(TOPIC_STRIPPED).alias("topic"), "key", "value")


def q_log_counts(spark, root):
    """Logs of each topic and hour, over both topics."""
    t = _ctx(spark, root).t
    logs = AD.startup_logs(t).select(F.lit(AD.TOPIC_STARTUP).alias("topic"), "ts").unionByName(
        AD.event_logs(t).select(F.lit(AD.TOPIC_EVENT).alias("topic"), "ts"))
    hour = F.concat_ws(" ", log_date("ts"), log_hour("ts")).alias("hour")
    return logs.groupBy("topic", hour).agg(F.count(F.lit(1)).alias("logs"))


def q_value_time_prefix(spark, root):
    return FE.prefix_time(AD.topic_records(_ctx(spark, root).t))


def q_topic_offset_range(spark, root):
    return FE.offset_range(AD.topic_records(_ctx(spark, root).t), P.OFFSET_TOPIC,
                           P.OFFSET_PARTITION, P.OFFSET_START, P.OFFSET_MAX_BYTES)


#: Offset logs kept by this session, by the state of the table that they were made from.
_LOGS: dict[tuple, OffsetLog] = {}


def kept_log(spark: SparkSession, root: str) -> OffsetLog:
    """The raw topic of a data folder, kept in the shared folder: written in two
    batches, by offset, when it is first asked for, and again when ``events`` changes."""
    c = _ctx(spark, root)
    key = (spark.sparkContext.applicationId, stamp(spark, c.t.path("events")))
    if key not in _LOGS:
        log = OffsetLog(spark, run_dir(spark, "offset-log"))
        records = AD.topic_records(c.t)
        earlier = F.coalesce(F.col("offset") % 2 == 0, F.lit(True))   # neighbours in offset lie in both batches
        log.append(records.where(earlier), 0)
        log.append(records.where(~earlier), 1)
        log.compact()
        _LOGS[key] = log
    return _LOGS[key]


def q_topic_offset_kept(spark, root):
    return kept_log(spark, root).fetch(P.OFFSET_TOPIC, P.OFFSET_PARTITION, P.OFFSET_START, P.OFFSET_MAX_BYTES)


def q_delivery_counts(spark, root):
    return FE.delivery_counts(AD.delivery_results(_ctx(spark, root).t))


# --------------------------------------------------------------------- cells

def q_kv_cells(spark, root):
    return CE.to_cells(AD.cell_rows(_ctx(spark, root).t))


def q_kv_cells_sorted(spark, root):
    """Writes the sorted cell files into the shared folder, returns them read back."""
    path = run_dir(spark, "cells") + "/sorted"
    CE.write_sorted_cells(CE.to_cells(AD.cell_rows(_ctx(spark, root).t)), path)
    return spark.read.parquet(path)


def q_kv_cells_json(spark, root):
    """Two loads of JSON files, whose fields differ, into a cell table: the first
    is compacted, the second adds versions; returns the newest of each cell."""
    base = run_dir(spark, "cells-json")
    table, known = CellTable(spark, f"{base}/table", buckets=P.CELL_BUCKETS), None
    for n, lines in enumerate(AD.cell_json(_ctx(spark, root).t)):
        lines.write.text(f"{base}/in/{n}")
        known = table.load_json(f"{base}/in/{n}", n, known=known)
        if n == 0:
            table.compact()
    return table.scan().select(*CE.CELL_COLUMNS)


USER_KEYED_SCHEMA = T.StructType(list(USER_INFO.fields) + [
    T.StructField("change_ts", T.TimestampNTZType()), T.StructField("seq", T.LongType())])


def q_keyed_upsert(spark, root):
    """User changes written to a keyed table: inserts (batch 0), updates
    (batch 1), a compaction, a replay of batch 0 and the updates re-sent as
    batch 2; the reader returns the latest image per id."""
    c = _ctx(spark, root)
    changes = AD.user_changes(c.t)
    kt = KeyedTable(spark, run_dir(spark, "keyed-users"), USER_KEYED_SCHEMA, ["id"],
                    ["change_ts", "seq"])
    inserts = changes.where(F.col("event_type") == "INSERT")
    updates = changes.where(F.col("event_type") == "UPDATE")
    kt.upsert(inserts, 0)
    kt.upsert(updates, 1)
    kt.compact()
    kt.upsert(inserts, 0)    # replay of a batch already in the base: ignored
    kt.upsert(updates, 2)    # re-sent updates: same images
    return kt.read().select("id", "login_name", "user_level", "birthday", "gender")


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dau_first_log": q_dau_first_log,
    "dau_incremental": q_dau_incremental,
    "dau_total": q_dau_total,
    "dau_by_hour": q_dau_by_hour,
    "dau_hours_compare": q_dau_hours_compare,
    "new_devices": q_new_devices,
    "pipeline_counts": q_pipeline_counts,
    "order_info_clean": q_order_info_clean,
    "order_amount_total": q_order_amount_total,
    "order_amount_by_hour": q_order_amount_by_hour,
    "order_hours_compare": q_order_hours_compare,
    "realtime_total": q_realtime_total,
    "kept_realtime_total": q_kept_realtime_total,
    "kept_new_devices": q_kept_new_devices,
    "kept_dau_hours": q_kept_dau_hours,
    "kept_order_hours": q_kept_order_hours,
    "province_amount": q_province_amount,
    "province_bands": q_province_bands,
    "order_detail_outer": q_order_detail_outer,
    "sale_detail": q_sale_detail,
    "sale_detail_interval": q_sale_detail_interval,
    "latest_user": q_latest_user,
    "sale_detail_users": q_sale_detail_users,
    "sale_search_total": q_sale_search_total,
    "sale_search_page": q_sale_search_page,
    "sale_search_ranked": q_sale_search_ranked,
    "sale_gender_terms": q_sale_gender_terms,
    "sale_age_terms": q_sale_age_terms,
    "sale_stat_gender": q_sale_stat_gender,
    "sale_stat_age": q_sale_stat_age,
    "sale_index_total": q_sale_index_total,
    "sale_index_page": q_sale_index_page,
    "sale_index_ranked": q_sale_index_ranked,
    "sale_index_stat_age": q_sale_index_stat_age,
    "coupon_alert": q_coupon_alert,
    "coupon_alert_keyed": q_coupon_alert_keyed,
    "cdc_route": q_cdc_route,
    "log_route": q_log_route,
    "topic_strip": q_topic_strip,
    "topic_transfer": q_topic_transfer,
    "log_counts": q_log_counts,
    "value_time_prefix": q_value_time_prefix,
    "topic_offset_range": q_topic_offset_range,
    "topic_offset_kept": q_topic_offset_kept,
    "delivery_counts": q_delivery_counts,
    "kv_cells": q_kv_cells,
    "kv_cells_sorted": q_kv_cells_sorted,
    "kv_cells_json": q_kv_cells_json,
    "keyed_upsert": q_keyed_upsert,
}
