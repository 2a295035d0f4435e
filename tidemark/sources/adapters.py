"""Shop feeds derived from the driver tables (rules in FIXTURES.md section 3).

The shop's own inputs are topic records and change-log rows. These adapters
derive the same record shapes from the TPC-H-like tables so every query's
work grows with the tables. Each function is a lazy DataFrame plan; the
joins are plain equi-joins left to the optimizer (and AQE) to pick a
strategy for, because no side here has a size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import (APP_ID, MARKER, TOPIC_EVENT, TOPIC_ORDER_DETAIL,  # noqa: F401
                            TOPIC_ORDER_INFO, TOPIC_RAW, TOPIC_STARTUP, TOPIC_USER_INFO)
from tidemark.functions.timefmt import ntz_to_epoch_ms, ntz_to_instant
from tidemark.sources.tables import Tables

# Derivation rules of the test feeds (see README "Feed rules").
EVID_OF_EVENT_TYPE = {"purchase": "coupon", "click": "clickItem", "view": "addCart",
                      "error": "addComment", "signup": "addFavor"}
DETAIL_SKEW_SECONDS = 600       # detail arrival = order arrival + [-600, 600] s
UPDATED_SEGMENT = "AUTOMOBILE"  # customers of this segment change their level once
DELETED_STATUS = "P"            # pending orders are later deleted
TXN_PRIORITY = "1-URGENT"       # urgent orders are written in an explicit transaction
PAID_STATUS = "F"               # finished orders also write a payment_info row
USER_EPOCH = "2023-06-01 00:00:00"
BIRTH_EPOCH = "1940-01-01"


def _s(c):
    return F.col(c).cast("string")


def _ntz(day, shift_days: int = 0):
    """NTZ literal at midnight of ``day`` ('yyyy-MM-dd') shifted by whole days."""
    import datetime as _dt
    d = _dt.date.fromisoformat(day) + _dt.timedelta(days=shift_days)
    return F.expr(f"TIMESTAMP_NTZ'{d.isoformat()} 00:00:00'")


def day_range(col: str, days, before: int = 0, after: int = 1):
    """Scan predicate ``col`` in [min(days) - before, max(days) + after) days,
    as literals so the parquet reader can skip row groups and files."""
    if not days:
        return None
    return (F.col(col) >= _ntz(min(days), -before)) & (F.col(col) < _ntz(max(days), after))


def _money_text(c):
    return F.col(c).cast("decimal(18,2)").cast("string")


def _device_cols(user_id="user_id", event_id="event_id"):
    u, e = F.col(user_id), F.col(event_id)
    os_ = F.when(u % 10 < 3, F.lit("ios")).otherwise(F.lit("andriod"))
    return {
        "appid": F.lit(APP_ID),
        "area": F.concat(F.lit("area_"), (u % 10).cast("string")),
        "os": os_,
        "ch": F.when(u % 10 < 3, F.lit("appstore")).otherwise(
            F.concat(F.lit("ch_"), (e % 7).cast("string"))),
        "vs": F.concat(F.lit("1.1."), (e % 4).cast("string")),
    }


# --------------------------------------------------------------------------- logs

def startup_logs(t: Tables, days=None) -> DataFrame:
    """Startup log records: mid = user, ts = epoch ms of the event time.

    ``days``: only logs whose (UTC) log date is within the days' range.
    """
    d = _device_cols()
    ev = t.events
    if days:
        ev = ev.where(day_range("ts", days))
    return ev.select(
        _s("user_id").alias("mid"), _s("user_id").alias("uid"), d["appid"].alias("appid"),
        d["area"].alias("area"), d["os"].alias("os"), d["ch"].alias("ch"),
        F.lit("startup").alias("type"), d["vs"].alias("vs"),
        ntz_to_epoch_ms("ts").alias("ts"))


def event_logs(t: Tables) -> DataFrame:
    """Event log records: mid = props.k, uid = user, evid by event type."""
    d = _device_cols()
    evid = F.create_map(*[F.lit(x) for kv in EVID_OF_EVENT_TYPE.items() for x in kv])[
        F.col("event_type")]
    return t.events.select(
        F.get_json_object("props", "$.k").alias("mid"), _s("user_id").alias("uid"),
        d["appid"].alias("appid"), d["area"].alias("area"), d["os"].alias("os"),
        F.lit("event").alias("type"), evid.alias("evid"),
        (F.col("event_id") % 50 + 1).cast("string").alias("pgid"),
        (F.col("user_id") % 50 + 1).cast("string").alias("npgid"),
        (F.col("event_id") % 50).cast("string").alias("itemid"),
        ntz_to_epoch_ms("ts").alias("ts"))


def log_topic(logs: DataFrame, topic: str, partitions: int = 4) -> DataFrame:
    """Wrap log records as topic records (value = JSON line)."""
    cols = [c for c in logs.columns]
    return logs.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("mid"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("ts").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(*cols)).alias("value"),
        F.timestamp_millis("ts").alias("timestamp"))


def raw_logs(t: Tables) -> DataFrame:
    """Client log lines before intake: type startup / event / missing, client ts.

    Intake time (``arrival``) is the event time; the client clock is behind it
    by ``event_id % 1000`` ms and gets overwritten at intake.
    """
    et = F.col("event_type")
    typ = (F.when(et == "signup", F.lit("startup"))
           .when(et == "error", F.lit(None).cast("string"))
           .otherwise(F.lit("event")))
    evid = F.when(et == "signup", F.lit(None).cast("string")).otherwise(
        F.create_map(*[F.lit(x) for kv in EVID_OF_EVENT_TYPE.items() for x in kv])[et])
    arrival = ntz_to_epoch_ms("ts")
    body = F.struct(typ.alias("type"), _s("user_id").alias("mid"), _s("event_id").alias("uid"),
                    evid.alias("evid"), (arrival - F.col("event_id") % 1000).alias("ts"))
    return t.events.select(F.to_json(body).alias("value"), arrival.alias("arrival_ms"))


# ------------------------------------------------------------------------ orders

def _create_ts(orderkey="o_orderkey", orderdate="o_orderdate"):
    k = F.col(orderkey)
    secs = (k % 24) * 3600 + (k * 7) % 3600
    return F.timestamp_add("SECOND", secs, F.col(orderdate))


def _orders(t: Tables, days=None) -> DataFrame:
    """The orders table, restricted to orders whose create date can be in
    ``days``: create_time lies in [o_orderdate, o_orderdate + 1 day), so a
    create date d implies o_orderdate in (d - 1 day, d + 1 day)."""
    o = t.orders
    if days:
        o = o.where((F.col("o_orderdate") > _ntz(min(days), -1)) &
                    (F.col("o_orderdate") < _ntz(max(days), 1)))
    return o


def order_infos(t: Tables, days=None, customer: bool = True) -> DataFrame:
    """Order rows as the change feed sends them, plus ``arrival`` (NTZ) and
    ``order_key``, the id as a number.

    province_id comes from the customer's nation (orders -> customer join); with
    ``customer=False``, for callers that use neither it nor the consignee, both
    are null and there is no join. ``days`` narrows the scan to orders that can fall on those create dates
    (callers still filter on create_date exactly).
    """
    o = _orders(t, days).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                "o_orderdate", "o_orderpriority")
    if customer:
        c = t.customer.select(F.col("c_custkey"), F.col("c_nationkey"), F.col("c_name"))
        j = o.join(c, o.o_custkey == c.c_custkey, "left")
    else:
        j = o.select("*", F.lit(None).cast("int").alias("c_nationkey"), F.lit(None).cast("string").alias("c_name"))
    ts = _create_ts()
    nul = F.lit(None).cast("string")
    return j.select(
        _s("o_orderkey").alias("id"), _s("c_nationkey").alias("province_id"),
        F.col("c_name").alias("consignee"), F.col("o_orderpriority").alias("order_comment"),
        F.concat(F.lit("138"), F.lpad(_s("o_custkey"), 8, "0")).alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        ((F.col("o_orderkey") % 3) + 1).cast("string").alias("payment_way"),
        _s("o_custkey").alias("user_id"), nul.alias("img_url"),
        F.col("o_totalprice").alias("total_amount"), nul.alias("expire_time"),
        nul.alias("delivery_address"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        nul.alias("operate_time"), nul.alias("tracking_no"), nul.alias("parent_order_id"),
        nul.alias("out_trade_no"), nul.alias("trade_body"),
        ts.alias("arrival"), F.col("o_orderkey").alias("order_key"))


def order_details(t: Tables, days=None, arrival: bool = True) -> DataFrame:
    """Order detail rows (lineitem + part name) plus ``arrival`` (NTZ) and
    ``order_key``, the order's id as a number.

    The detail's arrival is its order's arrival shifted by
    ``(l_partkey * 7) % 1201 - 600`` seconds, so some pairs fall outside a
    300 s join memory. The five-part id is unique at every scale.
    With ``days``, only details of orders that can fall on those create dates.
    With ``arrival=False``, for callers that pair details with orders whenever they
    came, there is no join with orders, no arrival, and ``days`` does not count.
    The join with orders comes last, so a further one on ``order_key`` finds the
    rows in place.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_extendedprice")
    p = t.part.select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    if arrival:
        o = _orders(t, days).select("o_orderkey", "o_orderdate")
        j = j.join(o, li.l_orderkey == o.o_orderkey, "inner" if days else "left")
        shift = (F.col("l_partkey") * 7) % (2 * DETAIL_SKEW_SECONDS + 1) - DETAIL_SKEW_SECONDS
        at = F.timestamp_add("SECOND", shift, _create_ts("l_orderkey", "o_orderdate"))
    else:
        at = F.lit(None).cast("timestamp_ntz")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return j.select(
        F.concat_ws("_", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                    _s("l_suppkey"), cents.cast("string")).alias("id"),
        _s("l_orderkey").alias("order_id"), F.col("p_name").alias("sku_name"),
        _s("l_partkey").alias("sku_id"), _money_text("l_extendedprice").alias("order_price"),
        F.lit(None).cast("string").alias("img_url"),
        F.col("l_quantity").cast("bigint").cast("string").alias("sku_num"),
        at.alias("arrival"), F.col("l_orderkey").alias("order_key"))


# ------------------------------------------------------------------------- users

def user_changes(t: Tables) -> DataFrame:
    """User change rows: an INSERT for every customer with an account (a
    customer with a negative balance never opened one, so their sales have
    no user), and one UPDATE of the level for the AUTOMOBILE segment.

    Columns: id, login_name, user_level, birthday, gender, event_type,
    change_ts (NTZ), seq.
    """
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment").where(
        F.col("c_acctbal") >= 0)
    k = F.col("c_custkey")
    base_ts = F.timestamp_add("SECOND", k, F.to_timestamp_ntz(F.lit(USER_EPOCH)))
    birthday = F.date_format(F.date_add(F.to_date(F.lit(BIRTH_EPOCH)), ((k * 37) % 27000).cast("int")),
                             "yyyy-MM-dd")
    common = [_s("c_custkey").alias("id"), F.col("c_name").alias("login_name")]
    tail = [birthday.alias("birthday"),
            F.when(k % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender")]
    ins = c.select(*common, F.col("c_mktsegment").alias("user_level"), *tail,
                   F.lit("INSERT").alias("event_type"), base_ts.alias("change_ts"),
                   (k * 2).alias("seq"))
    upd = c.where(F.col("c_mktsegment") == UPDATED_SEGMENT).select(
        *common, F.concat(F.col("c_mktsegment"), F.lit("+")).alias("user_level"), *tail,
        F.lit("UPDATE").alias("event_type"),
        F.timestamp_add("DAY", F.lit(1), base_ts).alias("change_ts"), (k * 2 + 1).alias("seq"))
    return ins.unionByName(upd)


# --------------------------------------------------------------------------- CDC

def _kv_map(*names):
    args = []
    for n in names:
        args += [F.lit(n), F.col(n).cast("string")]
    return F.create_map(*args)


def cdc_changes(t: Tables, timed: bool = True) -> DataFrame:
    """Change-log rows: table, entry_type, event_type, after map, change_ts, seq.
    With ``timed=False``, for callers that don't use it, details have no change_ts."""
    o = order_infos(t)
    order_after = F.create_map(
        F.lit("id"), F.col("id"), F.lit("province_id"), F.col("province_id"),
        F.lit("consignee"), F.col("consignee"), F.lit("order_comment"), F.col("order_comment"),
        F.lit("consignee_tel"), F.col("consignee_tel"), F.lit("order_status"), F.col("order_status"),
        F.lit("payment_way"), F.col("payment_way"), F.lit("user_id"), F.col("user_id"),
        F.lit("total_amount"), F.col("total_amount").cast("decimal(18,2)").cast("string"),
        F.lit("create_time"), F.col("create_time"))
    key = F.col("id").cast("bigint")
    nul_map = F.lit(None).cast("map<string,string>")

    def change(table, entry, event, after, at, n):
        return F.struct(F.lit(table).alias("table"), F.lit(entry).alias("entry_type"), F.lit(event).cast("string").alias("event_type"),
                        after.alias("after"), at.alias("change_ts"), (key * 8 + n).alias("seq"))

    at = F.col("arrival")
    urgent = F.col("order_comment") == TXN_PRIORITY
    # all changes of an order from its one row: orders meet the customers once
    orders = o.select(F.inline(F.array_compact(F.array(
        change("order_info", "ROWDATA", "INSERT", order_after, at, 0),
        F.when(F.col("order_status") == DELETED_STATUS, change(
            "order_info", "ROWDATA", "DELETE", F.create_map(F.lit("id"), F.col("id")), F.timestamp_add("DAY", F.lit(1), at), 1)),
        F.when(urgent, change("order_info", "TRANSACTIONBEGIN", None, nul_map, at, 2)),
        F.when(urgent, change("order_info", "TRANSACTIONEND", None, nul_map, at, 3)),
        F.when(F.col("order_status") == PAID_STATUS, change(
            "payment_info", "ROWDATA", "INSERT", F.create_map(F.lit("order_id"), F.col("id")), at, 4))))))
    d = order_details(t, arrival=timed)
    details = d.select(F.lit("order_detail").alias("table"), F.lit("ROWDATA").alias("entry_type"),
                       F.lit("INSERT").alias("event_type"),
                       _kv_map("id", "order_id", "sku_name", "sku_id", "order_price", "sku_num").alias("after"),
                       F.col("arrival").alias("change_ts"),
                       (F.col("order_id").cast("bigint") * 8 + 5).alias("seq"))
    u = user_changes(t)
    users = u.select(F.lit("user_info").alias("table"), F.lit("ROWDATA").alias("entry_type"),
                     F.col("event_type"),
                     _kv_map("id", "login_name", "user_level", "birthday", "gender").alias("after"),
                     F.col("change_ts"), F.col("seq"))
    return orders.unionByName(details).unionByName(users)


# ------------------------------------------------------------------ raw topic

def topic_records(t: Tables, topic: str = TOPIC_RAW, partitions: int = 4,
                  marker: str = MARKER) -> DataFrame:
    """Records of a raw topic: partition = user % 4, offset = event id
    (increasing inside a partition, with gaps as compacted topics have),
    marker-prefixed value for even event ids."""
    value = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(marker), F.col("props"))).otherwise(
        F.col("props"))
    return t.events.select(
        F.lit(topic).alias("topic"), (F.col("user_id") % partitions).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), _s("event_id").alias("key"), value.alias("value"),
        ntz_to_instant("ts").alias("timestamp"))


def delivery_results(t: Tables) -> DataFrame:
    """Send results of a producer: a send of an ``error`` event failed."""
    return t.events.select(F.lit(TOPIC_RAW).alias("topic"), F.col("event_id"),
                           (F.col("event_type") != "error").alias("acked"))


def cell_rows(t: Tables) -> DataFrame:
    """Flat rows with an ``id`` key for the cell loaders (customers)."""
    return t.customer.withColumnRenamed("c_custkey", "id")


def cell_json(t: Tables) -> tuple[DataFrame, DataFrame]:
    """JSON lines of two loads of the cell loaders: every customer; and the
    ``UPDATED_SEGMENT`` ones again, with a new segment, a field more and fields less."""
    first = F.to_json(F.struct(F.col("c_custkey").alias("id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    again = F.to_json(F.struct(F.concat("c_mktsegment", F.lit("+")).alias("c_mktsegment"), F.col("c_custkey").alias("id"),
                               (F.col("c_custkey") % 9).alias("c_level")))
    return (t.customer.select(first.alias("value")),
            t.customer.where(F.col("c_mktsegment") == UPDATED_SEGMENT).select(again.alias("value")))
