"""Order + detail + user wide rows.

Orders and users are unique per key; details are many per order and an order
(or a user) may be hot. The joins are therefore written so the many side is
the streamed side of an equi-join, which AQE's skew handling can split:
the full outer join is decomposed into ``details LEFT JOIN orders`` plus the
orders with no detail (an anti join against de-duplicated detail keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stats import age_365
from tidemark.schemas import SALE_DETAIL_COLUMNS


def _batch(arrival: str, seconds: int):
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return F.floor(F.timestamp_diff("SECOND", epoch, F.col(arrival)) / seconds).cast("long")


def _same_order(orders: DataFrame, details: DataFrame, oid: str, did: str, o: str, d: str):
    if "order_key" in orders.columns and "order_key" in details.columns:
        return F.col(f"{o}.order_key") == F.col(f"{d}.order_key")
    return F.col(oid) == F.col(did)


def order_detail_outer(orders: DataFrame, details: DataFrame, batch_seconds: int = 3600) -> DataFrame:
    """Full outer join of orders and details arriving in the same micro-batch.

    Output: batch_id, order_id, order_detail_id (null for an order alone),
    order_status (null for a detail alone), sku_id.
    """
    o = orders.select(F.col("id").alias("o_id"), "order_status",
                      _batch("arrival", batch_seconds).alias("batch_id"))
    d = details.select(F.col("id").alias("order_detail_id"), F.col("order_id"), "sku_id",
                       _batch("arrival", batch_seconds).alias("batch_id"))
    with_order = d.join(o, (d.order_id == o.o_id) & (d.batch_id == o.batch_id), "left").select(
        d.batch_id, d.order_id, "order_detail_id", "order_status", "sku_id")
    detail_keys = d.select(F.col("order_id").alias("o_id"), "batch_id").distinct()
    alone = o.join(detail_keys, ["o_id", "batch_id"], "left_anti").select(
        "batch_id", F.col("o_id").alias("order_id"),
        F.lit(None).cast("string").alias("order_detail_id"), "order_status",
        F.lit(None).cast("string").alias("sku_id"))
    return with_order.unionByName(alone)


def salt_pair(orders: DataFrame, details: DataFrame, salt: int):
    """Split hot orders over ``salt`` tasks: every order row is repeated for
    salt values 0..salt-1, every detail takes ``xxhash64(id) mod salt``; the
    join then also matches on ``_salt``. Costs ``salt`` times the order
    side; used where AQE's skew splitting is not available (streams)."""
    if salt <= 1:
        return orders, details
    o = orders.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    d = details.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salt)).cast("int"))
    return o, d


def sale_detail(orders: DataFrame, details: DataFrame,
                within_seconds: int | None = None) -> DataFrame:
    """Pair every detail with its order; with ``within_seconds``, only pairs
    whose arrivals differ by at most that many seconds (the join memory).
    Order fields: order_id, order_status, create_time, user_id, dt; detail
    fields: order_detail_id, sku_id, sku_name, sku_price (sku_num is not carried).

    ``orders`` must carry create_date (see ``clean_orders``). Where both sides carry
    ``order_key``, the order's id as a number, the join is on that, so details that
    are dealt by it already stay where they are.
    """
    o = orders.alias("o")
    d = details.alias("d")
    cond = _same_order(orders, details, "o.id", "d.order_id", "o", "d")
    if "_salt" in orders.columns and "_salt" in details.columns:
        cond = cond & (F.col("o._salt") == F.col("d._salt"))
    if within_seconds is not None:
        # ``ts +/- INTERVAL`` form: on streams the join reads its state
        # eviction bounds from it.
        gap = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
        cond = cond & (F.col("d.arrival") >= F.col("o.arrival") - gap) & (
            F.col("d.arrival") <= F.col("o.arrival") + gap)
    return o.join(d, cond, "inner").select(
        F.col("d.id").alias("order_detail_id"), F.col("o.id").alias("order_id"),
        F.col("o.order_status").alias("order_status"), F.col("o.create_time").alias("create_time"),
        F.col("o.user_id").alias("user_id"), F.col("d.sku_id").alias("sku_id"),
        F.col("d.order_price").try_cast("double").alias("sku_price"),
        F.col("d.sku_name").alias("sku_name"), F.col("o.create_date").alias("dt"))


def latest_users(changes: DataFrame) -> DataFrame:
    """Latest image per user id: last (change_ts, seq) wins; INSERT/UPDATE only.

    A ``max`` of a struct led by the ordering columns: partial aggregation
    before the shuffle, no window over a possibly hot id.
    """
    c = changes.where(F.col("event_type").isin("INSERT", "UPDATE"))
    m = F.max(F.struct("change_ts", "seq", "login_name", "user_level", "birthday", "gender"))
    return c.groupBy("id").agg(m.alias("_m")).select(
        "id", "_m.login_name", "_m.user_level", "_m.birthday", "_m.gender")


def with_users(sales: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Merge the latest user into each sale row; rows without a user drop out."""
    u = users.select(F.col("id").alias("user_id"), F.col("gender").alias("user_gender"),
                     age_365("birthday", as_of).alias("user_age"), "user_level")
    return sales.join(u, "user_id", "inner").select(*SALE_DETAIL_COLUMNS)


def with_users_split(sales: DataFrame, users: DataFrame, as_of: str):
    """One left join, split into (merged rows, rows without a user).

    Callers cache the joined frame when they use both halves (a micro-batch
    writing its rejects next to its output)."""
    u = users.select(F.col("id").alias("user_id"), F.col("gender").alias("user_gender"),
                     age_365("birthday", as_of).alias("user_age"), "user_level",
                     F.lit(True).alias("_has_user"))
    joined = sales.join(u, "user_id", "left")
    return joined, F.col("_has_user").isNotNull()
