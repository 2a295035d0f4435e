"""Dashboard metrics: daily totals, hourly series, today-vs-yesterday, province map.

Every metric is a filtered partial aggregate; results are at most 24 rows
(hours) or one row per province, so the only joins are against those
bounded frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed import TOTAL_ROWS
from tidemark.functions.stats import band
from tidemark.functions.timefmt import previous_day_str

HOURS = 24


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """count(*) of first-log rows on ``date``: one row ``dau``."""
    return dau.where(F.col("logdate") == date).agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame, date: str) -> DataFrame:
    """(loghour, ct) for hours with at least one first log on ``date``."""
    return (dau.where(F.col("logdate") == date).groupBy("loghour")
            .agg(F.count(F.lit(1)).alias("ct")))


def order_amount_total(orders: DataFrame, date: str) -> DataFrame:
    """Sum of total_amount on create_date (null when no order), 2 decimals."""
    return orders.where(F.col("create_date") == date).agg(
        F.round(F.sum("total_amount"), 2).alias("sum_amount"))


def order_amount_by_hour(orders: DataFrame, date: str) -> DataFrame:
    """(create_hour, sum_amount) on ``date``."""
    return (orders.where(F.col("create_date") == date).groupBy("create_hour")
            .agg(F.round(F.sum("total_amount").cast("double"), 2).alias("sum_amount")))


def hour_spine(spark: SparkSession) -> DataFrame:
    """The 24 hours '00'..'23' (fixed size)."""
    return spark.range(HOURS).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def hours_compare(df: DataFrame, date: str, date_col: str, hour_col: str,
                  value=None, zero=0) -> DataFrame:
    """(hour, today, yesterday) for all 24 hours; missing hours are ``zero``.

    One pass over the two dates: conditional aggregates grouped by hour, then
    a left join of the 24-row spine with the (at most 24-row) result.
    """
    prev = previous_day_str(date)
    d = F.col(date_col)
    hours = [f"{h:02d}" for h in range(HOURS)]
    # only the 24 spine hours are kept, so the aggregate below has at most 24
    # rows whatever the data holds: that bound is what makes the broadcast safe
    part = df.where(d.isin(date, prev) & F.col(hour_col).isin(hours))
    if value is None:
        today = F.count_if(d == date)
        yday = F.count_if(d == prev)
    else:
        v = F.col(value)
        today = F.round(F.sum(F.when(d == date, v)), 2)
        yday = F.round(F.sum(F.when(d == prev, v)), 2)
    agg = part.groupBy(F.col(hour_col).alias("hour")).agg(today.alias("today"),
                                                          yday.alias("yesterday"))
    spine = hour_spine(df.sparkSession)
    out = spine.join(F.broadcast(agg), "hour", "left")
    return out.select("hour", F.coalesce("today", F.lit(zero)).alias("today"),
                      F.coalesce("yesterday", F.lit(zero)).alias("yesterday"))


def hours_for(metric: str, dau: DataFrame, orders: DataFrame, date: str):
    """Dispatch by metric id: 'dau' or 'order_amount'; anything else -> None."""
    if metric == "dau":
        return hours_compare(dau, date, "logdate", "loghour")
    if metric == "order_amount":
        return hours_compare(orders, date, "create_date", "create_hour", "total_amount", 0.0)
    return None


def realtime_total(dau: DataFrame, new_devices: DataFrame, orders: DataFrame, date: str,
                   order_date: str | None = None) -> DataFrame:
    """Headline list (id, name, value): daily active devices, new devices and
    order amount. ``order_date`` defaults to ``date``."""
    od = order_date or date
    a = dau.where(F.col("logdate") == date).agg(F.count(F.lit(1)).cast("double").alias("value"))
    b = new_devices.where(F.col("logdate") == date).agg(
        F.coalesce(F.sum("new_devices"), F.lit(0)).cast("double").alias("value"))
    c = orders.where(F.col("create_date") == od).agg(
        F.round(F.sum("total_amount"), 2).alias("value"))
    rows = []
    for (i, name), frame in zip(TOTAL_ROWS, (a, b, c)):
        rows.append(frame.select(F.lit(i).alias("id"), F.lit(name).alias("name"), "value"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def province_amount(orders: DataFrame, nations: DataFrame, date: str | None = None) -> DataFrame:
    """(province_id, province_name, amount, order_count) per province."""
    o = orders if date is None else orders.where(F.col("create_date") == date)
    agg = o.groupBy("province_id").agg(F.round(F.sum("total_amount"), 2).alias("amount"),
                                       F.count(F.lit(1)).alias("order_count"))
    names = nations.select(F.col("n_nationkey").cast("string").alias("province_id"),
                           F.col("n_name").alias("province_name"))
    return agg.join(names, "province_id", "left").select(
        "province_id", "province_name", "amount", "order_count")


def province_bands(by_province: DataFrame, value: str = "order_count",
                   width: float = 100) -> DataFrame:
    """Colour bands ``[k*width, (k+1)*width)`` of a per-province value with the
    number of provinces in each."""
    b = F.col("band")
    lo = (b * F.lit(width)).cast("long").cast("string")
    hi = ((b + 1) * F.lit(width)).cast("long").cast("string")
    return by_province.groupBy(band(value, width).alias("band")).agg(
        F.count(F.lit(1)).alias("provinces")).select(
        "band", F.concat(lo, F.lit("-"), hi).alias("band_label"), "provinces")
