"""Order cleaning: phone mask, create date and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import mask_phone
from tidemark.functions.timefmt import datetime_date, datetime_hour
from tidemark.schemas import ORDER_INFO, ORDER_SINK_COLUMNS


def clean_orders(orders: DataFrame) -> DataFrame:
    """Mask the phone number and derive create_date / create_hour."""
    return (orders.withColumn("consignee_tel", mask_phone("consignee_tel"))
            .withColumn("create_date", datetime_date("create_time"))
            .withColumn("create_hour", datetime_hour("create_time")))


def to_order_sink(clean: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 20 upper-case columns of the order table, and those of ``keep``."""
    src = [f.name for f in ORDER_INFO.fields] + ["create_date", "create_hour"]
    return clean.select(*[F.col(s).alias(d) for s, d in zip(src, ORDER_SINK_COLUMNS)], *keep)
