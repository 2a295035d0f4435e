"""Dashboard-level calls (Q1-Q4): headline list, hourly comparison, sale search.

Each call takes the keyed tables (or any frames of the same shape) and
returns DataFrames; the dashboard's defaults are keyword arguments. Results
are lazy; ``to_json`` at the edge gives the reference's result shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import DEFAULT_DATE, DEFAULT_KEYWORD
from tidemark.operators import dedup as DD
from tidemark.operators import metrics as ME
from tidemark.operators import search as SE

DEFAULT_PAGE = 1
DEFAULT_SIZE = 20


def realtime_total(dau: DataFrame, orders: DataFrame, date: str = DEFAULT_DATE,
                   order_date: str | None = None) -> DataFrame:
    """(id, name, value): daily active devices, new devices, order amount."""
    return ME.realtime_total(dau, DD.new_devices_by_date(dau), orders, date, order_date)


def realtime_hours(metric: str, dau: DataFrame, orders: DataFrame,
                   date: str = DEFAULT_DATE) -> DataFrame | None:
    """(hour, today, yesterday) for 'dau' or 'order_amount'; None otherwise."""
    return ME.hours_for(metric, dau, orders, date)


def sale_detail(index: DataFrame, date: str = DEFAULT_DATE, startpage: int = DEFAULT_PAGE,
                size: int = DEFAULT_SIZE, keyword: str | None = DEFAULT_KEYWORD) -> dict:
    """{'detail', 'total', 'gender', 'age'} frames of one search. An empty
    keyword matches nothing; ``keyword=None`` drops the keyword clause."""
    return SE.sale_search(index, date, keyword, startpage, size)


def hours_as_json(hours: DataFrame) -> DataFrame:
    """One row {"today": {"00": v, ...}, "yesterday": {...}} (24 entries each)."""
    return hours.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("hour", "today")))).alias("today"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("hour", "yesterday")))).alias(
            "yesterday"),
    ).select(F.to_json(F.struct("yesterday", "today")).alias("json"))


def stats_as_json(share: DataFrame) -> DataFrame:
    """One row {"title": ..., "options": [{"name", "value"}, ...]} per share frame."""
    return share.groupBy("title").agg(
        F.collect_list(F.struct("name", "value")).alias("options")).select(
        F.to_json(F.struct("title", "options")).alias("json"))


def search_index(index, date: str = DEFAULT_DATE, startpage: int = DEFAULT_PAGE,
                 size: int = DEFAULT_SIZE, keyword: str | None = DEFAULT_KEYWORD) -> dict:
    """The same four results read from a materialized sale index (a
    ``KeyedTable`` keyed by order_detail_id, partitioned by ``dt``): hits come
    from the date's partition only, scoring statistics from the whole index."""
    day = index.read(F.col("dt") == date)
    hits = SE.search(day, date, keyword)
    return {"detail": SE.page(day, date, keyword, startpage, size, corpus=index.read()),
            "total": SE.total(hits), "gender": SE.gender_share(hits), "age": SE.age_share(hits)}


def search_kept(index, date: str = DEFAULT_DATE, startpage: int = DEFAULT_PAGE,
                size: int = DEFAULT_SIZE, keyword: str | None = DEFAULT_KEYWORD) -> dict:
    """The same four results from a ``SearchIndex``: hits by postings of the date
    and the terms, scores by the kept statistics, no job while planning."""
    hits = index.hits(date, keyword)
    return {"detail": index.page(date, keyword, startpage, size), "total": index.total(date, keyword),
            "gender": SE.gender_share(hits), "age": SE.age_share(hits)}
