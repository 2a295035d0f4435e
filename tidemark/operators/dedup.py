"""Daily active devices: first log per device and day, seen-set filtering.

The first-log pick is an aggregation (``min`` of a struct led by ``ts``), not
a window: the partial aggregate runs before the shuffle, so a device holding
a large share of the logs is reduced map-side instead of landing whole in one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefmt import log_date, log_hour
from tidemark.schemas import DAU_SINK_COLUMNS


def with_log_date_hour(logs: DataFrame, zone: str = "UTC", ts: str = "ts") -> DataFrame:
    """Add ``logDate`` ('yyyy-MM-dd') and ``logHour`` ('HH') from epoch-ms ``ts``."""
    return logs.withColumn("logdate", log_date(ts, zone)).withColumn("loghour", log_hour(ts, zone))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order``, ties broken by the
    remaining columns (deterministic, unlike an arbitrary take-one)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_m")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest]).select(*df.columns)


def first_logs(logs: DataFrame) -> DataFrame:
    """First startup log per (logdate, mid): earliest ts, then other columns."""
    return first_per_key(logs, ["logdate", "mid"], ["ts"])


def not_seen(batch: DataFrame, seen: DataFrame, keys=("logdate", "mid")) -> DataFrame:
    """Rows of ``batch`` whose keys are not in ``seen`` (left anti join).

    ``seen`` grows with the day, so no broadcast is forced: the optimizer
    broadcasts it only under the size threshold (and AQE re-checks at run
    time); otherwise both sides shuffle on the keys.
    """
    return batch.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def incremental_first_logs(batch: DataFrame, seen: DataFrame) -> DataFrame:
    """A new batch's first logs, minus devices already counted that day."""
    return first_logs(not_seen(batch, seen))


def to_dau_sink(first: DataFrame) -> DataFrame:
    """The 11 upper-case columns of the daily-active table."""
    src = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "logdate", "loghour", "ts"]
    return first.select(*[F.col(s).alias(d) for s, d in zip(src, DAU_SINK_COLUMNS)])


def new_devices_by_date(first: DataFrame) -> DataFrame:
    """Devices whose first-ever log date is each date: (logdate, new_devices)."""
    per_device = first.groupBy("mid").agg(F.min("logdate").alias("logdate"))
    return per_device.groupBy("logdate").agg(F.count(F.lit(1)).alias("new_devices"))


def stage_counts(raw: DataFrame, after_anti: DataFrame, after_dedup: DataFrame) -> DataFrame:
    """Row counts before and after each de-duplication stage.

    Three global counts (one partial aggregate each), unioned as rows.
    """
    def one(df, stage, order):
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(order).alias("step"), F.lit(stage).alias("stage"), "n")
    return (one(raw, "raw", 1).unionByName(one(after_anti, "after_seen_filter", 2))
            .unionByName(one(after_dedup, "after_batch_dedup", 3)))


def stage_counts_at_once(logs: DataFrame, earlier, keys=("logdate", "mid")) -> DataFrame:
    """The same three counts from one pass: ``logs`` holds the seen logs
    (``earlier``) and the batch. One shuffle on the keys, pre-aggregated, then three
    sums of it; a key with a null is never seen, as in the anti join."""
    old = F.coalesce(earlier, F.lit(False))
    known = F.bool_and(F.lit(True))
    for k in keys:
        known = known & F.bool_and(F.col(k).isNotNull())
    per_key = logs.groupBy(*keys).agg(F.count_if(~old).alias("n"), (F.bool_or(old) & known).alias("seen")).where("n > 0")
    zero = F.lit(0).cast("bigint")
    counts = [("raw", F.sum("n")), ("after_seen_filter", F.sum(F.when(~F.col("seen"), F.col("n")))),
              ("after_batch_dedup", F.count_if(~F.col("seen")))]
    return per_key.agg(F.inline(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(name).alias("stage"), F.coalesce(n, zero).alias("n"))
                                          for k, (name, n) in enumerate(counts, 1)])))
