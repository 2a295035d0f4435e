"""Kept aggregates: totals of a keyed table, upheld by difference (S8, A12, R1, ST2).

A ``Rollup`` holds the row count and sums of each group. When a batch changes rows
of the keyed table, it moves by what the new images add and the old ones
(a lookup by key, as of the batches before) take away, so a row that is sent again or changes
its group counts once, and a batch that is written again starts from the same
totals and replaces itself. Dashboards read the rollup: one row for each date
and hour, whatever the traffic was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed import TOTAL_ROWS
from tidemark.operators import dedup as DD
from tidemark.operators import metrics as ME
from tidemark.operators.keyed import KeyedTable
from tidemark.schemas import ORDER_SINK_ROW, STARTUP_LOG

S = T.StringType()


class Rollup:
    """Groups with their number of rows ``n`` and ``sums`` (a null adds nothing); rows with a null in their group are in none."""

    def __init__(self, spark: SparkSession, path: str, group: list[str], sums: tuple[str, ...] = ()):
        self.group, self.sums = list(group), list(sums)
        schema = T.StructType([*[T.StructField(c, S) for c in self.group], T.StructField("n", T.LongType()),
                               *[T.StructField(c, T.DoubleType()) for c in self.sums]])
        self.table = KeyedTable(spark, path, schema, self.group)

    def _totals(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.dropna(subset=self.group).groupBy(*self.group).agg(
            (F.count(F.lit(1)) * sign).alias("n"),
            *[(F.coalesce(F.sum(c), F.lit(0)).cast("double") * sign).alias(c) for c in self.sums])

    def move(self, new: DataFrame, old: DataFrame, batch_id: int) -> None:
        """Add the rows ``new`` and take away the rows ``old``."""
        add = lambda df: df.groupBy(*self.group).agg(*[F.sum(c).alias(c) for c in ("n", *self.sums)])
        moved = add(self._totals(new, 1).unionByName(self._totals(old, -1))).persist()
        try:
            before = self.table.lookup(moved, before=batch_id)
            self.table.upsert(add(moved.unionByName(before)), batch_id, unique=True)
        finally:
            moved.unpersist()

    def read(self, where=None) -> DataFrame:
        return self.table.read(where).where(F.col("n") > 0)


class KeptTable:
    """A keyed table and the rollups that follow it."""

    def __init__(self, rows: KeyedTable, rollups: dict[str, Rollup]):
        self.rows, self.rollups = rows, rollups

    def upsert(self, df: DataFrame, batch_id: int, unique: bool = False, arrival: tuple[str, ...] = ()) -> None:
        """Write one batch; one that a base already holds is ignored. Rollups come
        first: a batch that stops half way is made whole by its replay."""
        base = self.rows._base()
        if base is not None and base >= batch_id:
            return
        new = (df.select(*self.rows.columns) if unique else self.rows.last_rows(df, arrival)).persist()
        try:
            if not new.count():
                return
            old = self.rows.lookup(new, before=batch_id).persist()
            try:
                fresh = not old.count()
                for rollup in self.rollups.values():
                    rollup.move(new, old, batch_id)
            finally:
                old.unpersist()
            self.rows.upsert(new, batch_id, unique=True, fresh=fresh)
        finally:
            new.unpersist()

    def read(self, where=None) -> DataFrame:
        return self.rows.read(where)

    def compact(self) -> None:
        for rollup in self.rollups.values():
            rollup.table.compact()
        self.rows.compact()


FIRST_LOG = T.StructType([*STARTUP_LOG.fields, T.StructField("logdate", S), T.StructField("loghour", S)])
FIRST_SEEN = T.StructType([T.StructField("mid", S), T.StructField("ts", T.LongType()), T.StructField("logdate", S)])


class Dashboard:
    """The dashboards' kept tables: first logs by device and day, first sight of
    each device, orders; and their totals by date and hour."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 0):
        self.path = root = path.rstrip("/")

        def kept(name, schema, key, group, sums=(), part=None):
            return KeptTable(KeyedTable(spark, f"{root}/{name}", schema, key, part=part, buckets=buckets),
                             {"totals": Rollup(spark, f"{root}/{name}_totals", group, sums)})

        self.first_logs = kept("first_logs", FIRST_LOG, ["logdate", "mid"], ["logdate", "loghour"], part="logdate")
        self.devices = kept("devices", FIRST_SEEN, ["mid"], ["logdate"])
        self.orders = kept("orders", ORDER_SINK_ROW, ["ID"], ["CREATE_DATE", "CREATE_HOUR"], ("TOTAL_AMOUNT",), part="CREATE_DATE")

    # ------------------------------------------------------------- upkeep
    def _earlier(self, table: KeptTable, found: DataFrame, batch_id: int) -> DataFrame:
        """Rows of ``found`` that come before what the table has for their key."""
        key = table.rows.key
        known = table.rows.lookup(found, before=batch_id).select(*key, F.col("ts").alias("_ts"))
        return found.join(known, key, "left").where(F.col("_ts").isNull() | (F.col("ts") < F.col("_ts"))).drop("_ts")

    def add_logs(self, logs: DataFrame, batch_id: int) -> None:
        """Startup logs (with logdate and loghour) of one batch: each device's
        first log of a day, and its first day, are kept; logs without a device or time are in neither."""
        first = DD.first_logs(logs.where(F.col("mid").isNotNull() & F.col("logdate").isNotNull()).select(*FIRST_LOG.fieldNames())).persist()
        try:
            if not first.count():
                return
            seen = first.groupBy("mid").agg(F.min(F.struct("ts", "logdate")).alias("_m")).select("mid", "_m.ts", "_m.logdate").persist()
            try:
                self.devices.upsert(self._earlier(self.devices, seen, batch_id), batch_id, unique=True)
                self.first_logs.upsert(self._earlier(self.first_logs, first, batch_id), batch_id, unique=True)
            finally:
                seen.unpersist()
        finally:
            first.unpersist()

    def add_orders(self, sink_rows: DataFrame, batch_id: int, arrival: tuple[str, ...] = ()) -> None:
        """Cleaned orders of one batch (the 20 sink columns)."""
        self.orders.upsert(sink_rows, batch_id, arrival=arrival)

    def compact(self) -> None:
        for table in (self.first_logs, self.devices, self.orders):
            table.compact()

    # ------------------------------------------------------------- reading
    def new_devices(self) -> DataFrame:
        """(logdate, new_devices)."""
        return self.devices.rollups["totals"].read().select("logdate", F.col("n").alias("new_devices"))

    def realtime_total(self, date: str, order_date: str | None = None) -> DataFrame:
        """The headline list (id, name, value), from totals only."""
        day = order_date or date
        logs = self.first_logs.rollups["totals"].read(F.col("logdate") == date)
        seen = self.devices.rollups["totals"].read(F.col("logdate") == date)
        orders = self.orders.rollups["totals"].read(F.col("CREATE_DATE") == day)
        count = F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value")
        frames = (logs.agg(count), seen.agg(count), orders.agg(F.round(F.sum("TOTAL_AMOUNT"), 2).alias("value")))
        a, b, c = (frame.select(F.lit(i).alias("id"), F.lit(name).alias("name"), "value")
                   for (i, name), frame in zip(TOTAL_ROWS, frames))
        return a.unionByName(b).unionByName(c)

    def hours(self, metric: str, date: str) -> DataFrame | None:
        """(hour, today, yesterday) for 'dau' or 'order_amount'; None otherwise."""
        if metric == "dau":
            return ME.hours_compare(self.first_logs.rollups["totals"].read(), date, "logdate", "loghour", "n")
        if metric == "order_amount":
            return ME.hours_compare(self.orders.rollups["totals"].read(), date, "CREATE_DATE", "CREATE_HOUR", "TOTAL_AMOUNT", 0.0)
        return None
