"""Interval join of two record streams, a micro-batch at a time, with its memory in files (J2, ST3, K4).

Layout under ``path``::

    batch/side=<s>/       rows of the batch at work, read from files from then on
    kept/batch_id=<n>/    memory after batch n: ``left`` and ``right``, rows that a later
                          batch may still pair, and ``mark``, one row, written last

``join(batch, batch_id)`` pairs the batch's rows with each other and with those kept, but
not kept rows with kept ones, whose pairs an earlier batch gave. A side's watermark is
its latest arrival in all batches so far less ``delay``, the join's the lesser of
the two, and none before both sides have a row. A row at or under the watermark of the batches before
its own is refused as late; of the others those stay that can still meet a row above the
watermark, the batch's own included. So the memory has the lateness and ``within`` seconds,
whatever a batch has read, and a batch is joined by a batch plan: sorted runs, and hot
keys split, instead of a look-up and two writes of a state store for each row.

A replayed batch reads the memory of the batch before it and writes the same again. What
a batch leaves counts once its mark is complete; superseded folders are left for a
retention job. Two rows a batch reach the driver: a count and the latest arrival of
each side, and the mark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.keyed import list_children, written_at

SIDES = ("left", "right")
MARK = T.StructType([T.StructField(f"{s}_last", T.TimestampType()) for s in SIDES])


class JoinMemory:
    """``pair(left, right)`` joins rows of the two sides, with the columns of ``schemas``
    (``arrival``, an instant, among them)."""

    def __init__(self, spark: SparkSession, path: str, schemas: tuple[T.StructType, T.StructType],
                 pair: Callable[[DataFrame, DataFrame], DataFrame], delay: str, within: int):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schemas = dict(zip(SIDES, schemas))
        self.pair = pair
        self.delay = delay
        self.within = int(within)
        self.rows: list[dict[str, int]] = []     # of each batch: held at its end, at most, removed, late

    def both(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """The two streams as one, of which micro-batches are given to :meth:`join`."""
        def side(df, name):
            return df.select(F.lit(name).alias("side"), "arrival", F.struct(*self.schemas[name].fieldNames()).alias(name))

        return side(left, "left").unionByName(side(right, "right"), allowMissingColumns=True)

    def _rows(self, name: str, path: str | None) -> DataFrame:
        if path is None:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(path)

    def _before(self, batch_id: int) -> str | None:
        """The newest complete memory of a batch before this one (file-system metadata only)."""
        root = f"{self.path}/kept"
        done = sorted((int(n.split("=", 1)[1]) for n in list_children(self.spark, root) if n.startswith("batch_id=")), reverse=True)
        return next((f"{root}/batch_id={n}" for n in done if n < batch_id
                     and written_at(self.spark, f"{root}/batch_id={n}/mark") is not None), None)

    def _watermark(self, last: dict):
        """Null as long as a side has no row."""
        at = [F.lit(last[s]).cast("timestamp") - F.expr(f"INTERVAL {self.delay}") for s in SIDES]
        return F.when(at[0].isNotNull() & at[1].isNotNull(), F.least(*at))

    def _staged(self, batch: DataFrame) -> dict[str, DataFrame]:
        root = f"{self.path}/batch"
        batch.write.mode("overwrite").partitionBy("side").parquet(root)
        there = set(list_children(self.spark, root))
        out = {}
        for name in SIDES:
            if f"side={name}" in there:
                nested = T.StructType([T.StructField(name, self.schemas[name])])
                out[name] = self.spark.read.schema(nested).parquet(f"{root}/side={name}").select(f"{name}.*")
            else:
                out[name] = self._rows(name, None)
        return out

    def join(self, batch: DataFrame, batch_id: int, write: Callable[[DataFrame], None]) -> None:
        """Gives the batch's pairs to ``write``, then keeps what later batches may pair."""
        new, before = self._staged(batch), self._before(batch_id)
        kept = {s: self._rows(s, f"{before}/{s}" if before else None) for s in SIDES}
        last = (self.spark.read.schema(MARK).parquet(f"{before}/mark").first().asDict() if before
                else dict.fromkeys(MARK.fieldNames()))
        last = {s: last[f"{s}_last"] for s in SIDES}
        passed = self._watermark(last)
        seen = {s: new[s].agg(F.count("*").alias("n"), F.max("arrival").alias("at"),
                              F.count_if(F.col("arrival") <= passed).alias("late")).first() for s in SIDES}
        in_time = {s: new[s].where(passed.isNull() | (F.col("arrival") > passed)) for s in SIDES}
        write(self.pair(in_time["left"], in_time["right"].unionByName(kept["right"]))
              .unionByName(self.pair(kept["left"], in_time["right"])))

        last = {s: max(filter(None, (last[s], seen[s]["at"])), default=None) for s in SIDES}
        needed = self._watermark(last) - F.expr(f"INTERVAL {self.within} SECONDS")
        root = f"{self.path}/kept/batch_id={int(batch_id)}"
        held = entered = 0
        for s in SIDES:
            stays = in_time[s].unionByName(kept[s]).where(F.col("arrival").isNotNull() & (needed.isNull() | (F.col("arrival") > needed)))
            stays.write.mode("overwrite").parquet(f"{root}/{s}")
            held += self._rows(s, f"{root}/{s}").count()
            entered += seen[s]["n"] - seen[s]["late"]
        mark = self.spark.range(1).select(*[F.lit(last[s]).cast("timestamp").alias(f"{s}_last") for s in SIDES])
        mark.write.mode("overwrite").parquet(f"{root}/mark")
        most = entered + (self.rows[-1]["held"] if self.rows else 0)
        self.rows.append({"held": held, "most": most, "removed": most - held, "late": sum(x["late"] for x in seen.values())})
