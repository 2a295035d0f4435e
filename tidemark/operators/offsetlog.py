"""Topic records kept in order of their offsets, with an index of them.

Layout under ``path``: ``records/batch=<n>/attempt=<id>`` holds a batch's records in
files sorted by (topic, partition, offset), in row groups of ROW_GROUP bytes;
``index`` is a keyed table with one row for each batch and slot of ``span``
consecutive offsets: its records, their value bytes, and the folder they are in.
The index row is written after the records, so a reader sees whole batches
only, and a replayed batch replaces itself.

``fetch`` widens a range of slots step by step until the index says that the
byte cap is met, then scans only the row groups of that range. What it reads
follows the cap, not the length of the topic.

Records without a topic, partition or offset are stored but never fetched;
offsets that two batches hold are both returned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed import FETCH_BYTES
from tidemark.operators.feeds import offset_range
from tidemark.operators.keyed import KeyedTable
from tidemark.schemas import TOPIC_RECORD

#: Offsets of a slot; bytes of a row group of records, about.
SPAN, ROW_GROUP = 1024, 8 << 20
#: Slots that the first step looks at; each further one looks at WIDER times as many.
FIRST, WIDER = 16, 8

PLACE = ["topic", "partition", "offset"]
INDEX_ROW = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("slot", T.LongType()), T.StructField("batch", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("folder", T.StringType())])


class OffsetLog:
    def __init__(self, spark: SparkSession, path: str, span: int = SPAN):
        self.spark, self.path, self.span = spark, path.rstrip("/"), int(span)
        self.index = KeyedTable(spark, f"{self.path}/index", INDEX_ROW, ["topic", "partition", "slot", "batch"])

    def append(self, records: DataFrame, batch_id: int) -> None:
        """Write one batch of records: one range shuffle by place. Cache ``records`` if it is
        dear; the ranges are sampled first."""
        folder = f"batch={int(batch_id)}/attempt={uuid.uuid4().hex}"
        at = f"{self.path}/records/{folder}"
        (records.select(*TOPIC_RECORD.fieldNames()).repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
         .write.option("parquet.block.size", ROW_GROUP).parquet(at))
        slots = self.spark.read.schema(TOPIC_RECORD).parquet(at).groupBy(
            "topic", "partition", F.floor(F.col("offset") / self.span).cast("long").alias("slot")).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("long").alias("bytes"))
        self.index.upsert(slots.withColumns({"batch": F.lit(int(batch_id)).cast("long"), "folder": F.lit(folder)}),
                          batch_id, unique=True)

    def foreach_batch(self):
        """A ``foreachBatch`` function that appends each micro-batch that has records."""
        def _write(batch_df: DataFrame, batch_id: int) -> None:
            b = batch_df.persist()
            try:
                if b.count():
                    self.append(b, batch_id)
            finally:
                b.unpersist()
        return _write

    def compact(self) -> int | None:
        """Compact the index; records stay as they were written."""
        return self.index.compact()

    def _end(self, slots: DataFrame, first: int, max_bytes: int) -> int | None:
        """The slot in which the cap is met at the latest; None if the log ends before.
        ``slots``: index rows of one partition, from slot ``first`` on. One number reaches
        the driver in each step."""
        after = slots.where(F.col("slot") > first)   # of the first slot some records may lie before the start
        reach = FIRST
        while True:
            seen = after.where(F.col("slot") <= first + reach).groupBy("topic", "partition", "slot").agg(F.sum("bytes").alias("b"))
            upto = F.sum("b").over(Window.partitionBy("topic", "partition").orderBy("slot")
                                   .rowsBetween(Window.unboundedPreceding, 0))
            end = seen.select("slot", upto.alias("upto")).where(F.col("upto") > max_bytes).agg(F.min("slot")).first()[0]
            if end is not None:
                return end
            beyond = after.where(F.col("slot") > first + reach).agg(F.min("slot")).first()[0]
            if beyond is None:
                return None
            reach = max(reach * WIDER, beyond - first + FIRST)

    def scan(self, topic: str, partition: int, start: int, max_bytes: int) -> DataFrame:
        """Records from offset ``start`` to the end of the slot in which the cap is met."""
        first = start // self.span
        slots = self.index.read((F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("slot") >= first))
        end = self._end(slots, first, max_bytes)
        slots = slots if end is None else slots.where(F.col("slot") <= end)
        folders = [r["folder"] for r in slots.select("folder").distinct().collect()]   # one a batch of the range
        if not folders:
            return self.spark.createDataFrame([], TOPIC_RECORD)
        found = self.spark.read.schema(TOPIC_RECORD).parquet(*[f"{self.path}/records/{f}" for f in sorted(folders)]).where(
            (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") >= start))
        return found if end is None else found.where(F.col("offset") < (end + 1) * self.span)

    def fetch(self, topic: str, partition: int, start: int, max_bytes: int = FETCH_BYTES) -> DataFrame:
        """(offset, value) of one topic partition from offset ``start`` while the running
        total of value bytes stays within ``max_bytes``, as :func:`offset_range` gives them."""
        return offset_range(self.scan(topic, partition, start, max_bytes), topic, partition, start, max_bytes, self.span)
