"""Topic sources and sinks: Kafka when the connector is on the classpath,
otherwise folders of files with the Kafka row shape
(topic, partition, offset, key, value, timestamp)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TOPIC_RECORD


def read_topics(spark: SparkSession, topics: list[str], *, kind: str = "files",
                path: str | None = None, schema: T.StructType = TOPIC_RECORD,
                stream: bool = False, options: dict | None = None) -> DataFrame:
    """Records of several topics as one frame (a multi-topic subscription).

    kind='kafka': ``options`` must carry ``kafka.bootstrap.servers``; values
    are cast to text. kind='files': parquet under ``path``; ``options`` are
    passed to the reader (e.g. ``maxFilesPerTrigger``).
    """
    opts = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if kind == "kafka":
        df = reader.format("kafka").option("subscribe", ",".join(topics)).options(**opts).load()
        return df.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"), "timestamp")
    if path is None:
        raise ValueError("files source needs a path")
    df = reader.schema(schema).options(**opts).parquet(path)
    return df.where(F.col("topic").isin(*topics)) if "topic" in schema.fieldNames() else df


def read_offset_range(spark: SparkSession, topic: str, partition: int, start: int,
                      end: int | None = None, bootstrap: str | None = None) -> DataFrame:
    """Batch read of one Kafka topic partition from ``start`` (exclusive ``end``)."""
    ends = '"latest"' if end is None else f'{{"{topic}":{{"{partition}":{end}}}}}'
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("assign", f'{{"{topic}":[{partition}]}}')
            .option("startingOffsets", f'{{"{topic}":{{"{partition}":{start}}}}}')
            .option("endingOffsets", ends.strip('"') if end is None else ends).load())


def write_topic_files(df: DataFrame, path: str, mode: str = "append") -> None:
    """Offline topic sink: (topic, value[, key, partition]) files split by topic."""
    df.write.mode(mode).partitionBy("topic").parquet(path)


def topic_stream_writer(routed: DataFrame, *, kind: str = "files", path: str | None = None,
                        options: dict | None = None):
    """Stream sink for rows with a ``topic`` column: one sink, many topics.

    kind='kafka': each row goes to its own ``topic`` (``value`` and optional
    ``key``/``partition`` columns, per the Kafka sink); ``options`` carry
    ``kafka.bootstrap.servers``. kind='files': parquet under ``path`` split
    by topic (exactly-once through the file sink's log).
    """
    w = routed.writeStream.outputMode("append").options(**dict(options or {}))
    if kind == "kafka":
        return w.format("kafka")
    if path is None:
        raise ValueError("files sink needs a path")
    return w.format("parquet").option("path", path).partitionBy("topic")
