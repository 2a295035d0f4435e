"""Structured Streaming jobs built from the batch operators.

Every job reads topic-shaped records (Kafka, or files of the same shape),
applies the same transforms as the batch queries, and writes either a keyed
table through ``foreachBatch`` (replay-safe upserts) or an append-only file
sink. Checkpoints live in the shared folder named by ``spark.checkpoint.dir``,
so a restarted driver or lost executors resume from the last committed batch.

The registered ``stream_*`` queries derive their input from the driver
tables, stage it as time-ordered files in the shared folder, run the job
with ``availableNow`` and return the sink read back as a DataFrame; their
oracle is the batch query's SQL (stream result = batch result).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.fixed import TOPIC_STRIPPED
from tidemark.functions.timefmt import instant_to_ntz, ntz_to_instant
from tidemark.operators import alerts as AL
from tidemark.operators import dedup as DD
from tidemark.operators import feeds as FE
from tidemark.operators import sales as SA
from tidemark.operators.joinmemory import JoinMemory
from tidemark.operators.keyed import FILE_BYTES, KeyedTable, _fs, bytes_under, list_children, staged_batch
from tidemark.operators.offsetlog import OffsetLog
from tidemark.operators.orders import clean_orders, to_order_sink
from tidemark.operators.parse import accepted, parse_json
from tidemark.operators.rollup import Dashboard
from tidemark.plans import params as P
from tidemark.schemas import (CDC_CHANGE, EVENT_LOG, ORDER_DETAIL, ORDER_INFO,  # noqa: F401
                              ORDER_SINK_ROW, SA_PAIR_SCHEMA, SALE_DETAIL_COLUMNS, SALE_ROW,
                              STARTUP_LOG, TOPIC_RECORD, USER_INFO)
from tidemark.session import run_dir
from tidemark.sources import adapters as AD
from tidemark.sources.tables import tables
from tidemark.sources.topics import topic_stream_writer

TRIGGER = "5 seconds"          # the reference's micro-batch interval
DAY_MS = 86_400_000
STAGED_BYTES = 256 << 10       # a staged slice of more bytes is dealt over several files, up to one a core


# ------------------------------------------------------------------ plumbing

def _run(writer, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=TRIGGER)
    return w.start()


# Longest micro-batch (seconds) and input rows / batch seconds of each
# finished stream run, for the bench.
BATCH_SECONDS: dict[str, float] = {}
ROWS_PER_SEC: dict[str, float] = {}
# State of each finished stateful run: rows that left it, rows it held at its
# largest and at the end, rows refused as late.
STATE_ROWS: dict[str, dict[str, int]] = {}
# Memory of the joins that run by micro-batch, by query id.
JOINS: dict[str, JoinMemory] = {}


def _finish(q: StreamingQuery, name: str = "") -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    prog = q.recentProgress
    durs = [p.get("durationMs", {}).get("triggerExecution", 0) for p in prog]
    if name and durs:
        BATCH_SECONDS[name] = max(BATCH_SECONDS.get(name, 0.0), max(durs) / 1000.0)
        n = sum(p.get("numInputRows", 0) for p in prog)
        ROWS_PER_SEC[name] = round(n / max(sum(durs) / 1000.0, 1e-9), 1)
        ops = [p["stateOperators"] for p in prog if p.get("stateOperators")]
        if ops:
            held = [sum(o["numRowsTotal"] for o in batch) for batch in ops]
            STATE_ROWS[name] = {"removed": sum(o["numRowsRemoved"] for batch in ops for o in batch),
                                "late": sum(o["numRowsDroppedByWatermark"] for batch in ops for o in batch),
                                "most": max(held), "last": held[-1],
                                "batches": sum(p.get("numInputRows", 0) > 0 for p in prog)}
        join = JOINS.pop(str(q.id), None)
        if join and join.rows:
            STATE_ROWS[name] = {"removed": sum(b["removed"] for b in join.rows), "late": sum(b["late"] for b in join.rows),
                                "most": max(b["most"] for b in join.rows), "last": join.rows[-1]["held"], "batches": len(join.rows)}


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = None, bytes_per_trigger: str | None = None) -> DataFrame:
    """Files as they appear. A trigger takes all that is new, unless one of
    the two budgets is given (``bytes_per_trigger``: such as ``10g``, sized to
    what the cluster clears in one trigger)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def replay_stream(spark: SparkSession, path: str, schema: T.StructType,
                  slices: int = P.STREAM_SLICES) -> DataFrame:
    """A staged replay: about ``slices`` data batches at any scale."""
    files = sum(n.endswith(".parquet") for n in list_children(spark, path))
    return file_stream(spark, path, schema, max(1, files // slices))


def stage_in_order(df: DataFrame, path: str, time_col: str, slices: int = P.STREAM_SLICES) -> None:
    """Write ``df`` as files that a file source replays in order of ``time_col``
    (an instant): at least ``slices`` files, more by bytes and cores, each holding one
    range of times (records without a time first) and a later modification
    time than the file before it, which is the order that a file source takes. A
    replay in order needs no more lateness than the feed itself has.

    The frame is derived once into a sibling folder and dealt by time from there. A file is
    one row group, so what a trigger takes is as many files as there are cores to read them.
    """
    spark = df.sparkSession
    full = f"{path.rstrip('/')}_derived"
    df.write.mode("overwrite").option("compression", "zstd").parquet(full)   # derive once: the range shuffle samples its input
    size = bytes_under(spark, full)
    each = max(1, -(-size // (slices * FILE_BYTES)),
               min(spark.sparkContext.defaultParallelism, -(-size // (slices * STAGED_BYTES))))
    spark.read.parquet(full).repartitionByRange(slices * each, F.asc_nulls_first(time_col)).sortWithinPartitions(
        F.asc_nulls_first(time_col)).write.option("compression", "zstd").parquet(path)
    put_in_order(spark, path)


def put_in_order(spark: SparkSession, path: str) -> None:
    """Set the files' modification times to follow their names (metadata only)."""
    files = sorted(n for n in list_children(spark, path) if n.endswith(".parquet"))
    folder, fs = _fs(spark, path)
    first = int(fs.getFileStatus(folder).getModificationTime()) - len(files)
    for k, name in enumerate(files):
        fs.setTimes(_fs(spark, f"{path.rstrip('/')}/{name}")[0], first + k, -1)


def _topic(df: DataFrame, topic: str, schema: T.StructType, ts: str, offset=None) -> DataFrame:
    """Records of ``df`` as topic records: value = JSON of ``schema`` fields."""
    return df.select(F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
                     (offset if offset is not None else F.lit(0).cast("long")).alias("offset"),
                     F.lit(None).cast("string").alias("key"),
                     F.to_json(F.struct(*[f.name for f in schema.fields])).alias("value"),
                     F.col(ts).alias("timestamp"))


# ---------------------------------------------------------------------- jobs

STARTUP_ROW = T.StructType(list(STARTUP_LOG.fields) + [
    T.StructField("logdate", T.StringType()), T.StructField("loghour", T.StringType())])


def dau_job(records: DataFrame, table: KeyedTable, checkpoint: str, delay: str = "1 day",
            available_now: bool = True) -> StreamingQuery:
    """First log per (logdate, mid) kept in state keyed by the UTC day (the
    watermark column is a key, so finished days leave the state); updates go
    to the keyed table, where the latest batch's row is the earliest log.
    Per-batch input and reject counts are observed as ``dau_input`` in the
    query progress (the reference printed them per batch)."""
    parsed = parse_json(records, STARTUP_LOG).observe(
        "dau_input", F.count(F.lit(1)).alias("raw"),
        F.count_if(F.col("_corrupt").isNotNull()).alias("rejected"))
    logs = DD.with_log_date_hour(accepted(parsed))
    logs = logs.withColumn("day_ts", F.timestamp_millis(F.col("ts") - F.pmod(F.col("ts"), F.lit(DAY_MS))))
    logs = logs.withWatermark("day_ts", delay)
    cols = [f.name for f in STARTUP_ROW.fields]
    rest = [c for c in cols if c not in ("logdate", "mid", "ts")]
    first = logs.groupBy("day_ts", "logdate", "mid").agg(
        F.min(F.struct("ts", *rest)).alias("_m")).select(
        "logdate", "mid", "_m.ts", *[f"_m.{c}" for c in rest]).select(*cols)
    # update output of the aggregation: one row per (day, logdate, mid) per batch
    return _run(first.writeStream.outputMode("update").foreachBatch(table.foreach_batch(True)),
                checkpoint, available_now)


def first_seen_job(records: DataFrame, kept: Dashboard, checkpoint: str, delay: str = "1 day",
                   available_now: bool = True) -> StreamingQuery:
    """Startup logs into the dashboard's kept tables. A log that is delivered again
    within ``delay`` is dropped by the stream's state; what a device's first
    log of a day and its first day are, is remembered by the tables, which
    outlive the state, the checkpoint and the process."""
    logs = DD.with_log_date_hour(accepted(parse_json(records, STARTUP_LOG)))
    logs = logs.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", delay)
    once = logs.dropDuplicatesWithinWatermark([f.name for f in STARTUP_LOG.fields])

    def _write(batch: DataFrame, batch_id: int) -> None:
        kept.add_logs(staged_batch(batch, f"{kept.path}/batch"), batch_id)
    return _run(once.writeStream.outputMode("append").foreachBatch(_write), checkpoint, available_now)


def alert_job(records: DataFrame, table: KeyedTable, checkpoint: str, window: str, slide: str,
              delay: str, available_now: bool = True) -> StreamingQuery:
    """Sliding-window alert ingredients per (mid, window), updated per batch
    into a keyed table; the alert predicate is applied when reading."""
    ev = AL.with_event_time(accepted(parse_json(records, EVENT_LOG))).withWatermark("event_time", delay)
    agg = AL.window_aggregate(ev, window, slide)
    return _run(agg.writeStream.outputMode("update").foreachBatch(table.foreach_batch(True)),
                checkpoint, available_now)


def closed_alert_job(records: DataFrame, out: str, checkpoint: str, window: str, slide: str, delay: str,
                     min_uids: int = AL.MIN_UIDS, available_now: bool = True) -> StreamingQuery:
    """Alerts of closed windows, appended once to files: panes first, then
    windows of panes. ``alert_job`` reports a window while it is open."""
    ev = AL.with_event_time(accepted(parse_json(records, EVENT_LOG))).withWatermark("event_time", delay)
    found = AL.alerts(AL.window_aggregate_chained(ev, window, slide), min_uids)
    return _run(found.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint, available_now)


def orders_job(records: DataFrame, table: KeyedTable, checkpoint: str,
               available_now: bool = True, rejects: str | None = None) -> StreamingQuery:
    """Parse, clean and upsert orders (stateless). Unparsable records go to
    ``rejects/batch_id=<n>`` instead of failing the batch."""
    arrival = ("timestamp", "partition", "offset")
    parsed = parse_json(records, ORDER_INFO, keep=("value", *arrival))

    def _write(batch: DataFrame, batch_id: int) -> None:
        b = staged_batch(batch.withColumn("value", F.when(F.col("_corrupt").isNotNull(), F.col("value"))), f"{table.path}/batch")
        # of two images of an order in one batch the later record wins
        table.upsert(to_order_sink(clean_orders(accepted(b.drop("value"))), arrival), batch_id, arrival=arrival)
        if rejects:
            b.where(F.col("_corrupt").isNotNull()).select("value").write.mode(
                "overwrite").parquet(f"{rejects}/batch_id={int(batch_id)}")
    return _run(parsed.writeStream.outputMode("append").foreachBatch(_write), checkpoint,
                available_now)


JOIN_ORDER = T.StructType([T.StructField(c, T.TimestampType() if c == "arrival" else T.StringType()) for c in (
    "id", "order_status", "create_time", "user_id", "create_date", "arrival")])
JOIN_DETAIL = T.StructType([T.StructField(c, T.TimestampType() if c == "arrival" else T.StringType()) for c in (
    "id", "order_id", "sku_id", "order_price", "sku_name", "arrival")])


def _sale_pairs(order_records: DataFrame, detail_records: DataFrame, write, checkpoint: str, delay: str,
                available_now: bool, within_seconds: int = P.JOIN_SECONDS, salt: int = 1) -> StreamingQuery:
    """Interval join of the order and detail streams on arrival time, a micro-batch's pairs
    at a time to ``write(pairs, batch_id)``; the join's memory lies beside the checkpoint's own
    folders. With ``salt`` > 1 a hot order's details are spread over that many tasks."""
    o = clean_orders(accepted(parse_json(order_records, ORDER_INFO, keep=("timestamp",))))
    d = accepted(parse_json(detail_records, ORDER_DETAIL, keep=("timestamp",)))

    def pair(orders, details):
        return SA.sale_detail(*SA.salt_pair(orders, details, salt), within_seconds)

    memory = JoinMemory(order_records.sparkSession, f"{checkpoint}/join", (JOIN_ORDER, JOIN_DETAIL), pair, delay, within_seconds)
    both = memory.both(o.withColumnRenamed("timestamp", "arrival"), d.withColumnRenamed("timestamp", "arrival"))

    def _write(batch: DataFrame, batch_id: int) -> None:
        memory.join(batch, batch_id, lambda pairs: write(pairs, batch_id))
    q = _run(both.writeStream.outputMode("append").foreachBatch(_write), checkpoint, available_now)
    JOINS[str(q.id)] = memory
    return q


def sale_join_job(order_records, detail_records, out: str, checkpoint: str, delay: str,
                  available_now: bool = True, salt: int = 1) -> StreamingQuery:
    """Sale pairs, in a folder of ``out`` for each batch, which a replayed batch overwrites."""
    def _write(pairs: DataFrame, batch_id: int) -> None:
        pairs.write.mode("overwrite").parquet(f"{out}/batch_id={int(batch_id)}")
    return _sale_pairs(order_records, detail_records, _write, checkpoint, delay, available_now, salt=salt)


USER_ROW = T.StructType(list(USER_INFO.fields) + [
    T.StructField("change_ts", T.TimestampType()), T.StructField("seq", T.LongType())])


def users_table(spark: SparkSession, path: str) -> KeyedTable:
    """Latest user images, in hash buckets of the id."""
    return KeyedTable(spark, path, USER_ROW, ["id"], ["change_ts", "seq"], buckets=P.USER_BUCKETS)


def sale_index(spark: SparkSession, path: str) -> KeyedTable:
    """The sale index: one row for each order detail, in order of date."""
    return KeyedTable(spark, path, SALE_ROW, ["order_detail_id"], part="dt")


def users_job(records: DataFrame, table: KeyedTable, checkpoint: str,
              available_now: bool = True) -> StreamingQuery:
    """User images (INSERT and UPDATE) into a keyed table, last write wins."""
    u = accepted(parse_json(records, USER_INFO, keep=("timestamp", "offset"))).select(
        *[f.name for f in USER_INFO.fields], F.col("timestamp").alias("change_ts"),
        F.col("offset").alias("seq"))
    return _run(u.writeStream.outputMode("append").foreachBatch(table.foreach_batch()),
                checkpoint, available_now)


def sale_users_job(order_records, detail_records, users: KeyedTable, index: KeyedTable,
                   checkpoint: str, delay: str, as_of: str, available_now: bool = True,
                   rejects: str | None = None) -> StreamingQuery:
    """Joined sales merged with the latest images of the batch's users (a lookup
    in their buckets of the user table), upserted
    into the sale index keyed by ``order_detail_id`` (a replayed detail
    replaces itself). Sales whose user is not known are left out of the index
    and, with ``rejects``, kept there."""
    def _write(pairs: DataFrame, batch_id: int) -> None:
        b = staged_batch(pairs, f"{index.path}/batch")      # the join runs once
        if not b.count():
            return
        found = users.lookup(b.select(F.col("user_id").alias("id")))
        joined, has_user = SA.with_users_split(b, found, as_of)
        j = joined.persist()
        try:
            index.upsert(j.where(has_user).select(*SALE_DETAIL_COLUMNS), batch_id)
            if rejects:
                j.where(~has_user).select(*SA_PAIR_SCHEMA.fieldNames()).write.mode(
                    "overwrite").parquet(f"{rejects}/batch_id={int(batch_id)}")
        finally:
            j.unpersist()
    return _sale_pairs(order_records, detail_records, _write, checkpoint, delay, available_now)


def cdc_route_job(changes: DataFrame, out: str | None, checkpoint: str,
                  available_now: bool = True, kind: str = "files",
                  options: dict | None = None) -> StreamingQuery:
    """Route row changes to their topics through one topic sink (Kafka, or
    files split by topic)."""
    routed = FE.cdc_route(changes)
    if kind == "files":
        options = {"compression": "zstd", **(options or {})}
    return _run(topic_stream_writer(routed, kind=kind, path=out, options=options),
                checkpoint, available_now)


def log_route_job(raw: DataFrame, topic_out: str, daily_out: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Intake routing: topic files plus one text file set per day, both per batch."""
    routed = FE.log_route(raw)

    def _write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            b.write.mode("overwrite").partitionBy("topic").parquet(f"{topic_out}/batch_id={batch_id}")
            b.select("value", "dt").write.mode("overwrite").partitionBy("dt").text(
                f"{daily_out}/batch_id={batch_id}")
        finally:
            b.unpersist()
    return _run(routed.writeStream.outputMode("append").foreachBatch(_write), checkpoint,
                available_now)


def transfer_job(records: DataFrame, target: str, out: str | None, checkpoint: str, available_now: bool = True,
                 kind: str = "files", options: dict | None = None) -> StreamingQuery:
    """Records of one topic, the marker stripped from their values, into the topic
    ``target`` through the topic sink (Kafka, or files split by topic)."""
    moved = FE.strip_topic(records).select(F.lit(target).alias("topic"), "key", "value")
    return _run(topic_stream_writer(moved, kind=kind, path=out, options=options), checkpoint, available_now)


def offset_log_job(records: DataFrame, log: OffsetLog, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Records of topics into an offset log, from which ranges of offsets are fetched."""
    return _run(records.writeStream.foreachBatch(log.foreach_batch()), checkpoint, available_now)


LOG_COUNT = T.StructType([T.StructField("topic", T.StringType()), T.StructField("hour_start", T.TimestampType()),
                          T.StructField("logs", T.LongType())])


def log_counts_job(startup: DataFrame, events: DataFrame, table: KeyedTable, checkpoint: str, delay: str,
                   event_delay: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Two topics of different schema in one query: logs of each topic and hour.
    Each topic has its own lateness; the query's watermark is that of the topic
    that is behind (Spark's ``multipleWatermarkPolicy``, ``min`` unless the session says otherwise)."""
    def side(records, topic, schema, late):
        logs = AL.with_event_time(accepted(parse_json(records, schema)))
        return logs.select(F.lit(topic).alias("topic"), "mid", "event_time").withWatermark("event_time", late)

    both = side(startup, AD.TOPIC_STARTUP, STARTUP_LOG, delay).unionByName(
        side(events, AD.TOPIC_EVENT, EVENT_LOG, event_delay or delay))
    counts = both.groupBy("topic", F.window("event_time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("logs"))
    return _run(counts.select("topic", F.col("w.start").alias("hour_start"), "logs").writeStream.outputMode("update")
                .foreachBatch(table.foreach_batch(True)), checkpoint, available_now)


def strip_job(records: DataFrame, out: str, checkpoint: str,
              available_now: bool = True) -> StreamingQuery:
    return _run(FE.strip_topic(records).writeStream.outputMode("append").format("parquet")
                .option("path", out), checkpoint, available_now)


# ------------------------------------------------- registered stream queries

def q_stream_dau(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-dau")
    logs = AD.startup_logs(t).withColumn("event_time", F.timestamp_millis("ts"))
    recs = _topic(logs, AD.TOPIC_STARTUP, STARTUP_LOG, "event_time", F.col("ts"))
    stage_in_order(recs, f"{base}/in", "timestamp")
    kt = KeyedTable(spark, f"{base}/table", STARTUP_ROW, ["logdate", "mid"], part="logdate")
    q = dau_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), kt, f"{base}/ckpt",
                delay="1 day")
    _finish(q, "stream_dau")
    return DD.to_dau_sink(kt.read())


def q_stream_new_devices(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-devices")
    logs = AD.startup_logs(t).withColumn("event_time", F.timestamp_millis("ts"))
    stage_in_order(_topic(logs, AD.TOPIC_STARTUP, STARTUP_LOG, "event_time", F.col("ts")), f"{base}/in", "timestamp", 3)
    kept = Dashboard(spark, f"{base}/kept")
    _finish(first_seen_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD, 3), kept, f"{base}/ckpt"), "stream_new_devices")
    return kept.new_devices()


def q_stream_alert(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-alert")
    ev = AD.event_logs(t).withColumn("event_time", F.timestamp_millis("ts"))
    recs = _topic(ev, AD.TOPIC_EVENT, EVENT_LOG, "event_time", F.col("ts"))
    stage_in_order(recs, f"{base}/in", "timestamp")
    probe = AL.window_aggregate(AL.with_event_time(accepted(parse_json(
        spark.createDataFrame([], TOPIC_RECORD), EVENT_LOG))), P.ALERT_WINDOW, P.ALERT_SLIDE)
    kt = KeyedTable(spark, f"{base}/table", probe.schema, ["mid", "window_start_ts"])
    q = alert_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), kt, f"{base}/ckpt",
                  P.ALERT_WINDOW, P.ALERT_SLIDE, P.STREAM_DELAY)
    _finish(q, "stream_alert")
    return AL.alerts(kt.read(), P.ALERT_MIN_UIDS)


def q_stream_alert_closed(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-alert-closed")
    ev = AD.event_logs(t).withColumn("event_time", F.timestamp_millis("ts"))
    # a heartbeat, without a device, after the last window: it closes what is open
    beat = ev.agg(F.max("ts").alias("ts")).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_LOG.fields if f.name != "ts"],
        (F.col("ts") + 2 * P.ALERT_WINDOW_S * 1000).alias("ts")).withColumn("event_time", F.timestamp_millis("ts"))
    recs = _topic(ev.unionByName(beat), AD.TOPIC_EVENT, EVENT_LOG, "event_time", F.col("ts"))
    stage_in_order(recs, f"{base}/in", "timestamp")
    q = closed_alert_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), f"{base}/out", f"{base}/ckpt",
                         P.ALERT_WINDOW, P.ALERT_SLIDE, P.STREAM_DELAY, P.ALERT_MIN_UIDS)
    _finish(q, "stream_alert_closed")
    return spark.read.schema(AL.ALERT_SCHEMA).parquet(f"{base}/out")


def _order_records(t):
    o = AD.order_infos(t).withColumn("at", ntz_to_instant("arrival"))
    return _topic(o, AD.TOPIC_ORDER_INFO, ORDER_INFO, "at")


def _detail_records(t):
    d = AD.order_details(t).withColumn("at", ntz_to_instant("arrival"))
    return _topic(d, AD.TOPIC_ORDER_DETAIL, ORDER_DETAIL, "at")


def q_stream_orders(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-orders")
    stage_in_order(_order_records(t), f"{base}/in", "timestamp")
    kt = KeyedTable(spark, f"{base}/table", ORDER_SINK_ROW, ["ID"], part="CREATE_DATE")
    _finish(orders_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), kt, f"{base}/ckpt",
                       rejects=f"{base}/rejects"), "stream_orders")
    kt.compact()
    return kt.read()


def _stage_sales(spark, t, base):
    stage_in_order(_order_records(t), f"{base}/orders", "timestamp")
    stage_in_order(_detail_records(t), f"{base}/details", "timestamp")


def q_stream_sale_join(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-sales")
    _stage_sales(spark, t, base)
    q = sale_join_job(replay_stream(spark, f"{base}/orders", TOPIC_RECORD),
                      replay_stream(spark, f"{base}/details", TOPIC_RECORD),
                      f"{base}/out", f"{base}/ckpt", P.STREAM_DELAY,
                      salt=P.STREAM_JOIN_SALT)
    _finish(q, "stream_sale_join")
    return spark.read.schema(SA_PAIR_SCHEMA).parquet(f"{base}/out").select(*SA_PAIR_SCHEMA.fieldNames())


def q_stream_sale_users(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-sale-users")
    ch = AD.user_changes(t).withColumn("at", ntz_to_instant("change_ts"))
    urec = _topic(ch, AD.TOPIC_USER_INFO, USER_INFO, "at", F.col("seq"))
    stage_in_order(urec, f"{base}/users_in", "timestamp")
    users = users_table(spark, f"{base}/users")
    _finish(users_job(replay_stream(spark, f"{base}/users_in", TOPIC_RECORD), users,
                      f"{base}/ckpt_users"), "stream_sale_users")
    users.compact()      # lookups then open the buckets of a batch's users only
    _stage_sales(spark, t, base)
    index = sale_index(spark, f"{base}/index")
    q = sale_users_job(replay_stream(spark, f"{base}/orders", TOPIC_RECORD),
                       replay_stream(spark, f"{base}/details", TOPIC_RECORD), users, index,
                       f"{base}/ckpt", P.STREAM_DELAY, P.AS_OF,
                       rejects=f"{base}/no_user")
    _finish(q, "stream_sale_users")
    return index.read()


def q_stream_cdc_route(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-cdc")
    ch = AD.cdc_changes(t).withColumn("at", ntz_to_instant("change_ts"))
    stage_in_order(ch, f"{base}/in", "at")
    schema = T.StructType(list(CDC_CHANGE.fields) + [T.StructField("at", T.TimestampType())])
    _finish(cdc_route_job(replay_stream(spark, f"{base}/in", schema), f"{base}/out", f"{base}/ckpt"),
            "stream_cdc_route")
    return spark.read.parquet(f"{base}/out").select("topic", "value")


def q_stream_log_route(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-logs")
    raw = AD.raw_logs(t).withColumn("at", F.timestamp_millis("arrival_ms"))
    stage_in_order(raw, f"{base}/in", "at")
    schema = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField("arrival_ms", T.LongType()),
                           T.StructField("at", T.TimestampType())])
    _finish(log_route_job(replay_stream(spark, f"{base}/in", schema), f"{base}/topics",
                          f"{base}/daily", f"{base}/ckpt"), "stream_log_route")
    full = T.StructType([T.StructField("value", T.StringType()), T.StructField("dt", T.StringType()),
                         T.StructField("batch_id", T.LongType()), T.StructField("topic", T.StringType())])
    return spark.read.schema(full).parquet(f"{base}/topics").select("topic", "value", "dt")


def q_stream_topic_strip(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-strip")
    stage_in_order(AD.topic_records(t), f"{base}/in", "timestamp")
    _finish(strip_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), f"{base}/out", f"{base}/ckpt"),
            "stream_topic_strip")
    return spark.read.parquet(f"{base}/out")


def q_stream_topic_transfer(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-transfer")
    stage_in_order(AD.topic_records(t), f"{base}/in", "timestamp")
    _finish(transfer_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), TOPIC_STRIPPED, f"{base}/out", f"{base}/ckpt"),
            "stream_topic_transfer")
    return spark.read.schema("key string, value string, topic string").parquet(f"{base}/out").select("topic", "key", "value")


def q_stream_topic_offsets(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-offsets")
    stage_in_order(AD.topic_records(t), f"{base}/in", "timestamp")
    log = OffsetLog(spark, f"{base}/log")
    _finish(offset_log_job(replay_stream(spark, f"{base}/in", TOPIC_RECORD), log, f"{base}/ckpt"), "stream_topic_offsets")
    return log.fetch(P.OFFSET_TOPIC, P.OFFSET_PARTITION, P.OFFSET_START, P.OFFSET_MAX_BYTES)


def q_stream_log_counts(spark, root):
    t = tables(spark, root)
    base = run_dir(spark, "stream-log-counts")
    for name, logs, topic, schema in (("startup", AD.startup_logs(t), AD.TOPIC_STARTUP, STARTUP_LOG),
                                      ("events", AD.event_logs(t), AD.TOPIC_EVENT, EVENT_LOG)):
        stage_in_order(_topic(logs.withColumn("event_time", F.timestamp_millis("ts")), topic, schema, "event_time", F.col("ts")),
                       f"{base}/{name}", "timestamp")
    kt = KeyedTable(spark, f"{base}/table", LOG_COUNT, ["topic", "hour_start"])
    _finish(log_counts_job(replay_stream(spark, f"{base}/startup", TOPIC_RECORD), replay_stream(spark, f"{base}/events", TOPIC_RECORD),
                           kt, f"{base}/ckpt", P.STREAM_DELAY), "stream_log_counts")
    return kt.read().select("topic", F.date_format(instant_to_ntz("hour_start"), "yyyy-MM-dd HH").alias("hour"), "logs")


STREAM_QUERIES = {
    "stream_dau": q_stream_dau,
    "stream_new_devices": q_stream_new_devices,
    "stream_alert": q_stream_alert,
    "stream_alert_closed": q_stream_alert_closed,
    "stream_orders": q_stream_orders,
    "stream_sale_join": q_stream_sale_join,
    "stream_sale_users": q_stream_sale_users,
    "stream_cdc_route": q_stream_cdc_route,
    "stream_log_route": q_stream_log_route,
    "stream_topic_strip": q_stream_topic_strip,
    "stream_topic_transfer": q_stream_topic_transfer,
    "stream_topic_offsets": q_stream_topic_offsets,
    "stream_log_counts": q_stream_log_counts,
}

# Stream result = batch result: each stream query is checked with the SQL of
# the batch query it must reproduce.
STREAM_ORACLE = {
    "stream_dau": "dau_first_log",
    "stream_new_devices": "new_devices",
    "stream_alert": "coupon_alert",
    "stream_alert_closed": "coupon_alert",
    "stream_orders": "order_info_clean",
    "stream_sale_join": "sale_detail_interval",
    "stream_sale_users": "sale_detail_users",
    "stream_cdc_route": "cdc_route",
    "stream_log_route": "log_route",
    "stream_topic_strip": "topic_strip",
    "stream_topic_transfer": "topic_transfer",
    "stream_topic_offsets": "topic_offset_range",
    "stream_log_counts": "log_counts",
}
