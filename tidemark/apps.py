"""Long-running streaming apps: topic source -> job -> keyed table / topic sink.

    python -m tidemark.apps dau --kind kafka --servers host:9092 --out <dir> --checkpoint <dir>
    python -m tidemark.apps orders --kind files --path <topic files> --out <dir> --checkpoint <dir> --once
    python -m tidemark.apps users --servers host:9092 --out <user table> --checkpoint <dir>
    python -m tidemark.apps sale_users --servers host:9092 --users <user table> --out <sale index> --checkpoint <dir>
    python -m tidemark.apps compact --table users --out <user table>

Every app uses the 5-second processing-time trigger (``--once`` drains what
is there with ``availableNow``). Outputs and checkpoints belong in the
shared folder of the cluster.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.fixed import (ALERT_SLIDE, ALERT_WINDOW, TOPIC_EVENT, TOPIC_ORDER_DETAIL,
                            TOPIC_ORDER_INFO, TOPIC_RAW, TOPIC_STARTUP, TOPIC_STRIPPED, TOPIC_USER_INFO)
from tidemark.operators import alerts as AL
from tidemark.operators.keyed import KeyedTable
from tidemark.operators.offsetlog import OffsetLog
from tidemark.operators.parse import accepted, parse_json
from tidemark.operators.rollup import Dashboard
from tidemark.plans.params import AS_OF
from tidemark.schemas import CDC_CHANGE, EVENT_LOG, ORDER_SINK_ROW, TOPIC_RECORD
from tidemark.sources.topics import read_topics
from tidemark.streaming import jobs as J

APPS = ("dau", "devices", "alert", "closed_alert", "orders", "users", "sale_join", "sale_users", "strip", "transfer", "offsets", "cdc",
        "logs")

LOG_INPUT = T.StructType([T.StructField("value", T.StringType()),
                          T.StructField("arrival_ms", T.LongType())])


def _source(spark: SparkSession, topics: list[str], kind: str, path: str | None,
            servers: str | None):
    opts = {"kafka.bootstrap.servers": servers} if kind == "kafka" else {}
    return read_topics(spark, topics, kind=kind, path=path, stream=True, options=opts)


def _alert_table(spark: SparkSession, path: str) -> KeyedTable:
    probe = AL.window_aggregate(AL.with_event_time(accepted(parse_json(
        spark.createDataFrame([], TOPIC_RECORD), EVENT_LOG))), ALERT_WINDOW, ALERT_SLIDE)
    return KeyedTable(spark, path, probe.schema, ["mid", "window_start_ts"])


#: The tables that apps write, by the app's name; each has ``compact()``.
TABLES = {
    "dau": lambda spark, path: KeyedTable(spark, path, J.STARTUP_ROW, ["logdate", "mid"], part="logdate"),
    "alert": _alert_table,
    "orders": lambda spark, path: KeyedTable(spark, path, ORDER_SINK_ROW, ["ID"], part="CREATE_DATE"),
    "devices": Dashboard,
    "users": J.users_table,
    "sale_users": J.sale_index,
    "offsets": OffsetLog,
}


def start(spark: SparkSession, app: str, *, kind: str, out: str, checkpoint: str,
          path: str | None = None, detail_path: str | None = None, users: str | None = None,
          servers: str | None = None, once: bool = False, delay: str = "10 minutes",
          as_of: str = AS_OF):
    """Start one app and return its StreamingQuery."""
    live = not once
    table = TABLES[app](spark, out) if app in TABLES else None
    if app == "dau":
        return J.dau_job(_source(spark, [TOPIC_STARTUP], kind, path, servers), table,
                         checkpoint, delay="1 day", available_now=not live)
    if app == "devices":
        return J.first_seen_job(_source(spark, [TOPIC_STARTUP], kind, path, servers), table,
                                checkpoint, delay="1 day", available_now=not live)
    if app == "alert":
        return J.alert_job(_source(spark, [TOPIC_EVENT], kind, path, servers), table, checkpoint,
                           ALERT_WINDOW, ALERT_SLIDE, delay, available_now=not live)
    if app == "closed_alert":
        return J.closed_alert_job(_source(spark, [TOPIC_EVENT], kind, path, servers), out, checkpoint,
                                  ALERT_WINDOW, ALERT_SLIDE, delay, available_now=not live)
    if app == "orders":
        return J.orders_job(_source(spark, [TOPIC_ORDER_INFO], kind, path, servers), table,
                            checkpoint, available_now=not live, rejects=f"{out}_rejects")
    if app == "users":
        return J.users_job(_source(spark, [TOPIC_USER_INFO], kind, path, servers), table,
                           checkpoint, available_now=not live)
    if app == "sale_users":
        if users is None:
            raise ValueError("sale_users needs the user table's folder")
        orders = _source(spark, [TOPIC_ORDER_INFO], kind, path, servers)
        details = _source(spark, [TOPIC_ORDER_DETAIL], kind, detail_path or path, servers)
        return J.sale_users_job(orders, details, J.users_table(spark, users), table, checkpoint, delay,
                                as_of, available_now=not live, rejects=f"{out}_no_user")
    if app == "sale_join":
        orders = _source(spark, [TOPIC_ORDER_INFO], kind, path, servers)
        details = _source(spark, [TOPIC_ORDER_DETAIL], kind, detail_path or path, servers)
        return J.sale_join_job(orders, details, out, checkpoint, delay, available_now=not live)
    if app == "strip":
        return J.strip_job(_source(spark, [TOPIC_RAW], kind, path, servers), out, checkpoint,
                           available_now=not live)
    if app == "transfer":     # stripped, into another topic (Kafka, or files)
        return J.transfer_job(_source(spark, [TOPIC_RAW], kind, path, servers), TOPIC_STRIPPED, out, checkpoint,
                              available_now=not live, kind=kind,
                              options={"kafka.bootstrap.servers": servers} if kind == "kafka" else None)
    if app == "offsets":
        return J.offset_log_job(_source(spark, [TOPIC_RAW], kind, path, servers), table, checkpoint, available_now=not live)
    if app == "cdc":          # change rows (table, entry_type, event_type, after, ...) as files
        changes = J.file_stream(spark, path, CDC_CHANGE)
        return J.cdc_route_job(changes, out, checkpoint, available_now=not live,
                               kind="kafka" if servers else "files",
                               options={"kafka.bootstrap.servers": servers} if servers else None)
    if app == "logs":         # intake lines (value, arrival_ms) as files
        return J.log_route_job(J.file_stream(spark, path, LOG_INPUT), f"{out}/topics",
                               f"{out}/daily", checkpoint, available_now=not live)
    raise ValueError(f"unknown app {app!r}; one of {APPS}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark.apps")
    ap.add_argument("app", choices=(*APPS, "compact"))
    ap.add_argument("--kind", choices=("kafka", "files"), default="kafka")
    ap.add_argument("--servers")
    ap.add_argument("--path")
    ap.add_argument("--detail-path")
    ap.add_argument("--users")
    ap.add_argument("--table", choices=sorted(TABLES))
    ap.add_argument("--as-of", default=AS_OF)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--delay", default="10 minutes")
    ap.add_argument("--once", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark-{a.app}").getOrCreate()
    if a.app == "compact":
        if a.table is None:
            ap.error("compact needs --table")
        TABLES[a.table](spark, a.out).compact()
        return
    if a.checkpoint is None:
        ap.error("a stream needs --checkpoint")
    q = start(spark, a.app, kind=a.kind, out=a.out, checkpoint=a.checkpoint, path=a.path,
              detail_path=a.detail_path, users=a.users, servers=a.servers, once=a.once, delay=a.delay,
              as_of=a.as_of)
    q.awaitTermination()


if __name__ == "__main__":
    main()
