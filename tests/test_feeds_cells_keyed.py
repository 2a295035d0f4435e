import datetime as dt
import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators import cells as CE
from tidemark.operators import feeds as FE
from tidemark.operators.keyed import KeyedTable
from tidemark.operators.offsetlog import OffsetLog
from tidemark.session import run_dir

NOW = dt.datetime(2024, 1, 1)


def test_cdc_routing(spark):
    data = []
    for table in ("order_info", "order_detail", "user_info", "payment_info"):
        for ev in ("INSERT", "UPDATE", "DELETE"):
            data.append((table, "ROWDATA", ev, {"id": "1", "v": None}, NOW, 1))
    data += [("order_info", "TRANSACTIONBEGIN", None, None, NOW, 2),
             ("order_info", "TRANSACTIONEND", None, None, NOW, 3)]
    ch = spark.createDataFrame(data, "table string, entry_type string, event_type string, "
                                     "after map<string,string>, change_ts timestamp_ntz, seq long")
    got = [(t, json.loads(v)) for t, v in rows(FE.cdc_route(ch))]
    after = {"id": "1", "v": None}
    assert got == [("gmall_order_detail", after), ("gmall_order_info", after),
                   ("gmall_user_info", after), ("gmall_user_info", after)]


def test_log_routing_stamps_arrival(spark):
    raw = spark.createDataFrame([('{"type":"startup","mid":"m1","ts":1}', 99),
                                 ('{"type":"event","mid":"m1","evid":"coupon"}', 100),
                                 ('{"mid":"m2"}', 1704153600000)], "value string, arrival_ms long")
    got = rows(FE.log_route(raw))
    assert got == [("gmall_event", '{"mid":"m2","ts":1704153600000}', "2024-01-02"),
                   ("gmall_event", '{"type":"event","mid":"m1","evid":"coupon","ts":100}', "1970-01-01"),
                   ("gmall_startup", '{"type":"startup","mid":"m1","ts":99}', "1970-01-01")]


def test_log_route_keeps_every_field(spark):
    raw = spark.createDataFrame([('{"type":"event","pgid":12,"extra":"x","props":{"a":1},"ts":"text"}', 99), ("{}", 5),
                                 ('{"type":null,"a":[1.5,true]}', 6)], "value string, arrival_ms long")
    assert sorted(r["value"] for r in FE.log_route(raw).collect()) == [
        '{"ts":5}', '{"type":"event","pgid":12,"extra":"x","props":{"a":1},"ts":99}', '{"type":null,"a":[1.5,true],"ts":6}']


def _records(spark, data):
    return spark.createDataFrame(
        [("first", p, o, None, v, NOW) for p, o, v in data],
        "topic string, partition int, offset long, key string, value string, timestamp timestamp")


def test_offset_range_byte_cap(spark):
    recs = _records(spark, [(3, 100, "aaaa"), (3, 108, "bbbb"), (3, 109, "cccc"), (3, 111, "dd"),
                            (3, 120, "eeee"), (2, 110, "zzzz")])
    got = rows(FE.offset_range(recs, "first", 3, 108, 10))
    assert got == [(108, "bbbb"), (109, "cccc"), (111, "dd")]     # 4+4+2 = 10: cap reached exactly
    small_chunks = rows(FE.offset_range(recs, "first", 3, 108, 10, chunk=2))
    assert small_chunks == got
    assert rows(FE.offset_range(recs, "first", 3, 108, 3)) == []


def _log(spark, name, batches, span=8):
    log = OffsetLog(spark, run_dir(spark, name), span=span)
    for n, data in enumerate(batches):
        log.append(_records(spark, data), n)
    return log


def test_offset_log_gives_the_range_of_the_records(spark):
    r = random.Random(4)
    data = [(p, o, r.choice([None, "", "x" * r.randrange(40)])) for p in (2, 3)
            for o in sorted(r.sample(range(3000), 500)) + list(range(9000, 9100))]
    r.shuffle(data)
    log = _log(spark, "t-offsets", [data[:700], data[700:]])
    recs = _records(spark, data)
    for start, cap in ((0, 0), (0, 100), (108, 2000), (2990, 500), (1500, 10 ** 9), (9099, 10), (20_000, 10)):
        assert rows(log.fetch("first", 3, start, cap)) == rows(FE.offset_range(recs, "first", 3, start, cap)), (start, cap)
    log.compact()
    assert rows(log.fetch("first", 3, 108, 2000)) == rows(FE.offset_range(recs, "first", 3, 108, 2000))
    assert log.fetch("other", 3, 0, 10).collect() == [] == log.fetch("first", 7, 0, 10).collect()


def test_offset_log_replaces_a_replayed_batch(spark):
    log = _log(spark, "t-offsets-replay", [[(3, 1, "aa"), (3, 2, "bb")], [(3, 3, "cc")]])
    log.append(_records(spark, [(3, 1, "aa"), (3, 2, "bb"), (3, None, "zz")]), 0)
    assert rows(log.fetch("first", 3, 0, 100)) == [(1, "aa"), (2, "bb"), (3, "cc")]
    assert OffsetLog(spark, run_dir(spark, "t-offsets-none")).fetch("first", 3, 0, 10).collect() == []


def test_offset_log_reads_what_the_cap_needs(spark):
    data = [(3, o, "v" * 10) for o in range(20_000)]
    log = _log(spark, "t-offsets-scan", [data], span=64)
    assert log.fetch("first", 3, 5000, 1000).count() == 100
    assert log.scan("first", 3, 5000, 1000).count() <= 100 + 3 * 64
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = log.scan("first", 3, 5000, 1000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(offset,5000)" in plan and "LessThan(offset," in plan


def test_prefix_and_strip(spark):
    recs = spark.sql("SELECT 'first' AS topic, 0 AS partition, 5L AS offset, 'k' AS key, "
                     "'atguigu>>>x' AS value, timestamp_millis(1704153600123) AS timestamp")
    assert rows(FE.strip_topic(recs)) == [("first", 0, 5, "k", "x")]
    assert rows(FE.prefix_time(recs)) == [("first", 1, "k", "1704153600123-atguigu>>>x")]


def test_delivery_counts(spark):
    df = spark.createDataFrame([(True,), (True,), (False,)], "acked boolean")
    assert rows(FE.delivery_counts(df)) == [(2, 1)]


def test_cells_text_null_and_order(spark):
    df = spark.createDataFrame([(10, "b", 1.5, True, None), (2, "a", 2.0, False, 7)],
                               "id int, name string, score double, flag boolean, n int")
    cells = CE.to_cells(df)
    got = rows(cells)
    assert ("10", "hfile-fy", "flag", "true") in got and ("10", "hfile-fy", "score", "1.5") in got
    assert not any(r[0] == "10" and r[2] == "n" for r in got)        # null cell skipped
    assert [r[2] for r in got if r[0] == "2"] == ["flag", "n", "name", "score"]
    path = run_dir(spark, "cells-test")
    CE.write_sorted_cells(cells, path, 2)
    back = [tuple(r) for r in spark.read.parquet(path).collect()]
    keys = [(r[0], r[1], r[2]) for r in back]
    assert keys == sorted(keys) and keys[0][0] == "10"               # '10' sorts before '2'
    inline = spark.createDataFrame([("abc", "ext", "type", "login"), ("ccc", "ext", "type", "logout")],
                                   "rowkey string, family string, qualifier string, value string")
    assert CE.cells_from_tuples(inline).count() == 2


def test_keyed_table_replay_compaction_and_filter(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("dt", T.StringType())])
    kt = KeyedTable(spark, run_dir(spark, "keyed-test"), schema, ["k"], ["v"], part="dt")
    b0 = spark.createDataFrame([("a", 1, "d1"), ("a", 3, "d1"), ("b", 1, "d2")], schema)
    b1 = spark.createDataFrame([("a", 2, "d1"), ("c", 5, "d2")], schema)
    kt.upsert(b0, 0)
    assert rows(kt.read()) == [("a", 3, "d1"), ("b", 1, "d2")]     # last per key in a batch
    kt.upsert(b1, 1)
    kt.upsert(b1, 1)                                               # replay: same result
    assert rows(kt.read()) == [("a", 2, "d1"), ("b", 1, "d2"), ("c", 5, "d2")]
    assert kt.compact() == 1
    kt.upsert(spark.createDataFrame([("b", 9, "d2")], schema), 2)
    assert rows(kt.read()) == [("a", 2, "d1"), ("b", 9, "d2"), ("c", 5, "d2")]
    assert rows(kt.read(F.col("dt") == "d1")) == [("a", 2, "d1")]
    kt.upsert(b0, 0)                                               # replay of a compacted batch
    assert rows(kt.read()) == [("a", 2, "d1"), ("b", 9, "d2"), ("c", 5, "d2")]


def _keyed(spark, name, **kw):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("dt", T.StringType())])
    kt = KeyedTable(spark, run_dir(spark, name), schema, ["k"], part="dt", **kw)
    return kt, lambda *data: spark.createDataFrame(list(data), schema)


def test_keyed_table_compaction_leaves_a_batch_in_flight_alone(spark):
    kt, frame = _keyed(spark, "keyed-flight")
    kt.upsert(frame(("a", 1, "d1")), 0)
    begun = f"{kt.path}/log/batch_id=1/attempt=x"
    frame(("b", 2, "d1")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(begun)
    kt.upsert(frame(("c", 3, "d1")), 2)
    assert rows(kt.read()) == [("a", 1, "d1"), ("c", 3, "d1")]       # half-written batches are not read
    assert kt.compact() == 0
    frame(("b", 2, "d1")).write.mode("overwrite").parquet(begun)     # now it finishes
    assert rows(kt.read()) == [("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d1")]
    assert kt.compact() == 2
    assert rows(kt.read()) == [("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d1")]


def test_keyed_table_null_part_null_key_and_moved_key(spark):
    kt, frame = _keyed(spark, "keyed-null")
    kt.upsert(frame(("n", 7, None), (None, 1, "d1"), ("a", 1, "d1")), 0)
    kt.compact()
    assert sorted(map(str, kt.read().collect())) == sorted(map(str, frame(("n", 7, None), (None, 1, "d1"), ("a", 1, "d1")).collect()))
    kt.upsert(frame((None, 2, "d1"), ("a", 2, "d2")), 1)
    want = sorted(map(str, frame(("n", 7, None), (None, 2, "d1"), ("a", 2, "d2")).collect()))
    assert sorted(map(str, kt.read().collect())) == want
    assert rows(kt.read(F.col("dt") == "d2")) == [("a", 2, "d2")]
    assert [tuple(r) for r in kt.read(F.col("dt") == "d1").collect()] == [(None, 2, "d1")]
    kt.compact()
    assert sorted(map(str, kt.read().collect())) == want


def test_keyed_table_last_write_of_a_batch_wins_by_arrival(spark):
    kt, frame = _keyed(spark, "keyed-arrival")
    images = frame(("a", 9, "d1"), ("a", 2, "d1")).withColumn("offset", F.when(F.col("v") == 2, 5).otherwise(4))
    kt.upsert(images, 0, arrival=("offset",))
    assert rows(kt.read()) == [("a", 2, "d1")]


def test_keyed_table_base_files_follow_bytes(spark):
    """Hundreds of dates make one file; a date's rows are found by statistics."""
    kt, frame = _keyed(spark, "keyed-files")
    kt.upsert(frame(*[(f"k{k}", k, f"d{k % 300:03d}") for k in range(900)]), 0)
    kt.compact()
    assert len(kt.read().inputFiles()) == 1
    assert sorted(r[0] for r in rows(kt.read(F.col("dt") == "d007"))) == ["k307", "k607", "k7"]


def test_keyed_lookup_equals_read(spark, monkeypatch):
    """Base and log, few keys and more than may be broadcast, with and without buckets."""
    from tidemark.operators import keyed
    for buckets, most in ((0, 1 << 20), (8, 1 << 20), (8, 1)):
        monkeypatch.setattr(keyed, "LOOKUP_KEYS", most)
        kt, frame = _keyed(spark, "keyed-lookup", buckets=buckets)
        keys = frame(*[(k, 0, "") for k in ("k3", "k3", "k50", "new", "none", None)])
        assert rows(kt.lookup(keys)) == []
        kt.upsert(frame(*[(f"k{k}", k, "d") for k in range(100)]), 0)
        assert rows(kt.lookup(keys)) == [("k3", 3, "d"), ("k50", 50, "d")]
        kt.compact()
        assert rows(kt.lookup(keys)) == [("k3", 3, "d"), ("k50", 50, "d")]
        kt.upsert(frame(("k50", 51, "e"), ("new", 1, "e"), (None, 2, "e"), ("k9", 10, "e")), 1)
        assert rows(kt.lookup(keys)) == [("k3", 3, "d"), ("k50", 51, "e"), ("new", 1, "e")]
        kt.compact()
        assert rows(kt.lookup(keys)) == [("k3", 3, "d"), ("k50", 51, "e"), ("new", 1, "e")]
        assert rows(kt.lookup(keys.limit(0))) == []


def test_log_routing_rejects_malformed_lines(spark):
    from tidemark.operators.parse import rejected
    raw = spark.createDataFrame([("{bad", 5), ('{"mid":"m"}', 6), ("", 7), ("[1,2]", 8), (None, 9)],
                                "value string, arrival_ms long")
    assert rows(FE.log_route(raw)) == [("gmall_event", '{"mid":"m","ts":6}', "1970-01-01")]
    assert rows(rejected(FE.log_lines(raw))) == [("",), ("",), ("[1,2]",), ("{bad",)]


def _lines(spark, name, *lines):
    path = run_dir(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(path)
    return path


def test_json_schema_merges_between_lines_and_loads(spark):
    from tidemark.sources import json_files as JF
    one = _lines(spark, "json-1", '{"id":1,"n":5,"f":1,"s":"a","o":{"x":1},"l":[1]}', '{"id":2,"f":1.5,"z":null}', '{bad', '{"s":"no key"}')
    known = JF.infer_schema(spark, one)
    two = _lines(spark, "json-2", '{"id":"k3","n":2.5,"s":7,"o":{"y":"t"},"l":["b"],"new":true}')
    merged = JF.infer_schema(spark, two, known)
    types = {f.name: f.dataType.simpleString() for f in merged.fields}
    assert types == {"id": "string", "n": "double", "f": "double", "s": "string", "o": "struct<x:bigint,y:string>",
                     "l": "array<string>", "z": types["z"], "new": "boolean"}
    recs = JF.read_json(spark, one, known=known)
    assert rows(JF.keyed_rows(recs, "id"), "id", "n", "f") == [(1, 5, 1.0), (2, None, 1.5)]
    assert sorted((r["reason"], r["value"]) for r in JF.rejects(recs, "id").collect()) == [
        ("no key", '{"s":"no key"}'), ("not JSON", "{bad")]


def test_cell_table_versions_gets_and_replays(spark):
    from tidemark.operators.celltable import CellTable
    table = CellTable(spark, run_dir(spark, "celltable"), buckets=4)
    one = _lines(spark, "cells-1", '{"id":10,"name":"b","o":{"x":1}}', '{"id":2,"name":"a","f":1.50}', '{"id":2,"name":"a2"}', "{bad", '{"name":"x"}')
    known = table.load_json(one, 0)
    assert rows(table.scan(), "rowkey", "qualifier", "value") == [
        ("10", "name", "b"), ("10", "o", '{"x":1}'), ("2", "f", "1.5"), ("2", "name", "a2")]
    table.compact()
    two = _lines(spark, "cells-2", '{"id":2,"name":"c","extra":true}')
    table.load_json(two, 1, known=known)
    table.load_json(two, 1, known=known)          # replay
    assert rows(table.scan("2"), "rowkey", "qualifier", "version", "value") == [
        ("2", "extra", 1, "true"), ("2", "f", 0, "1.5"), ("2", "name", 1, "c")]
    keys = spark.createDataFrame([("2",), ("none",), (None,)], "rowkey string")
    assert rows(table.get(keys, versions=2).where("qualifier = 'name'"), "version", "value") == [(0, "a2"), (1, "c")]
    assert rows(table.get(keys), "qualifier", "value") == [("extra", "true"), ("f", "1.5"), ("name", "c")]
    assert rows(table.scan("1", "2"), "rowkey", "value") == [("10", "b"), ("10", '{"x":1}')]
    table.compact()
    got = table.get(keys)
    assert rows(got, "qualifier", "value") == [("extra", "true"), ("f", "1.5"), ("name", "c")]
    assert len({f.split("bucket=")[1][0] for f in got.inputFiles()}) <= 2


def test_puts_do_not_shuffle_and_failures_fail_the_job(spark):
    import pytest
    from tidemark.operators.celltable import CellTable
    table = CellTable(spark, run_dir(spark, "celltable-fail"))
    cells = spark.range(20, numPartitions=3).select(
        F.col("id").cast("string").alias("rowkey"), F.lit("f").alias("family"), F.lit("q").alias("qualifier"), F.lit("v").alias("value"))
    table.put(cells, 0)
    assert len(table.table.read().inputFiles()) == 3          # one list for each partition
    bad = cells.withColumn("value", F.expr("CASE WHEN rowkey = '19' THEN raise_error('x') ELSE 'w' END"))
    with pytest.raises(Exception):
        table.put(bad, 1)
    assert table.scan().where("value = 'v'").count() == 20    # nothing of the failed batch is seen


def test_keyed_last_rows_equal_the_aggregate_and_unique_rows_are_not_dealt(spark, monkeypatch):
    from tidemark.operators import keyed
    monkeypatch.setattr(keyed, "PLAIN_BYTES", 0)
    for most in (1 << 20, 1):
        monkeypatch.setattr(keyed, "LOOKUP_KEYS", most)
        kt, frame = _keyed(spark, "keyed-last")
        df = frame(("a", 1, "d"), ("a", 2, "d"), ("b", 1, "e"), (None, 3, "f"), (None, 4, "f"), ("c", 5, None), ("c", 5, None))
        assert rows(kt.last_rows(df).na.fill("-")) == rows(kt._latest(df, []).na.fill("-"))
        kt.upsert(df, 0)
        kt.upsert(frame(("b", 9, "x"), ("new", 1, "y")), 1)
        assert rows(kt.read().na.fill("-")) == [("-", 4, "f"), ("a", 2, "d"), ("b", 9, "x"), ("c", 5, "-"), ("new", 1, "y")]
    unique = kt.last_rows(frame(("a", 1, "d"), ("b", 1, "e")))
    assert "Exchange" not in unique._jdf.queryExecution().executedPlan().toString()


def test_keyed_fresh_batch_is_checked_again_after_a_replay(spark):
    kt, frame = _keyed(spark, "keyed-fresh")
    kt.upsert(frame(("a", 1, "d")), 0)
    kt.upsert(frame(("b", 2, "d")), 1, fresh=True)
    assert rows(kt.read()) == [("a", 1, "d"), ("b", 2, "d")]
    kt.upsert(frame(("a", 1, "d"), ("b", 1, "e")), 0)    # the replay holds a key of the later batch
    assert rows(kt.read()) == [("a", 1, "d"), ("b", 2, "d")]
    kt.compact()
    assert rows(kt.read()) == [("a", 1, "d"), ("b", 2, "d")]


def test_orders_of_the_change_log_meet_the_customers_once(spark):
    from tidemark.sources import adapters as AD
    from tidemark.sources.tables import tables
    changes = AD.cdc_changes(tables(spark, "/root/testdata/sf0.001"))
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("c_nationkey#") > 0 and plan.count("Join LeftOuter, (o_custkey") == 1
