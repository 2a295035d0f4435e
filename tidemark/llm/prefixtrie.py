"""Prefix trie of conversations: what their first turns have in common.

A node is a distinct sequence of first turns. It is named by its depth and by two
64-bit sums, modulo 2**64, of hashed (turn, place) pairs, so a path's keys are
prefix sums: tasks sum sorted runs of turns, and a run that continues a
conversation adds what the runs before it hold. No conversation, however long,
has to fit into one task. Afterwards a node is (conv_id, depth), its smallest member and depth.

Subtree totals come from parallel tree contraction. A round first compresses
every unary chain (nodes with one child left): pointers to the child are
doubled in joins until each points to its chain's end, and the end takes the
chain's place below its parent. Then it rakes: leaves are done, and their totals
go to their parents, summed before the exchange. Each round leaves at most half of the nodes,
and no node is ever joined with its children, however many they are. When all
are gone, the rounds are taken back: a chain's nodes get their end's total and
what lies between. Every round's tables are written to the shared folder.

The list of conversations that end at a node is hashed as a stream: ids in order,
node by node. A node whose ids cross a task's edge, or that has many, goes
on as text of CHUNK bytes at most a row, and a second pass hashes these in order. SHA-256 itself
can't be split, so one task reads all text of such a node.

Defined results. Turns come in order of turn, a null first, then role, then md5 of role
and text; repeated rows are turns of their own. A null role or text is empty. Rows
without a conv_id take no part; without any other rows there is no node, not
even a root. Remainders have the sign of the id, as in SQL. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, mix, n_ranges, written

#: Conversations of one family share their first one's first turns; the most turns so shared.
FAMILY, SHARED = 5, 8
#: Rows that a task of a round writes, about; bytes of ids held or shipped at once.
ROWS, CHUNK = 1 << 18, 1 << 20
EMPTY = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ prefix sums over sorted runs

def _with(batch: pa.RecordBatch, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns.values())], names=[*batch.schema.names, *columns])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def prefix_sums(df: DataFrame, group: str, order: list, names: list[str], values: Callable[[pa.RecordBatch], list[np.ndarray]]) -> DataFrame:
    """``df`` with running sums (modulo 2**64, as longs) of ``values`` within each ``group`` (a long), in ``order``.

    One row for each task reaches the driver: the groups at its run's edges.
    """
    parts = n_ranges(df.sparkSession)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, last, totals = TaskContext.get().partitionId(), 0, None, [np.uint64(0)] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(group).to_numpy()
            new = np.concatenate([[key[0] != last], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            sums = []
            for k, v in enumerate(values(batch)):
                c = np.cumsum(v.astype(np.uint64))
                sums.append(c - np.where(first >= 0, c[first] - v[first].astype(np.uint64), np.uint64(0) - totals[k:k + 1]))
            last, totals = key[-1], np.array([s[-1] for s in sums], np.uint64)
            yield _with(batch, {"part": np.full(n, part, np.int32), "place": np.arange(place, place + n),
                                **{c: s.view(np.int64) for c, s in zip(names, sums)}})
            place += n

    sums = ", ".join(f"{c} bigint" for c in names)
    rows = written(df.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
                   .mapInArrow(local, f"{_ddl(df)}, part int, place bigint, {sums}"), "prefix")
    edges = rows.groupBy("part").agg(F.min(F.struct("place", group)).alias("first"),
                                     F.max(F.struct("place", group, *names)).alias("last")).collect()
    carried, at, sofar = {}, None, None
    for e in sorted(edges, key=lambda e: e["part"]):
        here = np.array([e["last"][c] for c in names], np.int64).view(np.uint64)
        if at is not None and e["first"][group] == at:
            carried[e["part"]] = (at, sofar)
            here = here + sofar if e["last"][group] == at else here
        at, sofar = e["last"][group], here

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, key = batch.column("part").to_numpy(), batch.column(group).to_numpy()
            got = [batch.column(c).to_numpy().view(np.uint64).copy() for c in names]
            for p in np.unique(part).tolist():
                if p in carried:
                    mine = (part == p) & (key == carried[p][0])
                    for k, v in enumerate(got):
                        v[mine] += carried[p][1][k]
            yield _with(batch.drop_columns(["part", "place", *names]), {c: v.view(np.int64) for c, v in zip(names, got)})

    return rows.mapInArrow(carry, f"{_ddl(df)}, {sums}")


# ------------------------------------------------------------------ paths

def turns(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, mark, size, tie) of each turn; ``mark`` stands for role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return df.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("mark"),
        F.octet_length(text).cast("bigint").alias("size")).withColumn("tie", F.monotonically_increasing_id())


def rebuilt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n) of each conversation, and its rebuilt turns (conv_id, depth, mark, size, ends)."""
    own = prefix_sums(turns(df), "conv_id", [F.asc_nulls_first("turn"), "role", "mark", "tie"], ["pos"],
                      lambda batch: [np.ones(batch.num_rows, np.uint64)]).select("conv_id", "pos", "mark", "size")
    own = written(own, "turns")
    lengths = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    shape = lengths.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")).join(
        lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    lent = F.least("h", F.coalesce("base_n", F.lit(0)))
    shape = written(shape.select("conv_id", "base", "h", lent.alias("lent"),
                                 (lent + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n")), "shape")
    head = own.where(F.col("pos") <= SHARED).select(F.col("conv_id").alias("base"), "pos", "mark", "size")
    lent = head.join(shape, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "mark", "size", "n")
    kept = own.join(shape.withColumnRenamed("n", "total"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("lent") + F.col("pos") - F.col("h")).alias("depth"), "mark", "size", F.col("total").alias("n"))
    rows = lent.unionByName(kept).select("conv_id", "depth", "mark", "size", (F.col("depth") == F.col("n")).alias("ends"))
    return shape.select("conv_id", "n"), rows


def _lanes(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Two hashes of each turn at its place."""
    depth = batch.column("depth").to_numpy().astype(np.uint64)
    halves = np.array([bytes.fromhex(m) for m in batch.column("mark").to_pylist()], "S16").astype("S16")
    halves = np.frombuffer(halves.tobytes(), "<u8").reshape(-1, 2)
    return [mix(halves[:, k] ^ mix(depth * np.uint64(2) + np.uint64(k + 1))) for k in (0, 1)]


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, size, ends, a, b, pa, pb): each rebuilt turn's node and that node's parent."""
    summed = prefix_sums(rows, "conv_id", ["depth"], ["a", "b"], _lanes)

    def parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                up = [(batch.column(c).to_numpy().view(np.uint64) - v).view(np.int64) for c, v in zip("ab", _lanes(batch))]
                yield _with(batch.drop_columns(["mark"]), {"pa": up[0], "pb": up[1]})

    return summed.mapInArrow(parents, "conv_id bigint, depth bigint, size bigint, ends boolean, a bigint, b bigint, pa bigint, pb bigint")


# ------------------------------------------------------------------ nodes

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order of node -> (node, digest) of nodes inside the run, (node, part, seq, chunk) of the others."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()),
                        ("chunk", pa.binary()), ("ends_sha256", pa.string())])

    def row(node, seq, held, digest):
        text = b",".join(held)
        return dict(zip(("depth", "a", "b"), node), part=part, seq=seq, chunk=None if digest else text,
                    ends_sha256=hashlib.sha256(text).hexdigest() if digest else None)

    at, seq, held, size, first = None, 0, [], 0, True
    for batch in batches:
        out = []
        for node, i in zip(zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b"))), batch.column("conv_id").to_pylist()):
            if node != at:
                if at is not None:
                    out.append(row(at, seq, held, not first and not seq))
                    first = False
                at, seq, held, size = node, 0, [], 0
            elif size >= CHUNK:
                out.append(row(at, seq, held, False))
                seq, held, size = seq + 1, [], 0
            held.append(b"%d" % i)
            size += len(held[-1]) + 1
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if at is not None:
        yield pa.RecordBatch.from_pylist([row(at, seq, held, False)], schema=schema)


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order of node, part and seq -> (node, digest)."""
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
    at, state = None, None
    done = lambda: pa.RecordBatch.from_pylist([dict(zip(("depth", "a", "b"), at), ends_sha256=state.hexdigest())], schema=schema)
    for batch in batches:
        for r in batch.to_pylist():
            node = (r["depth"], r["a"], r["b"])
            if node == at:
                state.update(b",")
            else:
                if at is not None:
                    yield done()
                at, state = node, hashlib.sha256()
            state.update(r["chunk"])
    if at is not None:
        yield done()


def ends(members: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the digest of the sorted ids of ``members`` (depth, a, b, conv_id) of each node."""
    parts, node = n_ranges(members.sparkSession), ["depth", "a", "b"]
    got = written(members.repartitionByRange(parts, *node, "conv_id").sortWithinPartitions(*node, "conv_id")
                  .mapInArrow(_digests, "depth bigint, a bigint, b bigint, part int, seq int, chunk binary, ends_sha256 string"), "ends")
    across = (got.where("chunk is not null").repartition(parts, *node).sortWithinPartitions(*node, "part", "seq")
              .mapInArrow(_chunk_digests, "depth bigint, a bigint, b bigint, ends_sha256 string"))
    return got.where("chunk is null").select(*node, "ends_sha256").unionByName(across)


def nodes(df: DataFrame) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, ends_sha256, saved (its own)."""
    convs, rows = rebuilt(df)
    path = written(paths(rows), "paths")
    zero = F.lit(0).cast("bigint")
    key = ["depth", "a", "b"]
    inner = path.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                   F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id", "n_convs", zero.alias("size"),
        F.lit(None).cast("bigint").alias("pa"), F.lit(None).cast("bigint").alias("pb"))
    found = written(inner.unionByName(root), "nodes")
    children = found.where("pa is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("n_children"))
    members = path.where("ends").select(*key, "conv_id").unionByName(
        convs.where("n = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))
    known = found.join(children, key, "left").join(ends(members), key, "left")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return known.join(above, ["depth", "pa", "pb"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))


# ------------------------------------------------------------------ tree contraction

def followed(links: DataFrame, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links (c, d) -> (tc, td) with the sums on the way (dl, ds), doubled until each ends at a node without a link."""
    here = links.select(F.col("c").alias("tc"), F.col("d").alias("td"), F.lit(True).alias("open"))
    links = save(links.join(here, ["tc", "td"], "left").withColumn("open", F.coalesce("open", F.lit(False))), "links")
    while not links.where("open").isEmpty():
        on = links.select(F.col("c").alias("tc"), F.col("d").alias("td"), F.col("tc").alias("tc2"), F.col("td").alias("td2"),
                          F.col("dl").alias("dl2"), F.col("ds").alias("ds2"), F.col("open").alias("open2"))
        moved = links.where("open").join(on, ["tc", "td"]).withColumns(
            {"tc": F.col("tc2"), "td": F.col("td2"), "dl": F.col("dl") + F.col("dl2"), "ds": F.col("ds") + F.col("ds2"), "open": F.col("open2")})
        links = save(links.where("not open").unionByName(moved.select(*links.columns)), "links")
    return links


def subtree_totals(tree: DataFrame) -> DataFrame:
    """(c, d, l, s): the sums of l and s over each node's subtree; ``tree``: (c, d, pc, pd, l, s), a root's parent null."""
    tasks = max(tree.sparkSession.sparkContext.defaultParallelism, -(-tree.count() // ROWS))
    save = lambda df, name: written(df.coalesce(tasks), name)
    live = tree.select("c", "d", "pc", "pd", "l", "s", F.lit(0).cast("bigint").alias("el"), F.lit(0).cast("bigint").alias("es"))
    raked, chains, edge = [], [], ["el", "es"]
    while not live.isEmpty():
        below = live.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
            F.count("*").alias("k"), F.max(F.struct("c", "d", *edge)).alias("child"))
        now = save(live.join(below, ["c", "d"], "left").withColumn("k", F.coalesce("k", F.lit(0))), "live")
        # compress: a chain's end goes below the parent of the chain's top, and its edge holds the chain
        chain = followed(now.where("k = 1").select("c", "d", "pc", "pd", *edge, F.col("child.c").alias("tc"), F.col("child.d").alias("td"),
                                                   (F.col("l") + F.col("child.el")).alias("dl"), (F.col("s") + F.col("child.es")).alias("ds")), save)
        tops = chain.groupBy(F.col("tc").alias("c"), F.col("td").alias("d")).agg(F.min(F.struct(
            "d", "pc", "pd", (F.col("dl") + F.col("el")).alias("el"), (F.col("ds") + F.col("es")).alias("es"))).alias("top"))
        rest = now.where("k <> 1").join(tops, ["c", "d"], "left")
        rest = save(rest.select("c", "d", "l", "s", "k", *(
            F.when(F.col("top").isNotNull(), F.col(f"top.{c}")).otherwise(F.col(c)).alias(c) for c in ("pc", "pd", *edge))), "rest")
        # rake: leaves are done
        leaves = rest.where("k = 0")
        given = leaves.where("pc is not null").groupBy(F.col("pc").alias("c"), F.col("pd").alias("d")).agg(
            F.sum(F.col("l") + F.col("el")).alias("gl"), F.sum(F.col("s") + F.col("es")).alias("gs"))
        raked.append(leaves.select("c", "d", "l", "s"))
        chains.append(chain.select("c", "d", "tc", "td", "dl", "ds"))
        live = save(rest.where("k > 1").join(given, ["c", "d"], "left").select(
            "c", "d", "pc", "pd", (F.col("l") + F.coalesce("gl", F.lit(0))).alias("l"), (F.col("s") + F.coalesce("gs", F.lit(0))).alias("s"), *edge), "left")
    known = None
    for done, chain in zip(reversed(raked), reversed(chains)):
        known = done if known is None else known.unionByName(done)
        ended = known.select(F.col("c").alias("tc"), F.col("d").alias("td"), "l", "s")
        known = save(known.unionByName(chain.join(ended, ["tc", "td"]).select(
            "c", "d", (F.col("dl") + F.col("l")).alias("l"), (F.col("ds") + F.col("s")).alias("s"))), "known")
    return known if known is not None else tree.select("c", "d", "l", "s")


def trie(df: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    arrow_batches(df.sparkSession)
    found = written(nodes(df), "tree")
    totals = subtree_totals(found.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), (F.col("depth") - 1).alias("pd"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("l"), F.col("saved").alias("s")))
    return found.join(totals.select(F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("l").alias("n_leaves"),
                                    F.col("s").alias("saved_tokens")), ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
