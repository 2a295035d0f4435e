"""Exact top-k search by inner product: exhaustive, a term at a time.

Components are turned into the integers floor(64 * x). A component's place is a
term; a block of rows holds a posting list (rows, weights) for each term. Query
rows walk the terms that they hold and add their weight times each posting's
into a dense array of scores, candidates by queries; a list held by most of its
block is added whole, a shorter one is scattered to its rows. A partial
selection keeps each query's best of a block, and merges keep the best of all.

Queries are a stated set (ids divisible by ``every``), compared with all rows in
blocks. The grid of cells (query row, candidate column) has a query row for each
QUERY_CELL queries or VALUE_CELL values, and as many columns as fill the cluster.
A task holds one cell's queries and streams the candidates past them; a second
exchange brings each query block's partial results together, and merges them as
they stream by. Nothing is broadcast, and memory grows with neither side.

Defined results. A vector that is null, or holds a null, NaN or infinite
component, takes no part. Components that a shorter vector lacks count 0, so an
empty vector scores 0 with all. A row without an id is a candidate, after all
others of its score, and no query. Rows that share an id are rows of their own: a query
leaves out its own row only. Ties go to the smaller id. A score beyond a long
stays at the long's end. No rows give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, n_ranges

#: Queries, and their values, that one task holds at most, about.
QUERY_CELL, VALUE_CELL = 1 << 14, 1 << 22
#: Candidates that a block is filled up to; queries come in blocks of an Arrow batch.
CANDIDATE_BLOCK = 1024
LONG_END = (1 << 63) - 1
#: Kinds of packed values: their type by the largest one; beyond, the components themselves.
KINDS = ((15, np.int16), (31, np.int32), (62, np.int64))

PACKED = "a int, b int, kind int, ids binary, missing binary, sizes binary, data binary"
PARTIAL = "a int, b int, ids binary, own binary, top_ids binary, top_missing binary, top_scores binary"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


# ------------------------------------------------------------------ packed rows

def weights(x: np.ndarray) -> tuple[int, np.ndarray]:
    """Kind and array of floor(64 * x); the last kind keeps ``x``."""
    with np.errstate(over="ignore"):
        y = np.floor(x * 64.0)
    most = float(np.abs(y).max(initial=0.0))
    for kind, (bits, dtype) in enumerate(KINDS):
        if most < 2.0 ** bits:
            return kind, y.astype(dtype)
    return len(KINDS), x


def unpacked(kind: int, data: bytes) -> np.ndarray:
    """Integers: of 64 bits, or Python's own where they don't fit."""
    if kind < len(KINDS):
        return np.frombuffer(data, KINDS[kind][1]).astype(np.int64)
    x = np.frombuffer(data, np.float64).tolist()
    return np.array([int(v) * 64 if abs(v) >= 2.0 ** 53 else int(np.floor(v * 64.0)) for v in x], object)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A packed row for each batch of (vec_id, v), named by task and number in it."""
    task, schema = TaskContext.get().partitionId(), None
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        ids, v = batch.column("vec_id"), batch.column("v")
        kind, data = weights(v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        schema = schema or pa.schema([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()),
                                      ("missing", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary())])
        yield pa.RecordBatch.from_pylist([{
            "a": task, "b": number, "kind": kind, "data": data.tobytes(),
            "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
            "missing": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
            "sizes": v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32).tobytes()}], schema=schema)


class Rows:
    """Rows in order of id (those without one last), with a posting list for each term."""

    def __init__(self, packs: list[dict]):
        read = lambda name, dtype: np.concatenate([np.frombuffer(p[name], dtype) for p in packs])
        self.ids, self.missing, sizes = read("ids", np.int64), read("missing", np.bool_), read("sizes", np.int32)
        values = np.concatenate([unpacked(p["kind"], p["data"]) for p in packs])
        self.n, self.order = len(self.ids), np.lexsort((self.ids, self.missing))
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        row = np.repeat(place, sizes)
        term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.ids, self.missing = self.ids[self.order], self.missing[self.order]
        held = np.flatnonzero(values != 0)
        held = held[np.lexsort((row[held], term[held]))]
        self.rows, self.weights, term = row[held], values[held], term[held]
        self.most = int(max(map(abs, self.weights.tolist()), default=0)) if self.weights.dtype == object else int(np.abs(self.weights).max(initial=0))
        self.terms, at = np.unique(term, return_index=True)
        self.lists = {t: slice(i, j) for t, i, j in zip(self.terms.tolist(), at.tolist(), [*at[1:].tolist(), len(term)])}

    def own(self) -> np.ndarray:
        """Each row's score with itself."""
        w = self.weights if self.most ** 2 * max(1, len(self.terms)) < 1 << 62 else self.weights.astype(object)
        out = np.zeros(self.n, w.dtype)
        np.add.at(out, self.rows, w * w)
        return np.minimum(out, LONG_END).astype(np.int64)

    def posting(self, t: int, dtype, dense: bool) -> tuple[np.ndarray | None, np.ndarray]:
        """Rows and weights of a term; no rows if the weights are those of all, in order."""
        rows, w = self.rows[self.lists[t]], self.weights[self.lists[t]].astype(dtype)
        if dense or 2 * len(rows) > self.n:
            full = np.zeros(self.n, dtype)
            full[rows] = w
            return None, full
        return rows, w


def scores(candidates: Rows, queries: Rows) -> np.ndarray:
    """Inner products, candidates by queries, gathered a term at a time."""
    terms = [t for t in queries.lists if t in candidates.lists]
    bound = candidates.most * queries.most * len(terms)
    dtype = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 62 else object
    out = np.zeros((candidates.n, queries.n), dtype)
    product = np.empty_like(out)
    for t in terms:
        cols, qw = queries.posting(t, dtype, False)
        rows, cw = candidates.posting(t, dtype, False)
        if cols is not None:
            out[np.ix_(np.arange(candidates.n) if rows is None else rows, cols)] += np.multiply.outer(cw, qw)
        elif rows is not None:
            out[rows] += np.multiply.outer(cw, qw)
        else:
            np.multiply.outer(cw, qw, out=product)
            out += product
    return np.clip(out, -LONG_END, LONG_END).astype(np.int64) if dtype is object else out


# ------------------------------------------------------------------ selection

class Best:
    """The best ``k`` of what each query was compared with so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.ids, self.missing, self.scores = np.zeros((n, 0), np.int64), np.zeros((n, 0), np.bool_), np.zeros((n, 0), np.int64)

    def add(self, ids: np.ndarray, missing: np.ndarray, got: np.ndarray) -> None:
        """Merge entries: arrays of queries by entries."""
        ids, missing = np.concatenate([self.ids, ids], axis=1), np.concatenate([self.missing, missing], axis=1)
        got = np.concatenate([self.scores, got], axis=1)
        order = np.lexsort((ids, missing, -got), axis=1)[:, :self.k]
        self.ids, self.missing, self.scores = (np.take_along_axis(x, order, axis=1) for x in (ids, missing, got))

    def compare(self, candidates: Rows, queries: Rows) -> None:
        by_query = np.ascontiguousarray(scores(candidates, queries).T)
        n, k = candidates.n, self.k
        at = np.broadcast_to(np.arange(n), by_query.shape)
        if n > k and by_query.dtype == np.int32:  # a key without ties: score, then the smaller place
            keys = by_query.astype(np.int64) * n + (n - 1 - at)
            at = np.argpartition(keys, n - k, axis=1)[:, n - k:]
            by_query = np.take_along_axis(by_query, at, axis=1)
        self.add(candidates.ids[at], candidates.missing[at], by_query.astype(np.int64))


def scored(k: int):
    """Cells in order, each one's query packs before its candidate packs -> partial results of each query pack."""
    def close(cell):
        for pack_of, queries, best in cell:
            yield {"a": pack_of["a"], "b": pack_of["b"], "ids": queries.ids.tobytes(),
                   "own": queries.own().tobytes(),
                   "top_ids": best.ids.tobytes(), "top_missing": best.missing.tobytes(), "top_scores": best.scores.tobytes()}

    def compare(cell, waiting):
        if waiting and cell:
            candidates = Rows(waiting)
            for _, queries, best in cell:
                best.compare(candidates, queries)
        waiting.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), *((c, pa.binary()) for c in ("ids", "own", "top_ids", "top_missing", "top_scores"))])
        at, cell, waiting, n = None, [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != at:
                    compare(cell, waiting)
                    yield from (pa.RecordBatch.from_pylist([x], schema=schema) for x in close(cell))
                    at, cell, n = row["cell"], [], 0
                if row["side"] == 0:
                    queries = Rows([row])
                    cell.append((row, queries, Best(queries.n, k)))
                    continue
                waiting.append(row)
                n += len(row["ids"]) // 8
                if n >= CANDIDATE_BLOCK:
                    compare(cell, waiting)
                    n = 0
        compare(cell, waiting)
        yield from (pa.RecordBatch.from_pylist([x], schema=schema) for x in close(cell))

    return run


def merged(k: int):
    """Partial results in order of query pack -> ranked rows, the query's own row left out."""
    def ranked(ids, own, best):
        for q, query_id in enumerate(ids.tolist()):
            mine = np.flatnonzero((best.ids[q] == query_id) & ~best.missing[q] & (best.scores[q] == own[q]))[:1]
            top = np.delete(np.arange(best.ids.shape[1]), mine)[:k]
            yield pa.table({"query_id": np.full(len(top), query_id, np.int64), "rank": np.arange(1, len(top) + 1, dtype=np.int32),
                            "vec_id": pa.array(best.ids[q][top], mask=best.missing[q][top]), "score": best.scores[q][top]})

    def close(ids, own, best):
        got = pa.concat_tables(ranked(ids, own, best)).combine_chunks()
        return got.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, own, best = None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["a"], row["b"]) != at:
                    if at is not None:
                        yield from close(ids, own, best)
                    at, ids, own = (row["a"], row["b"]), np.frombuffer(row["ids"], np.int64), np.frombuffer(row["own"], np.int64)
                    best = Best(len(ids), k + 1)
                best.add(*(np.frombuffer(row[c], d).reshape(len(ids), -1) for c, d in (
                    ("top_ids", np.int64), ("top_missing", np.bool_), ("top_scores", np.int64))))
        if at is not None:
            yield from close(ids, own, best)

    return run


# ------------------------------------------------------------------ the search

def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id bigint, v array<double>): the rows that take part."""
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))


def search(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id is divisible by ``every``."""
    spark = df.sparkSession
    arrow_batches(spark)
    rows = vectors(df, id_col, vector_col)
    asked = F.col("vec_id") % every == 0
    asking = rows.where(asked).agg(F.count("*").alias("n"), F.sum(F.size("v")).alias("size")).first()
    lines = max(1, -(-asking["n"] // QUERY_CELL), -(-(asking["size"] or 0) // VALUE_CELL))
    columns = max(1, -(-2 * n_ranges(spark) // lines))

    def side(number: int, packs: DataFrame) -> DataFrame:
        mine = F.pmod(F.xxhash64("a", "b"), F.lit(columns if number else lines)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit((lines if number else columns) - 1)))
        cell = (F.col("other") * columns + F.col("mine")) if number else (F.col("mine") * columns + F.col("other"))
        return packs.withColumns({"mine": mine}).select("*", other.alias("other")).select(
            cell.alias("cell"), F.lit(number).alias("side"), "a", "b", "kind", "ids", "missing", "sizes", "data")

    grid = side(0, rows.where(asked).mapInArrow(pack, PACKED)).unionByName(side(1, rows.mapInArrow(pack, PACKED)))
    partial = (grid.repartition(n_ranges(spark), "cell").sortWithinPartitions("cell", "side", "a", "b")
               .mapInArrow(scored(k + 1), PARTIAL))
    return (partial.repartition(n_ranges(spark), "a", "b").sortWithinPartitions("a", "b")
            .mapInArrow(merged(k), RESULT))
