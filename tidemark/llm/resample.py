"""Importance resampling towards a target distribution, with exact ranks.

A text's features are its runs of one to three words, hashed into buckets.
Buckets are counted over all raw texts and all target texts, and a bucket's gain
is the logarithm of their ratio. A text's weight is the sum of its features'
gains, taken from an array of gains; noise of a Gumbel distribution, a hash of the id,
makes the highest scores a sample without replacement.

CRC-32 is linear, so the checksum of a run of words follows from its words' checksums by
a table of shifts: a batch of texts is hashed by array operations, a word at a
time instead of a feature at a time.

Ranks come from parallel sorting by regular sampling. Each task sorts its run of
rows; each run gives regular samples, and these give splitters. A run's segments
between splitters are counted before they move; prefix sums of the counts give
each segment's first rank. Segments are exchanged and merged, and a row's
rank is its segment's first plus its place. Segments beyond the last rank asked
for stay where they are. Rows are told apart by run and place after score and
id, so rows that are equal in both are split between segments as any others.

What reaches the driver is bounded: two counts of BUCKETS numbers, SAMPLES samples at
most (two of each run at least), and a number for each segment.

Defined results. A null text has no words; its weight is 0. A null id is hashed as
empty and ranks after all ids of its score. Rows that repeat an id are rows of their own; equal
ones rank in any order. An empty table gives no rows, an empty target T = t = 0.
Other columns are not read.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches, n_ranges, narrow, slices, utf8, written

BUCKETS, LONGEST = 10_000, 3
#: Samples of all runs together, about.
SAMPLES = 1 << 18
#: Words of up to so many bytes are hashed by arrays, longer ones one by one.
SHORT = 48


# ------------------------------------------------------------------ features

@lru_cache(1)
def crc_table() -> np.ndarray:
    """Checksum register after a byte, by its lowest byte before."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


@lru_cache(1)
def shifts() -> np.ndarray:
    """(SHORT + 2, 4, 256): what each byte of a register becomes when n zero bytes follow."""
    t, out = crc_table(), np.empty((SHORT + 2, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, SHORT + 2):
        out[n] = (out[n - 1] >> np.uint32(8)) ^ t[out[n - 1] & np.uint32(0xFF)]
    return out


def times(steps: list[int], v: int) -> int:
    """A linear map of registers, as the images of its 32 bits, applied to one."""
    out = 0
    for bit in range(32):
        if v >> bit & 1:
            out ^= steps[bit]
    return out


def shift_long(v: int, n: int) -> int:
    """The register ``v`` after ``n`` zero bytes, by squaring."""
    step = [int(shifts()[1, bit // 8, 1 << bit % 8]) for bit in range(32)]
    while n:
        if n & 1:
            v = times(step, v)
        step, n = [times(step, x) for x in step], n >> 1
    return v


def shifted(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each register after as many zero bytes as its size says."""
    t = shifts()
    short = np.minimum(sizes, SHORT + 1)
    out = t[short, 0, crc & 0xFF] ^ t[short, 1, (crc >> np.uint32(8)) & 0xFF] ^ t[short, 2, (crc >> np.uint32(16)) & 0xFF] ^ t[short, 3, crc >> np.uint32(24)]
    for k in np.flatnonzero(sizes > SHORT + 1).tolist():
        out[k] = shift_long(int(crc[k]), int(sizes[k]))
    return out


IN_WORD = np.ones(256, bool)
IN_WORD[:128] = [chr(b).isdigit() or "a" <= chr(b) <= "z" for b in range(128)]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksums and sizes of the lower-cased words of texts, and each text's first word's number."""
    data = LOWER[data]
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = IN_WORD[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begin[edges] = inside[edges]  # words don't cross texts
    starts = np.flatnonzero(begin)
    stop = ~inside
    stop[edges] = True
    stops = np.append(np.flatnonzero(stop), len(data))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    sizes = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    t = crc_table()
    at = np.flatnonzero(sizes <= SHORT)
    step = 0
    while len(at):
        crc[at] = (crc[at] >> np.uint32(8)) ^ t[(crc[at] ^ data[starts[at] + step]) & np.uint32(0xFF)]
        step += 1
        at = at[sizes[at] > step]
    crc ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(sizes > SHORT).tolist():
        crc[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes())
    return crc, sizes, np.searchsorted(starts, offsets)


def features(offsets: np.ndarray, data: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For runs of 1, 2, .. words: (buckets, number of the run's first word); and texts' first words' numbers."""
    crc, sizes, first = words(offsets, data)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    spaced = shifted(np.full(len(crc), zlib.crc32(b" "), np.uint32), sizes) ^ crc  # of a space and the word
    out, run, at = [], crc, np.arange(len(crc))
    for n in range(LONGEST):
        if n:
            ok = at + n < len(crc)
            run, at = run[ok], at[ok]
            ok = text[at + n] == text[at]
            run, at = run[ok], at[ok]
            run = shifted(run, sizes[at + n] + 1) ^ spaced[at + n]
        out.append((run % BUCKETS, at))
    return out, first


# ------------------------------------------------------------------ counts and weights

def bucket_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features in each bucket, over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch):
                for buckets, _ in features(*utf8(part.column("text")))[0]:
                    total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]})

    rows = (df.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
            .mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) of each bucket, smoothed by one feature a bucket."""
    all_raw, all_target = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(id_col: Column, salt: str) -> Column:
    """floor of 1000 times a Gumbel variate, from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0))).cast("bigint")


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", salt: str = "42") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got, first = features(*utf8(part.column("text")))
                n, weight = np.zeros(len(first) - 1, np.int64), np.zeros(len(first) - 1, np.int64)
                for buckets, at in got:
                    sums = np.concatenate([[0], np.cumsum(gain[buckets])])
                    cuts = np.searchsorted(at, first)
                    n += np.diff(cuts)
                    weight += np.diff(sums[cuts])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(first)), pa.array(n), pa.array(weight),
                     pa.array(weight + part.column("noise").to_numpy())],
                    names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = narrow(docs, id_col, text_col)
    return (rows.withColumn("noise", noise(F.col("doc_id"), salt))
            .mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"))


# ------------------------------------------------------------------ ranks by regular sampling

RUN = "run int, place bigint"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _with(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns.values())], names=[*batch.schema.names, *columns])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted run, with its number and their places."""
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield _with(batch, run=np.full(n, run, np.int32), place=np.arange(place, place + n))
        place += n


def _key(score, doc_id, run, place) -> tuple:
    return -score, doc_id is None, 0 if doc_id is None else doc_id, run, place


def ranked(rows: DataFrame, last: int | None = None) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, .. by score, downwards, then doc_id, upwards
    (both long; other columns come along); ranks over ``last`` are null."""
    spark, parts = rows.sparkSession, n_ranges(rows.sparkSession)
    arrow_batches(spark)
    ddl, down = _ddl(rows), (F.desc("score"), F.asc_nulls_last("doc_id"))
    runs = written(rows.sortWithinPartitions(*down).mapInArrow(_numbered, f"{ddl}, {RUN}"), "runs")
    sizes = runs.groupBy("run").agg(F.count("*").alias("size"))
    n_runs, n = sizes.agg(F.count("*"), F.sum("size")).first()
    if not n:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    # regular samples: about as many from each run, at even steps
    each = min(max(2, SAMPLES // n_runs), 4 * parts)
    step = F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("size") / each))
    samples = runs.join(sizes, "run").where(F.col("place") % step == F.floor(step / 2)).select("score", "doc_id", "run", "place")
    keys = sorted(_key(*r) for r in samples.collect())
    splitters = [keys[len(keys) * k // parts] for k in range(1, parts)]
    split_scores = np.array([k[0] for k in splitters], np.int64)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = -batch.column("score").to_numpy()
            seg = np.searchsorted(split_scores, score, side="left").astype(np.int32)
            tied = np.flatnonzero(seg != np.searchsorted(split_scores, score, side="right"))
            asked = batch.select(["score", "doc_id", "run", "place"]).take(pa.array(tied))
            for k, row in zip(tied.tolist(), asked.to_pylist()):
                seg[k] = bisect.bisect_right(splitters, _key(**row))
            yield _with(batch, segment=seg)

    segmented = runs.mapInArrow(segment, f"{ddl}, {RUN}, segment int")
    counts = {r["segment"]: r["n"] for r in segmented.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    starts = np.concatenate([[0], np.cumsum([counts.get(k, 0) for k in range(parts)])])
    last = n if last is None else last
    moving = int(np.searchsorted(starts, last))  # segments that begin before the last rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, done = -1, 0
        for batch in batches:
            seg = batch.column("segment").to_numpy()
            rank = np.empty(len(seg), np.int64)
            for k in np.unique(seg).tolist():
                here = np.flatnonzero(seg == k)
                at, done = (k, 0) if k != at else (at, done)
                rank[here] = starts[k] + done + np.arange(1, len(here) + 1)
                done += len(here)
            yield _with(batch.drop_columns(["run", "place", "segment"]), rank=pa.array(rank, mask=rank > last))

    moved = (segmented.where(F.col("segment") < moving).repartitionById(max(1, moving), "segment")
             .sortWithinPartitions("segment", *down, "run", "place").mapInArrow(place, f"{ddl}, rank bigint"))
    stay = segmented.where(F.col("segment") >= moving).select(*rows.columns, F.lit(None).cast("bigint").alias("rank"))
    return moved.unionByName(stay)


# ------------------------------------------------------------------ the sample

def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, id_col: str = "doc_id",
             text_col: str = "text", salt: str = "42") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs``. ``rank`` is
    set for the ``percent`` of rows with at least ``least_words`` words that are drawn."""
    arrow_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, text_col))
    rows = written(weighted(docs, gain, id_col, text_col, salt), "weights")
    long = rows.where(F.col("n_words") >= least_words)
    drawn = percent * long.count() // 100
    short = rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked(long, drawn).unionByName(short).select("doc_id", "n_features", "weight", "score", "rank")
