"""Helpers shared by the training-data operators.

Every operator reads a documents-like frame through :func:`narrow`, so extra
columns, also ones whose names clash with an operator's own, never reach it.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import run_dir

#: Rows and bytes of one Arrow batch at most (one row at least).
BATCH_ROWS, BATCH_BYTES = 512, 1 << 23
#: Bytes of text worked on at once inside a task.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id bigint, text string): the two columns an operator works on."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"))


#: Workers give large blocks back when freed, so that what one stage used does not add to the next one's.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "2097152", "MALLOC_TRIM_THRESHOLD_": "8388608", "MALLOC_ARENA_MAX": "2",
                 "ARROW_DEFAULT_MEMORY_POOL": "system"}


def arrow_batches(spark: SparkSession) -> None:
    """Bounds the rows and bytes of an Arrow batch and the rows that a scan
    decodes at once, so that long texts or packed arrays fit, and lets workers of this machine import the package from where the
    driver has it (a cluster's launcher ships it)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    spark.sparkContext.environment.update(WORKER_MEMORY)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Hand freed memory back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work):
    """``work`` over a task's Arrow batches; when it ends, its worker, which goes on to serve
    other tasks, gives back what it freed."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside give their shuffle files back when they end, not when the
    driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: lineage ends here, its
    shuffles are given back, and a lost executor costs no more than its running tasks."""
    path = run_dir(df.sparkSession, name)
    with spent_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, without copying; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive pieces of a batch of about SLICE_BYTES of text each (one row at least)."""
    if not batch.num_rows:
        return
    offsets, _ = utf8(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# ------------------------------------------------------------------ bitmaps

#: Bits of a broadcast bitmap: 16 MB, whatever the input.
FILTER_BITS = 27
#: Bits of one that is sized to what it holds, at most: 64 MB.
MOST_BITS = 29


def filter_bits(n: int) -> int:
    """Bits of a bitmap of n values: FILTER_BITS, for more values two for each of them, up to MOST_BITS."""
    return min(max(FILTER_BITS, (2 * n - 1).bit_length()), MOST_BITS)


def bitmap(values: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of the lowest ``bits`` bits of a column of longs (its only column).

    Its size is fixed (2**bits / 8 bytes), so it may be collected and
    broadcast at any scale; more values only mean more false positives.
    Executors build slices of 2**20 bits each from distinct positions.
    """
    name = values.columns[0]
    mask = (1 << bits) - 1
    step = min(bits, 20)

    def build(bits_set: pa.Table) -> pa.Table:
        packed = np.zeros((1 << step) // 8, np.uint8)
        low = bits_set.column("bit").to_numpy() & ((1 << step) - 1)
        np.bitwise_or.at(packed, low >> 3, (1 << (low & 7)).astype(np.uint8))
        return pa.table({"slice": bits_set.column("slice").slice(0, 1), "packed": pa.array([packed.tobytes()], pa.binary())})

    with spent_shuffles(values.sparkSession):
        got = (values.where(F.col(name).isNotNull())
               .select(F.col(name).bitwiseAND(F.lit(mask)).alias("bit")).distinct()
               .withColumn("slice", F.shiftrightunsigned("bit", step))
               .groupBy("slice").applyInArrow(build, "slice bigint, packed binary").collect())
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    size = (1 << step) // 8
    for row in got:
        out[row["slice"] * size:(row["slice"] + 1) * size] = np.frombuffer(row["packed"], np.uint8)
    return out


def in_bitmap(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each uint64 value's bit is set."""
    low = values.astype(np.uint64) & np.uint64(len(packed) * 8 - 1)
    return (packed[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1


# ------------------------------------------------------------------ hashes, counted in blobs

def hash_counts(blobs: DataFrame, least: int, bits: int = 32) -> DataFrame:
    """Hashes of so many bits that occur at least ``least`` times in packed arrays of them.

    ``blobs``: (range int, hashes binary) as :func:`to_ranges` gives them. Each
    range is put together in one task; ranges are as many as the caller made.
    """
    def count(blobs: pa.Table) -> pa.Table:
        column = blobs.column("hashes")
        sizes = pc.divide(pc.binary_length(column), _width(bits)).to_numpy()
        hashes, at = np.empty(int(sizes.sum()), _kind(bits)), 0
        for blob, size in zip(column, sizes.tolist()):
            hashes[at:at + size] = unpacked(blob.as_py(), bits)
            at += size
        hashes.sort()  # in place: a range is held once
        often = hashes[least - 1:] == hashes[:len(hashes) - least + 1]
        often[1:] &= hashes[1:len(often)] != hashes[:len(often) - 1]
        first = np.flatnonzero(often)
        values = hashes[first]
        return pa.table({"hash": values.astype(np.int64), "n": np.searchsorted(hashes, values, side="right") - first})

    return blobs.groupBy("range").applyInArrow(count, "hash bigint, n bigint")


def to_ranges(hashes: np.ndarray, ranges: int, bits: int = 32) -> Iterator[tuple[int, bytes]]:
    """Hashes of so many bits, sorted and cut into (range, packed array) pairs."""
    hashes = np.sort(hashes)
    cuts = np.searchsorted(hashes, np.array([(k << bits) // ranges for k in range(1, ranges)], hashes.dtype))
    for k, part in enumerate(np.split(hashes, cuts)):
        if len(part):
            yield k, packed(part, bits)


def _width(bits: int) -> int:
    return max(4, -(-bits // 8))


def _kind(bits: int) -> type:
    return np.uint32 if bits <= 32 else np.uint64


def packed(hashes: np.ndarray, bits: int = 32) -> bytes:
    """Sorted values of so many bits as differences, their lowest bytes first, then the
    next and so on: the high bytes are mostly 0, which Spark compresses away."""
    kind = np.dtype(_kind(bits)).newbyteorder("<")
    steps = np.diff(hashes.astype(kind), prepend=kind.type(0)).astype(kind)
    return steps.view(np.uint8).reshape(-1, kind.itemsize)[:, :_width(bits)].T.tobytes()


def unpacked(blob: bytes, bits: int = 32) -> np.ndarray:
    kind, planes = np.dtype(_kind(bits)).newbyteorder("<"), np.frombuffer(blob, np.uint8).reshape(_width(bits), -1)
    steps = np.zeros((planes.shape[1], kind.itemsize), np.uint8)
    steps[:, :len(planes)] = planes.T
    return np.cumsum(steps.view(kind).ravel(), dtype=kind.type)


def n_ranges(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sha_hex(column: Column) -> Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file: the folder in TOKENIZERS_DIR, else the installed files."""
    folder = os.environ.get("TOKENIZERS_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))
