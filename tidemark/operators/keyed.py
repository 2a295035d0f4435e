"""Keyed table: upserts by key without a table format (K2, K3, K6, K7, ST4).

Layout under ``path``::

    log/batch_id=<n>/attempt=<id>/*.parquet   one folder per write of a batch, rows
                                              sorted by (part, key) inside files
    base/upto=<n>/[bucket=<b>/]*.parquet      compacted image through batch n, in files
                                              of about FILE_BYTES, rows in order of
                                              (bucket, part, key) across files and inside

``upsert(df, batch_id)`` reduces the batch to its last row per key and writes
it to a new attempt folder, which counts once its ``_SUCCESS`` marker exists.
Of a batch's complete attempts the newest is read, so a replay replaces the
batch at one moment and a reader never sees half of it. A writer that has looked
up its keys and found none says so (``fresh``), and the attempt's name keeps it.

``read()`` returns, per key, the row of the highest batch id (then the highest
``order`` columns): rows of complete batches after the newest complete base
are reduced by an aggregate (``max`` of a struct led by the batch id, partial
aggregation before the shuffle); base rows (one per key already) are kept
unless their key was rewritten later. Whole rows travel for keys that are written more
than once only: a key whose hash (8 bytes, counted first) stands once is its own
last row, and of fresh batches nothing is counted. Null keys are keys, a null ``part`` is a
value like any other, and a key may move between ``part`` values: a ``where``
filter is applied to the base's scan, but to the log only after the last row
of each key is known.

``lookup(keys)`` returns the latest rows of some keys. A table with ``buckets``
keeps its base in a folder for each hash bucket of the key, and a lookup opens
the folders of its keys' buckets only; the base is never shuffled while the keys
are few enough to be broadcast (LOOKUP_KEYS, counted first).

``compact()`` writes the current image as a new base version, dealt by ranges of
(bucket, ``part``, key): the number of files follows the bytes, not the number of
``part`` values, and a filter on ``part`` skips row groups by their statistics.
It goes as far as the last batch below which every batch is
complete, so a batch in flight is never passed over. Readers switch to a
version once its ``_SUCCESS`` marker exists, so a failed compaction is
invisible. Superseded folders are left for a retention job.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a base file, about: what one task sorts.
FILE_BYTES = 32 << 20
#: Keys of one lookup that may be broadcast; more are joined by a shuffle.
LOOKUP_KEYS = 1 << 20
#: Bytes of a log that is read with one aggregate; of a larger one the repeated keys are counted first.
PLAIN_BYTES = 8 << 20
#: End of the name of an attempt whose keys no batch before it has.
FRESH = "-fresh"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (metadata only)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def written_at(spark: SparkSession, path: str) -> int | None:
    """When the folder's ``_SUCCESS`` marker was written; None without one."""
    p, fs = _fs(spark, f"{path}/_SUCCESS")
    return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None


def bytes_under(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (metadata only)."""
    p, fs = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def stamp(spark: SparkSession, path: str) -> tuple:
    """State of a file, or of the files directly in a folder: names, sizes and times."""
    p, fs = _fs(spark, path)
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def staged_batch(batch: DataFrame, path: str) -> DataFrame:
    """A micro-batch's rows, written once and read back; the next batch overwrites them.
    A frame that meets itself in a join is given new column ids, by which the cache does not
    find a streaming batch: cached rows would be made again, the stream's state included."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 key: list[str], order: list[str] | None = None, part: str | None = None,
                 buckets: int = 0, by: list[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = list(key)
        self.order = list(order or [])
        self.part = part
        self.buckets = int(buckets)
        self.by = list(by or key)     # the columns of the key that lookups give and buckets hash

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def _latest(self, df: DataFrame, lead: list[str]) -> DataFrame:
        cols = self.columns
        rest = [c for c in cols if c not in self.key and c not in self.order]
        packed = lead + self.order + rest
        if not packed:
            return df.select(*cols).dropDuplicates(self.key)
        m = F.max(F.struct(*[F.col(c) for c in packed]))
        return df.groupBy(*self.key).agg(m.alias("_m")).select(
            *self.key, *[F.col(f"_m.{c}").alias(c) for c in self.order + rest]).select(*cols)

    def last_rows(self, df: DataFrame, lead: tuple[str, ...] = ()) -> DataFrame:
        """The last row per key, as :meth:`_latest` gives it, but only rows whose
        key's hash stands more than once are dealt by key. One number reaches the
        driver: how many such hashes there are; if they are too many to be broadcast, all
        rows are dealt. ``df`` is read twice."""
        mark = F.xxhash64(*self.key)
        often = df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_mark")
        n = often.count()
        if n == 0:
            return df.select(*self.columns)
        if n > LOOKUP_KEYS:
            return self._latest(df, list(lead))
        marked, often = df.withColumn("_mark", mark), F.broadcast(often)
        once = marked.join(often, "_mark", "left_anti").select(*self.columns)
        return once.unionByName(self._latest(marked.join(often, "_mark", "left_semi"), list(lead)))

    # ------------------------------------------------------------- writing
    def upsert(self, df: DataFrame, batch_id: int, unique: bool = False,
               arrival: tuple[str, ...] = (), fresh: bool = False) -> None:
        """Write one batch. ``arrival`` names columns of ``df``, not stored, by
        which the last write of a key in the batch wins. ``unique=True`` when
        the batch already has one row per key (e.g. the update output of a
        streaming aggregation): its keys are not counted. ``fresh=True`` when a
        lookup has found none of its keys in the batches before. Cache ``df`` if it is dear."""
        out = df.select(*self.columns) if unique else self.last_rows(df, arrival)
        sort = ([self.part] if self.part else []) + self.key
        out.sortWithinPartitions(*sort).write.parquet(
            f"{self.path}/log/batch_id={int(batch_id)}/attempt={uuid.uuid4().hex}{FRESH if fresh else ''}")

    def foreach_batch(self, unique: bool = False):
        """A ``foreachBatch`` function writing each micro-batch as an upsert.
        The batch is cached first (staged, where its keys are counted), so counting it and the write do not
        run the streaming plan (and its state updates) twice; an empty
        micro-batch writes nothing."""
        def _write(batch_df: DataFrame, batch_id: int) -> None:
            if not unique:
                b = staged_batch(batch_df, f"{self.path}/batch")
                if b.count():
                    self.upsert(b, batch_id)
                return
            b = batch_df.persist()
            try:
                if b.count():      # all tasks at once; a probe would run the first one alone
                    self.upsert(b, batch_id, True)
            finally:
                b.unpersist()
        return _write

    # ------------------------------------------------------------- reading
    def _base(self, before: int | None = None) -> int | None:
        """The newest complete base version, of batches ``before`` one only if
        given (file-system metadata only)."""
        root = f"{self.path}/base"
        ups = sorted((int(n.split("=", 1)[1]) for n in list_children(self.spark, root)
                      if n.startswith("upto=")), reverse=True)
        ups = [n for n in ups if before is None or n < before]
        return next((n for n in ups if written_at(self.spark, f"{root}/upto={n}") is not None), None)

    def _batches(self, after: int | None) -> dict[int, str | None]:
        """Batches after a base version, each with its newest complete attempt (None: none yet)."""
        root, out = f"{self.path}/log", {}
        for name in list_children(self.spark, root):
            if not name.startswith("batch_id=") or after is not None and int(name.split("=", 1)[1]) <= after:
                continue
            done = [(at, a) for a in list_children(self.spark, f"{root}/{name}")
                    if (at := written_at(self.spark, f"{root}/{name}/{a}")) is not None]
            out[int(name.split("=", 1)[1])] = f"{root}/{name}/{max(done)[1]}" if done else None
        return out

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _read_base(self, upto: int, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a base version, of some buckets only if given."""
        root = f"{self.path}/base/upto={upto}"
        reader = self.spark.read.schema(self.schema)
        if buckets is None:
            return reader.parquet(root).select(*self.columns)
        there = set(list_children(self.spark, root))
        folders = [f"{root}/{name}" for b in sorted(buckets) if (name := f"bucket={b}") in there]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return reader.option("basePath", root).parquet(*folders).select(*self.columns)

    def _read_log(self, folders: list[str]) -> DataFrame:
        logged = T.StructType(list(self.schema.fields) + [T.StructField("batch_id", T.LongType())])
        return (self.spark.read.schema(logged).option("basePath", f"{self.path}/log").parquet(*folders)
                .select(*self.columns, "batch_id"))

    def _without(self, base: DataFrame, log: DataFrame) -> DataFrame:
        """Base rows whose key the log did not rewrite."""
        new = log.select(*[F.col(k).alias(f"_{k}") for k in self.key]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key])
        return base.join(new, same, "left_anti")

    def _all_fresh(self, full: int | None, folders: list[str]) -> bool:
        """Whether no key stands twice: each batch (a first one without a base aside) is fresh, and
        none before it was replayed since (file-system metadata only)."""
        rest = folders if full is not None else folders[1:]
        if not all(f.endswith(FRESH) for f in rest):
            return False
        times = [written_at(self.spark, f) for f in folders]
        return all(a <= b for a, b in zip(times, times[1:]))

    def _image(self, full: int | None, folders: list[str], where=None) -> DataFrame:
        base = None
        if full is not None:
            base = self._read_base(full)
            base = base if where is None else base.where(where)
        if not folders:
            return self.spark.createDataFrame([], self.schema) if base is None else base
        log, fresh = self._read_log(folders), self._all_fresh(full, folders)
        if fresh or len(folders) == 1:      # a batch has one row per key
            latest = log.select(*self.columns)
        elif sum(bytes_under(self.spark, f) for f in folders) <= PLAIN_BYTES:
            latest = self._latest(log, ["batch_id"])
        else:
            latest = self.last_rows(log, ("batch_id",))
        if base is not None and not fresh:
            base = self._without(base, log)
        latest = latest if where is None else latest.where(where)
        return latest if base is None else base.unionByName(latest)

    def read(self, where=None) -> DataFrame:
        """Latest row per key of complete batches, filtered by ``where``. Only
        the log (small between compactions) is aggregated; its keys are
        anti-joined away from the base (a broadcast when small)."""
        full = self._base()
        return self._image(full, [f for _, f in sorted(self._batches(full).items()) if f], where)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Latest rows of the keys in ``keys`` (a frame with the key columns, or those
        of ``by``; nulls find nothing), as of the batches ``before`` one if given. One row reaches
        the driver: the number of keys and their
        buckets. Of many keys, those that the table holds are found by its key
        columns first, and whole rows meet these only. Cache ``keys`` if it is dear, it is read several times."""
        full = self._base(before)
        folders = [f for n, f in sorted(self._batches(full).items()) if f and (before is None or n < before)]
        if full is None and not folders:
            return self.spark.createDataFrame([], self.schema)
        wanted = keys.select(*self.by).dropna().distinct()
        asked = [F.count(F.lit(1)).alias("n")]
        if self.buckets:
            asked.append(F.collect_set(self._bucket()).alias("buckets"))   # at most ``buckets`` numbers
        found = wanted.agg(*asked).first()
        buckets = found["buckets"] if self.buckets else None
        if found["n"] > LOOKUP_KEYS:
            theirs = [self._read_log(folders).select(*self.by)] if folders else []
            theirs += [self._read_base(full, buckets).select(*self.by)] if full is not None else []
            held = reduce(DataFrame.unionByName, theirs).join(wanted, self.by, "left_semi").distinct()
            n = held.count()
            if n == 0:
                return self.spark.createDataFrame([], self.schema)
            if n <= LOOKUP_KEYS:
                wanted = F.broadcast(held)
        elif found["n"]:
            wanted = F.broadcast(wanted)
        else:
            return self.spark.createDataFrame([], self.schema)
        out = self.spark.createDataFrame([], self.schema)
        log = self._read_log(folders).join(wanted, self.by, "left_semi") if folders else None
        fresh = self._all_fresh(full, folders)
        if full is not None:
            base = self._read_base(full, buckets).join(wanted, self.by, "left_semi")
            out = base if log is None or fresh else self._without(base, log)
        if log is None:
            return out.select(*self.columns)
        latest = log.select(*self.columns) if fresh or len(folders) == 1 else self._latest(log, ["batch_id"])
        return latest if full is None else out.select(*self.columns).unionByName(latest)

    def compact(self) -> int | None:
        """Write the image through the last batch below which all are complete
        as base version ``upto=<that batch>``; returns the newest version."""
        full = self._base()
        upto, folders = full, []
        for n, folder in sorted(self._batches(full).items()):
            if folder is None:
                break
            upto = n
            folders.append(folder)
        if not folders:
            return full
        size = sum(bytes_under(self.spark, f) for f in folders)
        size += bytes_under(self.spark, f"{self.path}/base/upto={full}") if full is not None else 0
        image = self._image(full, folders)
        order = ([self.part] if self.part else []) + self.key
        if self.buckets:
            image, order = image.withColumn("bucket", self._bucket()), ["bucket", *order]
        files = max(1, -(-size // FILE_BYTES))
        image = image.repartitionByRange(files, *order) if files > 1 else image.repartition(1)
        w = image.sortWithinPartitions(*order).write.mode("overwrite")
        if self.buckets:
            w = w.partitionBy("bucket")
        w.parquet(f"{self.path}/base/upto={upto}")
        return upto
