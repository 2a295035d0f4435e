"""A kept search index over sale rows: documents, postings, statistics.

Three keyed tables under one path, written batch by batch::

    docs/      the sale rows, one for each order_detail_id, in order of date
    postings/  (dt, term, order_detail_id) -> how often the term stands in the
               row's name (0: no longer), and the name's length
    stats/     term -> number of rows that hold it; two rows that no term can
               name: all rows, and those that have a name with their lengths' sum

``upsert`` compares a batch's rows with their images before it (a lookup by key)
and moves the statistics by the difference, so a row that changes its name or
date, or is sent again, counts once. A batch that is written again starts from the
same images and replaces itself; the statistics come first and the documents
last, so a batch that stops half way is made whole by its replay.

A search reads the postings of its terms and date, a few rows of the
statistics, and the date's documents if rows are asked for. The tables are ordered by
(date, term) and by term, so files and row groups of other dates and terms are
skipped by their statistics. Scores take the statistics as a scalar subquery: no job
runs while the plan is built.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import query_terms, tokens
from tidemark.operators.keyed import LOOKUP_KEYS, KeyedTable
from tidemark.operators.search import BM25_B, BM25_K1
from tidemark.schemas import SALE_ROW

ID = "order_detail_id"
POSTING = T.StructType([T.StructField("term", T.StringType()), T.StructField(ID, T.StringType()),
                        T.StructField("dt", T.StringType()), T.StructField("tf", T.IntegerType()),
                        T.StructField("dl", T.IntegerType())])
STATISTIC = T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType()),
                          T.StructField("total", T.LongType())])
ALL, NAMED = "", " "   # the statistics' rows of all documents and of those with a name; no term is blank


def postings_of(rows: DataFrame, field: str) -> DataFrame:
    """(term, id, dt, tf, dl): one row for each distinct term of each row's ``field``.
    ``rows`` has one row per id; a name's terms are counted inside its row, nothing is dealt."""
    return (rows.select(ID, "dt", F.coalesce(tokens(field), F.array().cast("array<string>")).alias("_t"))
            .select(ID, "dt", "_t", F.size("_t").alias("dl"), F.explode(F.array_distinct("_t")).alias("term"))
            .select("term", ID, "dt", (F.col("dl") - F.size(F.array_remove("_t", F.col("term")))).alias("tf"), "dl"))


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str, field: str = "sku_name", buckets: int = 0):
        root = path.rstrip("/")
        self.spark, self.field, self.path = spark, field, root
        self.docs = KeyedTable(spark, f"{root}/docs", SALE_ROW, [ID], part="dt", buckets=buckets)
        self.postings = KeyedTable(spark, f"{root}/postings", POSTING, ["term", ID], part="dt")
        self.stats = KeyedTable(spark, f"{root}/stats", STATISTIC, ["term"])

    # ------------------------------------------------------------- upkeep
    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """Write one batch of sale rows; a batch that a base already holds is ignored. Cache ``df`` if it is dear."""
        base = self.docs._base()
        if base is not None and base >= batch_id:
            return
        new = self.docs.last_rows(df).persist()
        try:
            old = self.docs.lookup(new.select(ID), before=batch_id).persist()
            try:
                self._write(new, old, batch_id)
            finally:
                old.unpersist()
        finally:
            new.unpersist()

    def _write(self, new: DataFrame, old: DataFrame, batch_id: int) -> None:
        """Statistics, postings, documents; where there are no images before, nothing is met with them."""
        n_old = old.count()
        now = postings_of(new, self.field)
        moved, rows = self._moved(new, now, 1), now
        if n_old:
            was = postings_of(old, self.field)
            moved = moved.unionByName(self._moved(old, was, -1))
            mine = new.select(ID, F.col("dt").alias("_dt"), tokens(self.field).alias("_now"))
            gone = mine.join(F.broadcast(was) if n_old <= LOOKUP_KEYS else was, ID).where(
                ~F.coalesce(F.array_contains("_now", F.col("term")), F.lit(False)))
            rows = now.unionByName(gone.select("term", ID, F.col("_dt").alias("dt"), F.lit(0).alias("tf"), "dl"))
        moved = moved.groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).persist()
        try:
            before = self.stats.lookup(moved.select("term"), before=batch_id)
            self.stats.upsert(moved.unionByName(before).groupBy("term").agg(
                F.sum("n").alias("n"), F.sum("total").alias("total")), batch_id, unique=True)
        finally:
            moved.unpersist()
        self.postings.upsert(rows, batch_id, unique=True, fresh=not n_old)
        self.docs.upsert(new, batch_id, unique=True, fresh=not n_old)

    def _moved(self, rows: DataFrame, postings: DataFrame, sign: int) -> DataFrame:
        """What ``rows`` add to (or, negative, take from) the statistics."""
        by_term = postings.groupBy("term").agg((F.count(F.lit(1)) * sign).alias("n"), F.lit(0).cast("long").alias("total"))
        size = F.coalesce(F.sum(F.size(tokens(self.field))), F.lit(0)).cast("long")
        both = rows.agg(F.inline(F.array(
            F.struct(F.lit(ALL).alias("term"), (F.count(F.lit(1)) * sign).alias("n"), F.lit(0).cast("long").alias("total")),
            F.struct(F.lit(NAMED).alias("term"), (F.count(self.field) * sign).alias("n"), (size * sign).alias("total")))))
        return by_term.unionByName(both)

    def compact(self) -> None:
        """Compact the three tables: documents last, so that a base of documents
        never runs ahead of the other two."""
        for table in (self.stats, self.postings, self.docs):
            table.compact()

    # ------------------------------------------------------------- searching
    def _terms(self, keyword: str | None) -> list[str] | None:
        return None if keyword is None else list(dict.fromkeys(query_terms(keyword, self.spark)))

    def matches(self, date: str, terms: list[str]) -> DataFrame:
        """(id, dl, tf0, tf1, ..) of the date's rows that hold every term; from postings only."""
        held = self.postings.read((F.col("dt") == date) & F.col("term").isin(terms)).where("tf > 0")
        found = held.groupBy(ID).agg(F.max("dl").alias("dl"), F.count(F.lit(1)).alias("_n"),
                                     *[F.sum(F.when(F.col("term") == t, F.col("tf"))).cast("double").alias(f"tf{k}")
                                       for k, t in enumerate(terms)])
        return found.where(F.col("_n") == len(terms)).drop("_n")

    def total(self, date: str, keyword: str | None) -> DataFrame:
        """(total): the number of hits."""
        terms = self._terms(keyword)
        if terms is None:
            hits = self.docs.read(F.col("dt") == date)
        else:
            hits = self.matches(date, terms) if terms else self.spark.createDataFrame([], "x int")
        return hits.agg(F.count(F.lit(1)).alias("total"))

    def hits(self, date: str, keyword: str | None) -> DataFrame:
        """The date's matching rows, without a score."""
        terms = self._terms(keyword)
        rows = self.docs.read(F.col("dt") == date)
        if terms is None:
            return rows
        return rows.join(self.matches(date, terms).select(ID), ID, "left_semi") if terms else rows.where(F.lit(False))

    def ranked(self, date: str, keyword: str | None) -> DataFrame:
        """The date's matching rows with their BM25 score over the whole index."""
        terms = self._terms(keyword)
        if not terms:
            return self.hits(date, keyword).withColumn("score", F.lit(0.0))
        rows = self.stats.read(F.col("term").isin([ALL, NAMED, *terms]))
        value = lambda t, c: F.coalesce(F.max(F.when(F.col("term") == t, F.col(c))), F.lit(0)).cast("double")
        one = rows.agg(F.struct(value(ALL, "n").alias("n"), value(NAMED, "total").alias("size"), value(NAMED, "n").alias("named"),
                                *[value(t, "n").alias(f"df{k}") for k, t in enumerate(terms)]).alias("s")).scalar()
        found = self.matches(date, terms).withColumn("s", one)
        n, average = F.col("s.n"), F.col("s.size") / F.greatest(F.col("s.named"), F.lit(1.0))

        def part(k: int) -> Column:
            df, tf = F.col(f"s.df{k}"), F.col(f"tf{k}")
            idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
            return idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / average))

        score = F.round(reduce(lambda a, b: a + b, map(part, range(len(terms))), F.lit(0.0)), 6)
        return self.docs.read(F.col("dt") == date).join(found.select(ID, score.alias("score")), ID)

    def page(self, date: str, keyword: str | None, page_no: int = 1, size: int = 20) -> DataFrame:
        """One page of hits in order of relevance, then id."""
        start = max(page_no - 1, 0) * size
        return self.ranked(date, keyword).orderBy(F.col("score").desc(), F.col(ID).asc()).offset(start).limit(size)
