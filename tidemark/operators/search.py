"""Keyword search over the sale index: filter, page, total, term counts, shares, BM25.

One filtered frame (date filter + all-terms keyword match) feeds the page,
the total and the aggregations. Corpus statistics for scoring cover the whole
index: one global partial aggregate whose single row is bound as literals. Paging is ``orderBy + offset + limit``, planned as a per-partition
top-k followed by a merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed import (AGE_BUCKETS, AGE_OPTIONS, AGE_TITLE, GENDER_BUCKETS,  # noqa: F401
                            GENDER_OPTIONS, GENDER_TITLE)
from tidemark.functions.stats import percent_1dp
from tidemark.functions.text import query_terms, tokens

BM25_K1 = 1.2
BM25_B = 0.75


def keyword_filter(keyword: str | None, field: str = "sku_name", spark=None):
    """Column predicate: every analysed query term occurs in ``field``.

    ``None`` means no keyword clause; a keyword with no terms matches nothing.
    """
    if keyword is None:
        return F.lit(True)
    # the query is cut once by the same tokenizer as the field, then bound as
    # literals (a tokenizer over a literal would run again for every row)
    terms = query_terms(keyword, spark)
    if not terms:
        return F.lit(False)
    toks = tokens(field)
    pred = None
    for t in terms:
        p = F.array_contains(toks, F.lit(t))
        pred = p if pred is None else pred & p
    return pred


def search(index: DataFrame, date: str, keyword: str | None) -> DataFrame:
    """Rows of ``date`` (unscored filter) that match ``keyword`` (all terms)."""
    return index.where((F.col("dt") == date) & keyword_filter(keyword, spark=index.sparkSession))


def total(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def bm25(corpus: DataFrame, hits: DataFrame, keyword: str | None, field: str = "sku_name",
         k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """Add ``score``: BM25 of the query terms, with document count, average
    length and document frequencies taken over the whole ``corpus``.

    The statistics are one global (partially aggregated) pass over the
    corpus; its single row (2 + number of query terms values) is fetched once
    and bound into the scoring expression as literals. Separate scalar
    subqueries would each re-run the corpus plan.
    """
    terms = list(dict.fromkeys(query_terms(keyword, corpus.sparkSession))) if keyword else []
    if not terms:
        return hits.withColumn("score", F.lit(0.0))
    toks = tokens(field)
    aggs = [F.count(F.lit(1)).cast("double").alias("n_docs"),
            F.avg(F.size(toks).cast("double")).alias("avgdl")]
    aggs += [F.count_if(F.array_contains(toks, F.lit(t))).cast("double").alias(f"df{i}")
             for i, t in enumerate(terms)]
    st = corpus.agg(*aggs).first()
    n_docs, avgdl = float(st["n_docs"]), float(st["avgdl"] or 0.0)
    dl = F.size(toks).cast("double")
    score = F.lit(0.0)
    for i, t in enumerate(terms):
        df_t = float(st[f"df{i}"])
        idf = F.log(F.lit(1.0) + F.lit((n_docs - df_t + 0.5) / (df_t + 0.5)))
        tf = (F.size(toks) - F.size(F.array_remove(toks, t))).cast("double")   # occurrences of t
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / F.lit(avgdl)))
    return hits.withColumn("score", F.round(score, 6))


def ranked(index: DataFrame, date: str, keyword: str | None,
           corpus: DataFrame | None = None) -> DataFrame:
    """All hits with their score (relevance order is score desc, then id).

    ``index`` may be restricted to the date already (scan pruning);
    ``corpus`` is the whole index for the scoring statistics (defaults to
    ``index``).
    """
    return bm25(index if corpus is None else corpus, search(index, date, keyword), keyword)


def page(index: DataFrame, date: str, keyword: str | None, page_no: int = 1,
         size: int = 20, corpus: DataFrame | None = None) -> DataFrame:
    """Page ``page_no`` (from 1) of ``size`` hits in relevance order: a
    per-partition top-(offset+size) and a merge, never a full sort."""
    start = max(page_no - 1, 0) * size
    r = ranked(index, date, keyword, corpus)
    return r.orderBy(F.col("score").desc(), F.col("order_detail_id").asc()).offset(start).limit(size)


def term_counts(hits: DataFrame, field: str, top: int, alias: str) -> DataFrame:
    """Top ``top`` values of ``field`` by hit count (count desc, value asc);
    null is not a bucket."""
    return (hits.where(F.col(field).isNotNull()).groupBy(F.col(field).alias(alias))
            .agg(F.count(F.lit(1)).alias("doc_count"))
            .orderBy(F.col("doc_count").desc(), F.col(alias).asc()).limit(top))


def gender_terms(hits: DataFrame) -> DataFrame:
    return term_counts(hits, "user_gender", GENDER_BUCKETS, "user_gender")


def age_terms(hits: DataFrame) -> DataFrame:
    return term_counts(hits, "user_age", AGE_BUCKETS, "user_age")


def _options(title: str, pairs: list) -> DataFrame:
    return F.inline(F.array(*[F.struct(F.lit(title).alias("title"), F.lit(n).alias("name"),
                                       v.alias("value")) for n, v in pairs]))


def gender_share(hits: DataFrame) -> DataFrame:
    """(title, name, value): male then female share of all hits, in percent
    with one decimal. Hits without a gender count in the total only."""
    aggs = [F.count(F.lit(1)).alias("n")] + [
        F.count_if(F.col("user_gender") == code).alias(f"g{i}")
        for i, (_, code) in enumerate(GENDER_OPTIONS)]
    one = hits.agg(*aggs)
    pairs = [(name, percent_1dp(f"g{i}", "n")) for i, (name, _) in enumerate(GENDER_OPTIONS)]
    return one.select(_options(GENDER_TITLE, pairs))


def age_share(hits: DataFrame) -> DataFrame:
    """(title, name, value): shares of ages < 20, 20..30 inclusive, > 30."""
    a = F.col("user_age")
    one = hits.agg(F.count(F.lit(1)).alias("n"), F.count_if(a < 20).alias("b0"),
                   F.count_if((a >= 20) & (a <= 30)).alias("b1"), F.count_if(a > 30).alias("b2"))
    pairs = [(name, percent_1dp(f"b{i}", "n")) for i, name in enumerate(AGE_OPTIONS)]
    return one.select(_options(AGE_TITLE, pairs))


def sale_search(index: DataFrame, date: str, keyword: str | None, page_no: int = 1,
                size: int = 20) -> dict[str, DataFrame]:
    """The four results of one dashboard search: detail page, total, stats."""
    hits = search(index, date, keyword)
    return {"detail": page(index, date, keyword, page_no, size), "total": total(hits),
            "gender": gender_share(hits), "age": age_share(hits)}
