"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns
documents with the columns (doc_id, text, lang, source, n_chars); the last
returns their tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, pieces, sigtree, suffixdup
from tidemark.llm.common import table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PIECE_MODEL = "piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; ``lang`` becomes the predicted one. Texts that
    are null or hold no letter go."""
    found = langid.identify_rows(docs.select(*COLUMNS), langid.fit(docs))
    return (found.where(F.col("lang_pred") != langid.UNKNOWN)
            .select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links join: the one of least id
    (one without an id only where none has one), of several with that id the one of
    least text hash, of repeated rows one. Documents without words link with
    nothing and stay, of repeated rows one."""
    found = sigtree.join(docs)
    least = found.where(F.col("group").isNotNull()).groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("row"))
    kept = least.select("row.doc_id", "row.text_hash").unionByName(
        found.where(F.col("group").isNull()).select("doc_id", "text_hash").distinct())
    # the join and the dropping of repeated rows deal by the same three columns, so texts travel once
    rows = _by_row(docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text")))
    return (rows.join(_by_row(kept).select(*BY_ROW), BY_ROW, "left_semi").dropDuplicates(BY_ROW).select(*COLUMNS))


BY_ROW = ["row_id", "no_id", "text_hash"]


def _by_row(rows: DataFrame) -> DataFrame:
    """Columns without nulls that tell rows apart by doc_id, null ones included, and text_hash."""
    return rows.withColumns({"row_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)), "no_id": F.col("doc_id").isNull()})


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of smaller id holds too; every document stays."""
    cut = suffixdup.remove(docs, carry=("lang", "source"), characters=True)
    return (cut.select("doc_id", F.col("kept").cast("string").alias("text"), "carried.lang", "carried.source")
            .withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, text as decoded from the ids."""
    return pieces.encode_rows(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(PIECE_MODEL))
