"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, maintext, multisethash, notices, pieces, prefixtrie, resample, sigtree, suffixdup, tokencount, topk, urlalias
from tidemark.llm.common import table, tokenizer_path

PIECE_MODEL, BYTE_MODEL = "piece_bpe_32k.model", "byte_bpe_50k.json"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.summary(notices.scan(table(spark, sf_dir, "documents")))


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multisethash.compared(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


def op5_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlalias.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdup.summary(suffixdup.remove(table(spark, sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_MODEL))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_language": op1_language,
    "op2_licenses": op2_licenses,
    "op3_multiset_hash": op3_multiset_hash,
    "op4_main_text": op4_main_text,
    "op5_url_aliases": op5_url_aliases,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_pieces": op7_pieces,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_token_counts": op10_token_counts,
    "op11_topk": op11_topk,
    "op12_resample": op12_resample,
    "op13_prefix_trie": op13_prefix_trie,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op11_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
