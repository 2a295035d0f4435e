"""A training corpus made from ``documents``: the stages in order, each over
all that its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import stages
from tidemark.llm.common import table, written

STAGES = [
    ("language_id", stages.language_id),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("decontamination", stages.decontamination),
    ("tokens", stages.tokens),
]

#: SQL can't express the stages; tests/llm holds them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage applied to what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
