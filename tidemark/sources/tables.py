"""Parquet table access. Catalyst prunes columns and pushes filters into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy handle on the parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)
