"""Wide-column cells from flat rows, and the globally sorted cell export
(P14, P15, F8, L1, K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed import FAMILY

CELL_COLUMNS = ["rowkey", "family", "qualifier", "value"]


def to_cells(rows: DataFrame, key: str = "id", family: str = FAMILY) -> DataFrame:
    """One cell (rowkey, family, qualifier, value) per non-key column; column
    names in sorted order; every value as its text (nested ones as JSON); null
    cells skipped."""
    nested = {f.name for f in rows.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    fields = sorted(c for c in rows.columns if c != key)
    text = rows.select(F.col(key).cast("string").alias("rowkey"),
                       *[(F.to_json(c) if c in nested else F.col(c).cast("string")).alias(c) for c in fields])
    if not fields:
        return text.select("rowkey", *[F.lit(None).cast("string").alias(c) for c in ("family", "qualifier", "value")]).limit(0)
    cells = text.unpivot("rowkey", fields, "qualifier", "value")
    return cells.where(F.col("value").isNotNull()).select(
        "rowkey", F.lit(family).alias("family"), "qualifier", "value")


def cells_from_tuples(tuples: DataFrame) -> DataFrame:
    """Cells given already split as (rowkey, (family, qualifier, value))."""
    return tuples.select("rowkey", "family", "qualifier", "value")


def sort_cells(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Global byte order on (rowkey, family, qualifier): a range shuffle on the
    whole sort key (sampled bounds) and a sort inside each partition, so files
    are ordered by key range and a row key with very many cells can still be
    split between partitions."""
    n = partitions or cells.sparkSession.conf.get("spark.sql.shuffle.partitions")
    key = ["rowkey", "family", "qualifier"]
    return cells.repartitionByRange(int(n), *key).sortWithinPartitions(*key)


def write_sorted_cells(cells: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write sorted cell files to ``path``, replacing what was there."""
    sort_cells(cells, partitions).write.mode("overwrite").parquet(path)
