"""JSON files with an inferred schema.

The schema is inferred over all lines (one distributed pass), merged with a
schema kept from earlier files if one is given, and the files are read with the
result, so a field that a batch lacks is null and a field whose type differs
between batches takes one type that holds both. Give ``schema`` to skip the
pass. Lines that are not a JSON object, and rows without a key, are rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
_WIDER = [T.LongType(), T.DoubleType()]


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: numbers widen, structs and arrays merge part by
    part, anything else that differs is text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WIDER and b in _WIDER:
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType), True)
    return T.StringType()


def merge_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, those of ``a`` first."""
    types = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        types[f.name] = merge_types(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in types.items()])


def infer_schema(spark: SparkSession, path: str, known: T.StructType | None = None) -> T.StructType:
    """Schema of all lines under ``path``, merged with a known one."""
    found = spark.read.option("columnNameOfCorruptRecord", CORRUPT).json(path).schema
    found = T.StructType([f for f in found.fields if f.name != CORRUPT])
    return found if known is None else merge_schemas(known, found)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
              known: T.StructType | None = None) -> DataFrame:
    """Rows of the files, with ``_corrupt`` set to the line where it can't be read."""
    schema = schema or infer_schema(spark, path, known)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def keyed_rows(records: DataFrame, key: str) -> DataFrame:
    """Rows with a key, without the reject column."""
    return records.where(F.col(CORRUPT).isNull() & F.col(key).isNotNull()).drop(CORRUPT)


def rejects(records: DataFrame, key: str) -> DataFrame:
    """(value, reason): the lines, or the rows as JSON, that are not loaded."""
    bad = records.where(F.col(CORRUPT).isNotNull() | F.col(key).isNull())
    row = F.to_json(F.struct(*[c for c in records.columns if c != CORRUPT]))
    return bad.select(F.coalesce(CORRUPT, row).alias("value"),
                      F.when(F.col(CORRUPT).isNotNull(), F.lit("not JSON")).otherwise(F.lit("no key")).alias("reason"))
