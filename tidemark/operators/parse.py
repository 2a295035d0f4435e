"""JSON record parsing with a reject output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def parse_json(records: DataFrame, schema: T.StructType, value_col: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``value`` into ``schema`` fields; unparsable lines keep the raw text
    in ``_corrupt`` (all parsed fields null). JSON numbers read into string
    fields as their text. Columns in ``keep`` are carried through.

    The parsed struct is expanded by a generator (``inline`` of a one-element
    array): a later filter on ``_corrupt`` then stays above it instead of
    being pushed below the projection, which would parse every line twice.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    v = F.col(value_col)
    parsed = F.from_json(v, with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a null or blank line is not a record either: reject it (as ''). The flag
    # is applied above the generator so the parse still runs once per line.
    blank = (v.isNull() | (F.trim(v) == "")).alias("_blank")
    out = records.select(*keep, blank, F.inline(F.array(parsed)))
    fixed = F.when(F.col("_blank"), F.lit("")).otherwise(F.col(CORRUPT))
    return out.withColumn(CORRUPT, fixed).drop("_blank")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
