"""Text column expressions: masks, markers, prefixes, the search tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.fixed import MARKER, MASK_KEEP, MASK_TEXT  # noqa: F401

# Tokenizer rule (search analyser): lower-case, every CJK ideograph is its own
# term, other runs of letters/digits are terms, everything else separates.
_CJK = r"([\p{IsHan}])"
_SEP = r"[^\p{L}\p{N}]+"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def mask_phone(tel) -> Column:
    """First four characters followed by seven stars; null stays null."""
    t = _c(tel)
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.substring(t, 1, MASK_KEEP), F.lit(MASK_TEXT)))


def strip_marker(value, marker: str = MARKER) -> Column:
    """Remove every occurrence of ``marker`` (matched literally)."""
    import re
    return F.regexp_replace(_c(value), re.escape(marker), "")


def prefix_millis(value, ts) -> Column:
    """'<epoch ms>-<value>' using the record's own timestamp instant."""
    return F.concat(F.unix_millis(_c(ts)).cast("string"), F.lit("-"), _c(value))


def tokens(text) -> Column:
    """Analysed terms of ``text`` as an array (duplicates kept, for tf)."""
    spaced = F.regexp_replace(F.lower(_c(text)), _CJK, " $1 ")
    # array_remove, not a lambda filter: stays inside generated code
    return F.array_remove(F.split(spaced, _SEP), "")


def query_terms(keyword: str, spark=None) -> list[str]:
    """Terms of a (short) query string, cut by the very same Spark expression
    as the indexed text, so both sides agree on every character (the JVM's
    Unicode tables, not Python's). A literal row, which the optimizer evaluates
    on the driver: no job."""
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    return list(spark.sql("SELECT * FROM VALUES (:keyword) AS t(k)", args={"keyword": keyword})
                .select(tokens("k")).first()[0])
