from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that operators use themselves; they must not get in the way.
CLASHING = ("h", "key", "mark", "lanes", "bucket", "need", "node", "component", "n", "row", "first", "ids", "score", "lang_pred")


@pytest.fixture(scope="session")
def documents(spark):
    """documents(texts): a frame with ids 0.. and columns whose names clash."""
    def make(texts, ids=None, langs=None, clash=True, parts=3):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, langs[k] if langs else None, "s", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
        df = spark.createDataFrame(rows, DOCS).repartition(parts)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("clash") for c in CLASHING})
        return df

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, repeated, very long and unusual texts."""
    long = " ".join(f"word{k % 997} runs{k % 31}." for k in range(20_000))
    return [None, "", "   ", "\n\n", "One line.", "One line.", "é 日本語 𝒳 .", "a" * 5000, long, long + " tail",
            "tab\tand\x0bmore  spaces  ", "\x00nul\x00", None, "<|endoftext|> a <s> b ▁c", "123 456 !!!"]
