"""Homomorphic multiset fingerprints of documents, with DataFrame functions only.

A fingerprint is a wide vector that is the sum, lane by lane and modulo a
power of two, of vectors hashed from the document's parts, so the order of
parts does not matter and a part is inserted or deleted by adding or
subtracting its vector. It has two groups of lanes:

* 16 lanes modulo 2**32 over paragraphs (lines), each paragraph giving its
  SHA-512: documents of the same paragraphs are equal here;
* LANES lanes modulo 2**20 over clauses (runs between punctuation marks or
  line ends), each lane adding one bit of a clause's hash, and the number of
  clauses, in full (the fingerprint's digits give it modulo 2**20). A lane's sum, taken around its mean, is a random projection of the
  multiset of clauses, so the cosine of two such vectors estimates the cosine
  of the multisets: the likeness.

Defined results: a null text counts as empty; two texts without a clause have
likeness 1 when the fingerprints are equal, else 0; long texts are
fingerprinted whole, and their likeness holds as long as no lane lies 2**20 or
more from its mean (under 2**20 clauses: always; beyond, unless clauses repeat
about a million times); repeated rows get equal fingerprints; extra columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

#: Lanes of the likeness group: three to a long, in words of 63 bits.
WORDS = 42
LANES = 3 * WORDS
_BITS, _GAP = 20, 21
_ONE = sum(1 << (_GAP * k) for k in range(3))
_MASK = sum(((1 << _BITS) - 1) << (_GAP * k) for k in range(3))
_PARAGRAPH_LANES = 16


def _sum(array: Column, value, modulus_mask: int) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, x: (a + value(x)).bitwiseAND(F.lit(modulus_mask)))


def paragraph_hashes(text: Column) -> Column:
    """SHA-512 (hex) of each non-empty line, white space at its ends aside."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(lines, lambda p: F.sha2(F.encode(p, "UTF-8"), 512))


def clause_hashes(text: Column) -> Column:
    """Three 63-bit hashes' source: one 64-bit hash of each clause."""
    clauses = F.filter(F.split(text, r"[\p{P}\p{S}\n]+\s*"), lambda c: F.trim(c) != "")
    return F.transform(clauses, lambda c: F.xxhash64(F.trim(c)))


def lanes(paragraphs: Column, clauses: Column) -> Column:
    """array<bigint>: 16 paragraph lanes, the number of clauses, WORDS words of three lanes each.

    A word takes 3 bits of a clause's hash, 21 bits apart; 42 words come from
    21 shifts of the hash and of a second hash derived from it.
    """
    wide = [_sum(paragraphs, lambda p, k=k: F.conv(F.substring(p, 8 * k + 1, 8), 16, 10).cast("bigint"), 0xFFFFFFFF)
            for k in range(_PARAGRAPH_LANES)]
    count = [F.size(clauses).cast("bigint")]
    second = F.transform(clauses, lambda h: F.xxhash64(h, F.lit(1)))
    words = [_sum(source, lambda h, k=k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONE)), _MASK)
             for source in (clauses, second) for k in range(WORDS // 2)]
    return F.array(*wide, *count, *words)


def added(a: Column, b: Column) -> Column:
    """Lanes of the union of two multisets."""
    return _combined(a, b, 1)


def removed(a: Column, b: Column) -> Column:
    """Lanes of a multiset without one that it holds."""
    return _combined(a, b, -1)


def _combined(a: Column, b: Column, sign: int) -> Column:
    guard = sum(1 << (_GAP * k + _BITS) for k in range(3))  # so that a lane never borrows from the next

    def at(x, y, k):
        mask = F.when(k < _PARAGRAPH_LANES, F.lit(0xFFFFFFFF)).when(
            k == _PARAGRAPH_LANES, F.lit((1 << 63) - 1)).otherwise(F.lit(_MASK))
        if sign > 0:
            return (x + y).bitwiseAND(mask)
        spare = F.when(k < _PARAGRAPH_LANES, F.lit(1 << 32)).when(
            k == _PARAGRAPH_LANES, F.lit(0)).otherwise(F.lit(guard))
        return (x.bitwiseOR(spare) - y).bitwiseAND(mask)

    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    return F.transform(pairs, lambda p, k: at(p["x"], p["y"], k))


def as_text(vector: Column) -> Column:
    """The fingerprint as hexadecimal digits of fixed width."""
    return F.lower(F.array_join(F.transform(
        vector, lambda x, k: F.lpad(F.hex(F.when(k == _PARAGRAPH_LANES, x.bitwiseAND(F.lit((1 << _BITS) - 1))).otherwise(x)), F.when(k < _PARAGRAPH_LANES, 8).when(k == _PARAGRAPH_LANES, 5).otherwise(16), F.lit("0"))), ""))


def _centred(vector: Column) -> Column:
    """The likeness lanes around their mean: 2 x sum - clauses, known modulo 2**21 and taken as a signed value."""
    n = vector[_PARAGRAPH_LANES]
    low = F.lit((1 << _BITS) - 1)
    split = F.flatten(F.transform(F.slice(vector, _PARAGRAPH_LANES + 2, WORDS), lambda w: F.array(
        *[F.shiftrightunsigned(w, _GAP * k).bitwiseAND(low) for k in range(3)])))
    half = 1 << _BITS
    return F.transform(split, lambda x: ((x * 2 - n + half).bitwiseAND(F.lit(2 * half - 1)) - half).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of two documents' multisets of clauses, cut to 0..1; 1 for equal lanes."""
    x, y = _centred(a), _centred(b)

    def dot(u, v):
        return F.aggregate(F.zip_with(u, v, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    norm = F.sqrt(dot(x, x) * dot(y, y))
    cosine = F.when(norm > 0, dot(x, y) / norm).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (never null), lanes of every document; no shuffle."""
    docs = common.narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return with_lanes(docs, "text", "lanes")


def with_lanes(df: DataFrame, text: str, name: str) -> DataFrame:
    return (df.withColumn("_p", paragraph_hashes(F.col(text))).withColumn("_c", clause_hashes(F.col(text)))
            .withColumn(name, lanes(F.col("_p"), F.col("_c"))).drop("_p", "_c"))


def _bucket(doc_id: Column, firsts: list[int]) -> Column:
    """Which of the id ranges that begin (descending) at ``firsts`` holds an id; null ids are in the last.

    Two steps over about the square root of the ranges each."""
    if not firsts:
        return F.lit(0)
    step = max(1, int(len(firsts) ** 0.5))
    coarse = F.array(*[F.lit(x) for x in firsts[::step]])
    fine = F.array(*[F.lit(x) for x in firsts])
    group = F.greatest(F.size(F.filter(coarse, lambda f: f >= doc_id)) - 1, F.lit(0)) * step
    inside = F.size(F.filter(F.slice(fine, group + 1, F.lit(step)), lambda f: f >= doc_id))
    return F.when(doc_id.isNull(), F.lit(len(firsts) - 1)).otherwise(group + inside - 1)


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its edited text, whose last third is the head of the
    next document in descending id (after the last: the first). Rows of one id
    follow one another by text; null ids come last.

    Ids are cut into even ranges, four for each shuffle partition; texts are
    shuffled once, by range, and a window takes the next row inside a range.
    A range's last row takes the first row of the next range, from a table of
    one row a range.
    """
    spark = docs.sparkSession
    base = common.narrow(docs, id_col, text_col)
    dealt = (base.select("doc_id").where(F.col("doc_id").isNotNull())
             .repartitionByRange(4 * common.n_ranges(spark), F.desc("doc_id")))
    # one row a range: as many as a multiple of the shuffle partitions
    firsts = sorted((r["first"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("first")).collect()),
                    reverse=True)
    follows = spark.createDataFrame([(k, firsts[(k + 1) % len(firsts)]) for k in range(len(firsts))] if firsts else [],
                                    "bucket int, first bigint")
    edge = with_lanes(
        base.join(F.broadcast(follows), base["doc_id"] == follows["first"])
        .groupBy("bucket").agg(F.min(F.coalesce("text", F.lit(""))).alias("edge_text"))
        .withColumnRenamed("bucket", "edge_bucket"), "edge_text", "edge_lanes")
    prints = fingerprints(base).withColumn("bucket", _bucket(F.col("doc_id"), firsts))
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    rows = (prints.withColumn("next_text", F.lead("text").over(order)).withColumn("next_lanes", F.lead("lanes").over(order))
            .join(edge, F.col("bucket") == F.col("edge_bucket"), "left"))
    need = _third(F.col("text"))
    head = F.coalesce("next_text", "edge_text", F.lit("")).substr(F.lit(1), need)
    return rows.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "lanes",
                       F.concat(F.col("text").substr(F.lit(1), F.char_length("text") - need), head).alias("edited"),
                       F.coalesce("next_lanes", "edge_lanes").alias("next_lanes"))


def _third(text: Column) -> Column:
    return F.floor(F.char_length(text) / 3).cast("int")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    both = with_lanes(edits(docs, id_col, text_col), "edited", "edited_lanes")
    return both.select(
        "doc_id", "n_chars", common.sha_hex(F.col("edited")).alias("edited_sha256"),
        as_text(F.col("lanes")).alias("fingerprint"), as_text(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        F.coalesce(likeness(F.col("lanes"), F.col("next_lanes")), F.lit(0.0)).alias("near_next"))
