"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is kept as a transition
table with a column for each character that the text has. A text is parsed into phrases, each the longest match in a
language's text, and the phrases are normalised to bits a character:
phrases x log2(length of the language's text) / characters. The language that
needs the fewest bits wins.

The automata come from a bounded sample of labelled rows (SAMPLE_ROWS rows a
language, SAMPLE_CHARS characters of each, at a place that the text's hash
names; of more than TOTAL_ROWS / SAMPLE_ROWS languages each gives fewer rows, so that a worker's
tables take some 100 MB at most, whatever the number of labels). Texts are parsed whole, in blocks of BLOCK characters side by side; a
phrase ends with its block, for every language alike.

Defined results: a null text and one without a letter are ``und`` with score
0, as is every text when no language could be learned; ties go to the
language that sorts first; repeated rows get the same answer; extra columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

SAMPLE_ROWS, SAMPLE_CHARS, TOTAL_ROWS = 64, 400, 1024
BLOCK = 512
UNKNOWN = "und"

# codes of characters: 0 anything but a letter (runs count once), 1.. frequent letters, 95.. others by remainder, 127 filling
_FREQUENT, _OTHERS, _FILL, _CODES = 94, 32, 127, 128
_SHIFT = 28


def sample(docs: DataFrame, lang: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
           total: int = TOTAL_ROWS) -> dict[str, str]:
    """``rows`` x ``chars`` characters of text for each language at most, of ``total`` rows in all.

    Rows are chosen by the text's hash: of each of ``rows`` buckets of a
    language the smallest; partial minima are taken before the shuffle. Where that
    gives more than ``total`` rows, every language gives its first one, then its second one and so
    on; of more labels than ``total`` those that sort first are learned.
    """
    h = F.xxhash64("text")
    place = F.pmod(F.shiftrightunsigned(h, 8), F.greatest(F.char_length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    got = (docs.withColumn("_lang", lang).where(F.col("_lang").isNotNull() & F.col("text").isNotNull())
           .select("_lang", F.pmod(h, F.lit(rows)).alias("_bucket"),
                   F.struct(h.alias("h"), F.col("text").substr(place, F.lit(chars)).alias("part")).alias("_row"))
           .groupBy("_lang", "_bucket").agg(F.min("_row").alias("_row"))
           .select("_lang", "_bucket", F.col("_row.part").alias("part"),
                   F.row_number().over(Window.partitionBy("_lang").orderBy("_bucket")).alias("_turn"))
           .orderBy("_turn", "_lang").limit(total).collect())
    parts: dict[str, list[str]] = {}
    for row in sorted(got, key=lambda r: (r["_lang"], r["_bucket"])):
        parts.setdefault(row["_lang"], []).append(row["part"])
    return {lang: " ".join(p) for lang, p in parts.items()}


def letter_codes(texts) -> np.ndarray:
    """Code of each code point, with the texts' most frequent letters apart."""
    seen = Counter(c for t in texts for x in t for c in x.lower()[:1] if c.isalpha())
    frequent = {c: k + 1 for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:_FREQUENT])}
    codes = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        if unicodedata.category(c := chr(cp))[0] in "LM":
            low = c.lower()[0]
            codes[cp] = frequent.get(low) or _FREQUENT + 1 + ord(low) % _OTHERS
    return codes


def encoded(codes: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts one after another, each run of code 0 once; length of each."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    all_codes = codes[points]
    ends = np.cumsum([len(t) for t in texts])
    again = np.zeros(len(points), bool)
    again[1:] = (all_codes[1:] == 0) & (all_codes[:-1] == 0)
    again[ends[:-1][ends[:-1] < len(points)]] = False
    kept = ~again
    before = np.concatenate([[0], np.cumsum(kept)])
    return all_codes[kept], np.diff(before[np.concatenate([[0], ends])])


def automaton(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix automaton as a table: state * width + column -> next state * width, and
    above _SHIFT the phrases that end on the way (a dead end begins anew); and the
    column of each code: 0 for all that the text lacks, the last one for filling."""
    nexts: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes.tolist():
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    used = np.unique(codes)
    place, width = np.zeros(_CODES, np.uint8), len(used) + 2
    place[used] = np.arange(1, width - 1)
    place[_FILL] = width - 1
    root = np.full(width, 1 << _SHIFT, np.int32)  # a code that the text lacks is a phrase
    for c, s in nexts[0].items():
        root[place[c]] = s * width
    table = np.empty((len(nexts), width), np.int32)
    table[:] = root + (1 << _SHIFT)
    table[0] = root
    for s, row in enumerate(nexts):
        for c, to in row.items():
            table[s, place[c]] = to * width
    table[:, -1] = np.arange(len(nexts)) * width
    return table.ravel(), place


class Model:
    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(texts)
        self.codes = letter_codes(texts.values())
        parts = [encoded(self.codes, [texts[x]])[0] for x in self.langs]
        self.tables, self.places = zip(*map(automaton, parts)) if parts else ((), ())
        self.bits = np.array([np.log2(max(2, len(p))) for p in parts])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language, and its length in codes."""
        codes, lengths = encoded(self.codes, texts)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        row = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at = starts[owner] + row * BLOCK
        width = np.minimum(BLOCK, starts[owner] + lengths[owner] - at)
        order = np.argsort(-width, kind="stable")  # full blocks first: the rest drop out as they end
        at, width, owner = at[order], width[order], owner[order]
        padded = np.concatenate([codes, np.full(BLOCK, _FILL, np.uint8)])
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        alive = np.searchsorted(-width, -np.arange(1, BLOCK + 1), side="right")
        columns = [padded[at[:n] + k] for k, n in enumerate(alive) if n]
        for j, (table, place) in enumerate(zip(self.tables, self.places)):
            state, count = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
            for column in columns:
                got = table[state[:len(column)] + place[column]]
                count[:len(column)] += got >> _SHIFT
                state[:len(column)] = got & ((1 << _SHIFT) - 1)
            count += state != 0
            out[:, j] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return out, lengths

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        texts = [t or "" for t in texts]
        known = [any(map(str.isalpha, t)) for t in texts]
        if not self.langs or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        phrases, _ = self.phrases(texts)
        cost = phrases * self.bits
        best = cost.argmin(axis=1)
        least = cost[np.arange(len(texts)), best]
        share = 1.0 / np.exp2(np.maximum(least[:, None] - cost, -1000.0)).sum(axis=1)
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best, known)],
                [float(s) if k else 0.0 for s, k in zip(share, known)])


def identify_rows(docs: DataFrame, texts: dict[str, str], text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score (the winner's share of 2 ** -bits) of their text.

    ``texts`` is the text of each language, as :func:`sample` gives it; each
    task builds its automata, and frees them for what the worker does next."""
    common.arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    schema = T.StructType([f for f in docs.schema if f.name not in ("lang_pred", "score")])
    docs = docs.select(*schema.names)

    def run(batches):
        model = Model(shared.value)
        for batch in batches:
            for part in common.slices(batch, text_col):
                langs, scores = model.predict(part.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(common.lean(run), T.StructType(list(schema)).add("lang_pred", "string").add("score", "double"))


def identify(docs: DataFrame, texts: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every text."""
    return identify_rows(common.narrow(docs, id_col, text_col), texts).select("doc_id", "lang_pred", "score")


def held_out(doc_id: Column) -> Column:
    """The rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> dict[str, str]:
    """Language texts of documents' labelled rows that are not held out."""
    rows = docs.where(~held_out(F.col("doc_id"))).select(F.col("text"), F.col("lang"))
    return sample(rows, F.col("lang"))
