"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of digits, letters and non-ASCII characters, so
case and punctuation don't matter; in scripts written without spaces (Han,
kana, Thai, Lao, Burmese, Khmer) each character is a word. Seeds are the
SEED-word grams of test items, common phrases among them too: they leave a
copy with every fourth word changed a seed, while a choice of rare ones would
lose it. A document's seed hits name the items and
places to look at, and a local alignment of words (match 2, mismatch and gap
-1) scores each: the score is its share of a full match, so an edited or
paraphrased copy loses by its edits only. A place that shares too few words
with the item for the threshold, whatever their order, is not aligned; that is
a bound on the score, so it loses nothing, and it is what keeps common phrases
cheap. An alignment keeps two rows and is run a second time, backwards, for where it
begins: its memory follows the text's part, not its product with the item.

The test items are the small side: BLOCK_BYTES of their text at most are
broadcast at a time; a larger benchmark is worked through in blocks, each over
all documents. No text is shuffled.

Defined results: a null text or one without a seed of an item has no row; a
null item or one without words matches nothing; one under SEED words matches where
all its words stand in a row, unedited; items of equal text all
match; of equally good places the first counts, and of alignments that end there
the shortest; repeated rows match one by one; texts of any length are searched whole;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common, sigtree

SEED, THRESHOLD = 3, 0.5
MATCH, MISS, GAP = 2, -1, -1
BLOCK_BYTES = 32 << 20
#: A longer stretch of hits is aligned in pieces of so many times the item's words. An
#: alignment over a threshold above 0 takes under 3 times the item's words, so pieces overlap by that.
PIECE, OVERLAP = 6, 3

_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                     for b in range(256)], np.uint8)


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces begin, and where their punctuation and full-width marks do."""
    lead = np.flatnonzero((data >= 0xE0) & (data <= 0xF0) & (data != 0xE2))
    if not len(lead):
        return lead, lead
    a, b, c = (data[np.minimum(lead + k, len(data) - 1)].astype(np.int32) for k in range(3))
    point = (a - 0xE0 << 12) + (b - 0x80 << 6) + c - 0x80  # of characters of three bytes
    marks = ((point >= 0x3000) & (point <= 0x3004) | (point >= 0x3008) & (point <= 0x3020)
             | (point >= 0xFF01) & (point <= 0xFF0F) | (point >= 0xFF1A) & (point <= 0xFF20)) & (a < 0xF0)
    one = ((point >= 0x0E00) & (point <= 0x0EFF) | (point >= 0x1000) & (point <= 0x109F) | (point >= 0x1780) & (point <= 0x17FF)
           | (point >= 0x3005) & (point <= 0x30FF) | (point >= 0x3400) & (point <= 0x9FFF)
           | (point >= 0xF900) & (point <= 0xFAFF)) & (a < 0xF0) | (a == 0xF0) & (b >= 0xA0)
    return lead[one & ~marks], lead[marks]


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and where each text's words begin."""
    letters = _LETTERS[data]
    alone, marks = _unspaced(data)
    if len(marks):
        letters[(marks[:, None] + np.arange(3)).ravel()] = 32
    if len(alone):  # a blank after each such character, and one before
        cuts = np.sort(np.concatenate([alone, alone + np.where(data[alone] == 0xF0, 4, 3)]))
        letters = np.insert(letters, cuts, 32)
        offsets = offsets + np.searchsorted(cuts, offsets, side="right")
        offsets[0] = 0
    h, counts = sigtree.words(offsets, letters)
    return h, np.concatenate([[0], np.cumsum(counts)])


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on (over a text's end: meaningless)."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return common.mix(out)


class Items:
    """A block of test items: their words, and their seeds in order of hash."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        self.ids, self.size = [i for i, _ in items], size
        raw = [t.encode() for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        h, starts = word_hashes(offsets, np.frombuffer(b"".join(raw), np.uint8))
        self.words = [h[a:b] for a, b in zip(starts[:-1], starts[1:])]
        #: an item under ``size`` words has one seed, the whole of it
        self.sizes = sorted({min(size, len(w)) for w in self.words if len(w)})
        got = [(g, k, p) for k, w in enumerate(self.words) if len(w) for p, g in enumerate(grams(w, min(size, len(w))).tolist())]
        got.sort()
        self.seeds = np.array([g for g, _, _ in got], np.uint64)
        self.items = np.array([k for _, k, _ in got], np.int64)
        self.places = np.array([p for _, _, p in got], np.int64)
        self.counted = [np.unique(w, return_counts=True) for w in self.words]
        self.bits = np.zeros(1 << 19, np.uint8)
        low = (self.seeds & np.uint64((1 << 22) - 1)).astype(np.int64)
        np.bitwise_or.at(self.bits, low >> 3, (1 << (low & 7)).astype(np.uint8))

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of a text at which a seed stands, and the seed's hash."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for size in self.sizes:
            g = grams(h, size)
            at = np.flatnonzero(common.in_bitmap(self.bits, g))
            at = at[self.seeds[np.minimum(np.searchsorted(self.seeds, g[at]), len(self.seeds) - 1)] == g[at]]
            found.append((at, g[at]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def shared(self, k: int, part: np.ndarray) -> int:
        """Words that item ``k`` and a part of a text share, whatever their order: no alignment matches more."""
        words, counts = self.counted[k]
        part = np.sort(part)
        return int(np.minimum(np.searchsorted(part, words, side="right") - np.searchsorted(part, words), counts).sum())


def _row(w: int, text: np.ndarray, above: np.ndarray, steps: np.ndarray, first: int, floor: int | None) -> np.ndarray:
    """The next row of an alignment: item word ``w`` against a text, below the row ``above``."""
    row = np.empty_like(above)
    row[0] = first
    np.maximum(above[:-1] + np.where(text == np.uint64(w), MATCH, MISS), above[1:] + GAP, out=row[1:])
    if floor is not None:
        np.maximum(row, floor, out=row)
    return np.maximum.accumulate(row + steps) - steps  # gaps along the text


def align(item: np.ndarray, text: np.ndarray, least: float = 1) -> tuple[int, int, int]:
    """Best local alignment of words: its score, and the first and last word of the text in it
    (not looked for under a score of ``least``)."""
    steps = np.arange(len(text) + 1) * -GAP
    row, score, i, j = np.zeros(len(text) + 1, np.int64), 0, 0, 0
    for k, w in enumerate(item.tolist(), 1):
        row = _row(w, text, row, steps, 0, 0)
        if (most := int(row.max())) > score:
            score, i, j = most, k, int(row.argmax())
    if score < max(1, least):
        return score, -1, -1
    # backwards from the end, without a floor: where the whole score is gathered the alignment begins
    back, steps = text[:j][::-1], steps[:j + 1]
    row, width = -steps, j + 1
    for k, w in enumerate(item[:i][::-1].tolist(), 1):
        row = _row(w, back, row, steps, GAP * k, None)
        if len(at := np.flatnonzero(row[:width] == score)):
            width = int(at[0])
    return score, j - width, j - 1


def search(items: Items, h: np.ndarray, threshold: float, known: dict) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, last word) of each item that one text's words hold a copy of."""
    at, g = items.hits(h)
    if not len(at):
        return []
    lo = np.searchsorted(items.seeds, g, side="left")
    hi = np.searchsorted(items.seeds, g, side="right")
    count = hi - lo
    seed = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
    start = np.repeat(at, count) - items.places[seed]  # where the whole item would begin
    order = np.lexsort((start, items.items[seed]))
    start, item = start[order], items.items[seed][order]
    out = []
    for own in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
        k = int(item[own[0]])
        words, best = items.words[k], None
        if len(words) < items.size:  # the seed is the item
            out.append((k, 1.0, int(start[own[0]]), int(start[own[0]]) + len(words) - 1))
            continue
        for a, b in _parts(start[own], len(words), len(h)):
            part = h[a:b]
            if (key := (k, part.tobytes())) not in known:
                if items.shared(k, part) / len(words) < threshold:
                    continue
                if len(known) > 2_000:
                    known.clear()
                known[key] = align(words, part, threshold * MATCH * len(words))
            score, first, last = known[key]
            got = (score / (MATCH * len(words)), -(a + first), a + last)
            best = max(best, got) if best else got
        if best and best[0] >= threshold:
            out.append((k, best[0], -best[1], best[2]))
    return out


def _parts(starts: np.ndarray, size: int, n: int):
    """Bounds of the parts of a text of ``n`` words to align, from where an item would begin."""
    for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > size) + 1):
        a = max(0, int(stretch[0]) - size // 2)
        b = min(n, int(stretch[-1]) + size + size // 2)
        while b - a > PIECE * size:
            yield a, a + PIECE * size
            a += (PIECE - OVERLAP) * size
        yield a, b


_ITEMS: dict = {}


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The test items, block by block, each within block_bytes on average and read by itself."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes))
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r["item_id"], r["text"]) for r in part.distinct().orderBy("item_id", "text").collect()]


class _Block:
    """One block in the workers: built once there from the broadcast items."""

    def __init__(self, spark, items, size):
        self.name, self.size = uuid.uuid4().hex, size
        self.items = spark.sparkContext.broadcast(items)

    def get(self) -> Items:
        if self.name not in _ITEMS:
            _ITEMS.clear()
            _ITEMS[self.name] = Items(self.items.value, self.size)
        return _ITEMS[self.name]


def _prepared(spark, benchmark: DataFrame, size: int, item_col: str, item_text: str, block_bytes: int):
    common.arrow_batches(spark)
    for items in _blocks(benchmark, item_col, item_text, block_bytes):
        yield _Block(spark, items, size)


def _found(block: _Block, part: pa.RecordBatch, text_col: str, threshold: float, known: dict):
    """For each row of a batch the items that its text holds."""
    items = block.get()
    h, starts = word_hashes(*common.utf8(part.column(text_col)))
    at, _ = items.hits(h)
    rows = set((np.searchsorted(starts, at, side="right") - 1).tolist())
    return [search(items, h[starts[k]:starts[k + 1]], threshold, known) if k in rows else []
            for k in range(part.num_rows)]


_KIND = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"


def copies(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = SEED,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word of each document's copy of a test item."""
    docs = common.narrow(docs, id_col, text_col)
    out = None
    for block in _prepared(docs.sparkSession, benchmark, size, item_col, item_text, block_bytes):
        def work(batches, block=block):
            known: dict = {}
            for batch in batches:
                for part in common.slices(batch):
                    ids = part.column("doc_id").to_pylist()
                    got = [(d, block.get().ids[k], s, a, b) for d, hits in zip(ids, _found(block, part, "text", threshold, known))
                           for k, s, a, b in hits]
                    cols = list(zip(*got)) or [()] * 5
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                     ["doc_id", "item_id", "score", "first_word", "last_word"])

        found = docs.mapInArrow(common.lean(work), _KIND)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, size: int = SEED, text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose text holds no copy of a test item; columns as they are."""
    out = docs
    for block in _prepared(docs.sparkSession, benchmark, size, item_col, item_text, block_bytes):
        def work(batches, block=block):
            known: dict = {}
            for batch in batches:
                for part in common.slices(batch, text_col):
                    yield part.filter(pa.array([not hits for hits in _found(block, part, text_col, threshold, known)], pa.bool_()))

        out = out.mapInArrow(common.lean(work), T.StructType(list(docs.schema)))
    return out
