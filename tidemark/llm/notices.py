"""Fuzzy search for short licence notices, and exact phrase places.

A text is reduced to its words (A-Z lower-cased, maximal runs of digits,
letters and non-ASCII characters) joined by one space. A notice that may hold
k edits is split into k + 1 pieces: by the pigeonhole principle one of them
stands unedited in every fuzzy occurrence. One Aho-Corasick pass finds all
pieces; around each hit the regex library's bounded-error matching verifies
the notice and counts its edits. What tells a notice from its like (KEYS) must
stand in the span too, with one edit at most for each KEY_CHARS characters, so
that edits can't turn one licence into another.

Defined results: a null or empty text has no words, places or spans; texts of
any length are searched as a whole; repeated rows are searched one by one;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Exact phrases and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices searched with edits, and their labels.
NOTICES = {
    "licensed under the gnu general public license": "gpl",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "licensed under cc by": "cc-by",
    "all rights reserved": "reserved",
    "general public license": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "this work is dedicated to the public domain": "public-domain",
}
#: The words of each notice that tell it from others.
KEYS = {
    "licensed under the gnu general public license": "general",
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "licensed under cc by": "cc by",
    "all rights reserved": "reserved",
    "general public license": "general",
    "permission is hereby granted free of charge to any person obtaining a copy": "free of charge to any person obtaining",
    "redistribution and use in source and binary forms": "source and binary",
    "subject to the terms of the mozilla public license": "mozilla",
    "this work is dedicated to the public domain": "public domain",
}
#: Characters of a notice, and of its key, for each edit that they may hold.
CHARS_AN_EDIT, KEY_CHARS = 10, 6

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def edits(notice: str, chars_an_edit: int = CHARS_AN_EDIT) -> int:
    return len(notice) // chars_an_edit


def words(text: bytes) -> list[bytes]:
    """The text's words: ASCII other than digits and letters separates them."""
    return text.translate(_WORDS).split()


class Scanner:
    def __init__(self, phrases: dict[str, str], notices: dict[str, str], chars_an_edit: int, keys: dict[str, str] = KEYS):
        import ahocorasick
        import regex

        self.phrases = [(f" {p} ", label) for p, label in phrases.items()]
        self.notices = [(n, label, edits(n, chars_an_edit)) for n, label in notices.items()]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in self.notices]
        self.keys = [regex.compile(rf"(?<!\S)(?:{regex.escape(keys[n])}){{e<={len(keys[n]) // KEY_CHARS}}}(?!\S)") if n in keys else None
                     for n, _, _ in self.notices]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k) in enumerate(self.notices):
            for j in range(k + 1):
                at, to = len(n) * j // (k + 1), len(n) * (j + 1) // (k + 1)
                pieces.setdefault(n[at:to], []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        if pieces:
            self.seeds.make_automaton()
        self.has_seeds = bool(pieces)
        self.verify = lru_cache(20_000)(self._verify)

    def _verify(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of notice i's best place in a window, if its key stands there."""
        got = self.patterns[i].search(window)
        if got and self.keys[i] and not self.keys[i].search(window, got.start(), got.end()):
            return None
        return got and (got.start(), got.end(), sum(got.fuzzy_counts))

    def scan(self, text: bytes) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int, int]]]:
        """Words; exact places (label, first word); spans (label, first word, last word, edits)."""
        parts = words(text)
        line = b" ".join(parts).decode("latin-1")  # a character for each byte, as the seeds are ASCII
        padded, places = f" {line} ", []
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)

        def word(at: int) -> int:
            return int(np.searchsorted(blanks, at))

        for phrase, label in self.phrases:
            at = padded.find(phrase)
            while at >= 0:
                places.append((label, word(at)))
                at = padded.find(phrase, at + 1)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        tried: dict[int, set[int]] = {}
        for end, (size, owners) in self.seeds.iter(line) if self.has_seeds else ():
            for i, offset in owners:
                notice, _, k = self.notices[i]
                start = end + 1 - size - offset
                seen = tried.setdefault(i, set())
                if start in seen:
                    continue
                seen.add(start)
                if start >= 0 and line.startswith(notice, start):
                    found[i, start] = (start + len(notice), 0)
                    continue
                lo = max(0, start - k)
                got = self.verify(i, line[lo:start + len(notice) + k])
                if got:
                    found[i, lo + got[0]] = min(found.get((i, lo + got[0]), (lo + got[1], got[2])), (lo + got[1], got[2]), key=lambda x: x[1])
        spans = []
        last: dict[int, tuple[int, int, int]] = {}
        for (i, start), (end, n) in sorted(found.items()):  # overlapping places of a notice: the one of fewest edits
            kept = last.get(i)
            if kept and start < kept[1]:
                if n < kept[2]:
                    last[i] = spans[-1] = (start, end, n, i)
                continue
            last[i] = (start, end, n, i)
            spans.append(last[i])
        return len(parts), places, [(self.notices[i][1], word(a), word(max(a, b - 1)), n)
                                    for a, b, n, i in sorted(spans, key=lambda s: (s[0], s[3]))]


_SCANNERS: dict = {}

FOUND = ("doc_id bigint, n_words bigint, places array<struct<label: string, word: bigint>>, "
         "spans array<struct<label: string, first_word: bigint, last_word: bigint, edits: int, similarity: double>>")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES,
         chars_an_edit: int = CHARS_AN_EDIT, keys: dict[str, str] = KEYS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places of exact phrases, spans of notices with their edits."""
    common.arrow_batches(docs.sparkSession)
    key = (tuple(phrases.items()), tuple(notices.items()), chars_an_edit, tuple(keys.items()))
    longest = {}
    for notice, label in notices.items():
        longest[label] = max(longest.get(label, 0), len(notice))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                                      ("edits", pa.int32()), ("similarity", pa.float64())])))])

    def run(batches):
        if key not in _SCANNERS:
            _SCANNERS[key] = Scanner(dict(key[0]), dict(key[1]), key[2], dict(key[3]))
        scanner = _SCANNERS[key]
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "n_words": [], "places": [], "spans": []}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n, places, spans = scanner.scan(text or b"")
                out["n_words"].append(n)
                out["places"].append([{"label": a, "word": w} for a, w in places])
                out["spans"].append([{"label": a, "first_word": f, "last_word": w, "edits": e,
                                      "similarity": 1.0 - e / longest[a]} for a, f, w, e in spans])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return common.narrow(docs, id_col, text_col).mapInArrow(run, FOUND)


def summary(found: DataFrame) -> DataFrame:
    """One row for each text of :func:`scan`: labels, first and last place, score."""
    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, fuzzy = F.col("places.label"), F.col("spans.label")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, fuzzy)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.similarity"), F.lit(0.0))).alias("score"),
        F.size("spans").cast("bigint").alias("n_spans"))
