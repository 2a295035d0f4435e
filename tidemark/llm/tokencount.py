"""Token counts by a map-side two-tier lookup.

A text is cut before each space that follows a character other than white
space; no merge of the tokenizer crosses such a cut, so a text's count is the
sum over its pre-tokens. Tier one is a broadcast table of about the corpus's most
frequent pre-tokens with their lengths in tokens, of bounded size: tasks forget
rare ones while they count and offer their most frequent only, so the choice is
approximate, which costs speed and never a count. Tier two is
a bounded cache in each worker, which the tokenizer's library fills with what
the table lacks. No pre-token of a text is shuffled; only each task's
candidates for the table are.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted one by one; special strings inside a text are handled by the
library as it does by default; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Pre-tokens in the broadcast table, and the longest that it takes.
TABLE_ROWS, TABLE_CHARS = 32_768, 48
#: Candidates that a task offers, and distinct ones that it counts at a time.
OFFERED, COUNTED = 16_384, 400_000
#: Pre-tokens in a worker's cache; longer ones than CACHE_CHARS are not kept.
CACHE_ROWS, CACHE_CHARS = 400_000, 256
LIMIT = 1024

# white space as the tokenizer's pattern has it; a run of it stays in one piece
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_AFTER_SPACE = re.compile(f"[{_SPACE}] ")
_PIECES = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Marks a piece that is stored whole; no text holds a lone surrogate.
_WHOLE = "\udfff"
_PLAIN = re.compile(r"[\x00-\u017f]*")
_MODELS: dict = {}


def pretokens(text: str) -> list[str]:
    """The text's pieces. A piece is stored without the space that it begins
    with; the first, and each of a text with runs of white space, is stored
    whole and marked."""
    if not text:
        return []
    if text[0] == " " or _AFTER_SPACE.search(text):
        return [_WHOLE + p for p in _PIECES.findall(text)]
    first, *rest = text.split(" ")
    return [_WHOLE + first, *rest]


def whole(piece: str) -> str:
    return piece[1:] if piece[:1] == _WHOLE else " " + piece


class Lengths:
    """Token counts of pieces: the broadcast table, then a bounded cache.

    A piece that neither holds is encoded with the file's own merges: plain
    ones by the quicker of two public byte-level BPE libraries, ones with a
    special string or rarer characters by the file's own library.
    """

    def __init__(self, path: str, table: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.quick = self._quick()
        self.table, self.cache = table, dict(table)

    def _quick(self):
        """The same merges in the quicker library, where ids follow the order of merges."""
        import json

        import tiktoken

        file = json.loads(self.model.to_str())
        alphabet = [*range(33, 127), *range(161, 173), *range(174, 256)]
        symbols = {chr(b): b for b in alphabet}
        symbols |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(alphabet))}
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        in_order = all(vocab["".join(m if isinstance(m, list) else m.split(" "))] == 256 + k for k, m in enumerate(merges))
        if not in_order or file["normalizer"] or file["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            return None
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {bytes(symbols[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding("from_file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def learn(self, pieces) -> dict[str, int]:
        """Lengths of pieces that the cache lacks."""
        texts = {p: whole(p) for p in pieces}
        plain = {p for p, t in texts.items() if self.quick and _PLAIN.fullmatch(t) and not any(s in t for s in self.special)}
        found = {p: len(self.quick.encode_ordinary(texts[p])) for p in plain}
        other = [p for p in texts if p not in plain]
        got = self.model.encode_batch_fast([texts[p] for p in other], add_special_tokens=False)
        found.update((p, len(e)) for p, e in zip(other, got))
        return found

    def count(self, texts: list[str | None]) -> list[int]:
        split = [pretokens(t or "") for t in texts]
        distinct = set().union(*split)
        missing = distinct.difference(self.cache)
        fresh = self.learn(missing)
        if len(self.cache) + len(fresh) > CACHE_ROWS:
            known = self.cache = {**self.table, **{p: self.cache[p] for p in distinct if p in self.cache}}
        known = self.cache
        known.update(fresh)
        out = [sum(map(known.__getitem__, pieces)) for pieces in split]
        for p in fresh:
            if len(p) > CACHE_CHARS:
                del known[p]
        return out


class _Table:
    """The broadcast table under a name, by which a worker knows that it has it already."""

    def __init__(self, name: str, shared):
        self.id, self.shared = name, shared

    @property
    def value(self):
        return self.shared.value


def _model(path: str, table) -> Lengths:
    key = (path, table.id)
    if key not in _MODELS:
        _MODELS.clear()
        names, lengths = table.value
        _MODELS[key] = Lengths(path, dict(zip(names.split("\x01"), lengths)) if lengths else {})
    return _MODELS[key]


def frequent(docs: DataFrame, path: str, rows: int = TABLE_ROWS) -> dict[str, int]:
    """About the corpus's most frequent pre-tokens with their token counts, ``rows`` at most.

    Every text is read. A task keeps a quarter of COUNTED pre-tokens whenever it
    holds more than COUNTED, offers its OFFERED most frequent, never those marked
    whole, and counts are summed; what it forgets could only cost speed.
    """
    def offer(batches):
        seen: Counter = Counter()
        for batch in batches:
            for part in common.slices(batch):
                for text in part.column("text").to_pylist():
                    seen.update(pretokens(text or ""))
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        best = [(p, n) for p, n in seen.most_common(OFFERED) if len(p) <= TABLE_CHARS and p[:1] != _WHOLE and "\x01" not in p]
        yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in best], "n": [n for _, n in best]},
                                         schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]))

    top = (docs.select("text").mapInArrow(offer, "piece string, n bigint")
           .groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(rows).collect())
    return Lengths(path, {}).learn([r["piece"] for r in top])


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text", table_rows: int = TABLE_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every text."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    docs = common.narrow(docs, id_col, text_col)
    found = frequent(docs, path, table_rows)
    shared = spark.sparkContext.broadcast(("\x01".join(found), tuple(found.values())))
    table = _Table(uuid.uuid4().hex, shared)

    def count(batches):
        for batch in batches:
            for part in common.slices(batch):
                offsets, _ = common.utf8(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(offsets[1:] - offsets[:-1], pa.int64()),
                     pa.array(_model(path, table).count(part.column("text").to_pylist()), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    return (docs.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
