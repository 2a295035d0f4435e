"""SentencePiece encoding and decoding through a table of distinct chunks.

The model's pieces hold the white-space marker only at their start, so no
piece, and no merge, crosses from a character to a following marker. A text
with its dummy marker is cut there into marked words. Each distinct marked
word is segmented once for a slice of texts (and kept in a bounded cache of
the worker); ids are then joined back by position.

Defined results: a null or empty text has only the begin and end ids and
decodes to the empty string; repeated rows are encoded one by one; long
chunks without a space are whole chunks; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import common

#: Distinct marked words that a task keeps; longer ones than KEPT_CHARS are not kept.
KEPT, KEPT_CHARS = 200_000, 200
MARK = "▁"
_CHUNKS = re.compile(" +[^ ]*")
_CODECS: dict = {}


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        crossing = [p for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))
                    if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces cross the white-space marker: {crossing[:3]}")
        self.bos, self.eos = (np.array([x], "<u4").tobytes() for x in (self.model.bos_id(), self.model.eos_id()))
        self.ids: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        """Marked words, each without its first marker: ``" " + text`` cut before each run of spaces."""
        text = text.replace(MARK, " ")
        if not text:
            return []
        if "  " not in text and text[0] != " ":
            return text.split(" ")
        return [c[1:] for c in _CHUNKS.findall(" " + text)]

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        mark = np.array([self.model.piece_to_id(MARK)], "<u4").tobytes()
        got = self.model.encode(chunks, num_threads=1)
        return {c: array("I", ids).tobytes() if c else mark for c, ids in zip(chunks, got)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian uint32, with begin and end ids."""
        split = [self.chunks(t or "") for t in texts]
        distinct = {c for words in split for c in words}
        distinct.difference_update(self.ids)
        fresh = self.learn(list(distinct))
        known = self.ids
        if len(known) + len(fresh) > KEPT:
            used = {c for words in split for c in words}
            known = self.ids = {c: known[c] for c in used if c in known}
        known.update(fresh)
        out = [self.bos + b"".join(map(known.__getitem__, words)) + self.eos for words in split]
        for c in fresh:
            if len(c) > KEPT_CHARS:
                del known[c]
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.model.decode([np.frombuffer(x, "<u4").tolist() for x in ids], num_threads=1)


@contextmanager
def _codec(path: str):
    """The worker's codec; the words that a task taught it go with the task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    try:
        yield _CODECS[path]
    finally:
        _CODECS[path].ids = {}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: the ids of every text, with begin and end ids."""
    common.arrow_batches(docs.sparkSession)

    def run(batches):
        with _codec(path) as codec:
            for batch in batches:
                for part in common.slices(batch):
                    ids = codec.encode(part.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32()))],
                        ["doc_id", "ids"])

    return common.narrow(docs, id_col, text_col).mapInArrow(common.lean(run), "doc_id bigint, ids array<int>")


def encode_rows(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The rows with ids and n_tokens of their text, which becomes the text decoded from the ids."""
    common.arrow_batches(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema if f.name not in ("ids", "n_tokens")])
    docs = docs.select(*schema.names)
    at = schema.names.index(text_col)

    def run(batches):
        with _codec(path) as codec:
            for batch in batches:
                for part in common.slices(batch, text_col):
                    ids = codec.encode(part.column(text_col).to_pylist())
                    columns = list(part.columns)
                    columns[at] = pa.array(codec.decode(ids), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())),
                         pa.array([len(x) // 4 for x in ids], pa.int64())], [*schema.names, "ids", "n_tokens"])

    return docs.mapInArrow(common.lean(run), T.StructType(list(schema)).add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", T.LongType()))


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text: the text of every id list (null ids: empty)."""
    common.arrow_batches(tokens.sparkSession)

    def run(batches):
        with _codec(path) as codec:
            for batch in batches:
                texts = codec.model.decode([x or [] for x in batch.column("ids").to_pylist()], num_threads=1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return (tokens.selectExpr(f"cast({id_col} as bigint) doc_id", f"{ids_col} ids")
            .mapInArrow(common.lean(run), "doc_id bigint, text string"))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one
    pass, so that neither ids nor texts leave the task."""
    common.arrow_batches(docs.sparkSession)

    def run(batches):
        with _codec(path) as codec:
            for batch in batches:
                for part in common.slices(batch):
                    ids = codec.encode(part.column("text").to_pylist())
                    texts = codec.decode(ids)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                         pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                         pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts])],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.narrow(docs, id_col, text_col).mapInArrow(
        common.lean(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
