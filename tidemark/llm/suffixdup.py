"""Removal of repeated passages by suffix sorting.

A byte goes when a LENGTH-byte string that covers it also starts in a document
with a smaller id. Three steps find those strings exactly, across documents:

1. Selection. Of the GRAM-byte grams of each LENGTH-byte string the one of
   least hash, leftmost among equals, is the string's anchor: equal strings
   have equal anchors at equal places. Strings of one anchor form one short
   run of the text. Anchors' hashes are counted over all documents (packed
   arrays, each value twice a task at most); a fixed-size bitmap of those that
   occur in two documents or more is broadcast. Wrongly passed hashes cost
   only time, and a full bitmap only means that every run goes on.
2. Two-stage sorting. Runs are dealt out by anchor, packed by task and range of
   anchors (near-equal runs lie side by side there, so they take little room on
   the way), unpacked and sorted. Equal runs are
   settled as they stream by: all but the smallest id's are covered whole. The
   distinct rest are put together into one text, whose suffixes not greater
   than their successors (by first bytes) are sorted directly; the others are
   induced by a scan of the buckets in order.
3. Adjacent common prefixes of LENGTH bytes or more tie suffixes into groups;
   the smallest id of a group covers the other documents' strings.

Hot anchors are split by the bytes next to them. A string holds half of its
other bytes, at least, on one side of its anchor: with those the anchor becomes
a longer gram, at the same place in equal strings, and each run falls into two
at most, one for each side. Anchors that many tasks hold (HOT) are split so before
they travel; one that still gathers over GROUP distinct runs in a task is split
there and dealt out anew. Each round halves the bytes beside the gram, so
after six the gram is the whole string. Equal runs that a task
gathers are settled before they travel: it sends those of the smallest id only.

Exact copies are settled beforehand by the text's hash, so they never reach
step 2 in number. Texts travel only for documents that lose bytes.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing;
a row without an id neither loses bytes nor covers others; rows that share an
id never cover one another, and repeated rows get the same result; texts of
any length are read whole; extra columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

LENGTH, GRAM = 50, 16
#: Window starts worked on at once; distinct runs sorted at once, and of one anchor at most.
PIECE, BATCH, GROUP = 1 << 18, 8_000, 12_000
#: An anchor is hot when its counts come to HOT: two at most of a task's gathering, but OFTEN of one with MANY documents.
HOT, OFTEN, MANY = 512, 8, 64
#: Bits of the bitmap of hot anchors; one that is taken for hot is split without need.
HOT_BITS = 22
#: Hashes, and bytes of text with shared runs, that a task gathers before it sends them on.
GATHERED, GATHERED_TEXT = 1 << 21, 1 << 23


# ---------------------------------------------------------------- selection

def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes that start at each place."""
    v = data.astype(np.uint64)
    for step in (1, 2, 4):
        v = v[:-step] | (v[step:] << np.uint64(8 * step))
    h = v[:-8] * np.uint64(0x9E3779B97F4A7C15) + v[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def runs(offsets: np.ndarray, data: np.ndarray, length: int = LENGTH):
    """(document, first start, last start, anchor's hash, anchor's place) of each run of strings with one anchor."""
    width = length - GRAM + 1
    out = []
    for at in range(0, max(0, len(data) - length + 1), PIECE):
        piece = data[at:at + PIECE + length - 1]
        h = _gram_hashes(piece)
        low = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        done = 1
        while done * 2 <= width:
            low = np.minimum(low[:-done], low[done:])
            done *= 2
        if width > done:
            low = np.minimum(low[:-(width - done)], low[width - done:])
        anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        starts = np.arange(at, at + len(anchor))
        doc = np.searchsorted(offsets, starts, side="right") - 1
        inside = starts + length <= offsets[doc + 1]
        starts, doc, anchor = starts[inside], doc[inside], anchor[inside]
        if not len(starts):
            continue
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        last = np.concatenate([first[1:], [len(starts)]]) - 1
        out.append((doc[first], starts[first], starts[last], common.mix(h[anchor[first]]),  # least hashes are small: spread
                    anchor[first] + at))
    if not out:
        return tuple(np.zeros(0, np.uint64 if k == 3 else np.int64) for k in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _words_hash(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at some places."""
    words = data[places[:, None] + np.arange(GRAM)].view("<u8").astype(np.uint64)
    return common.mix(words[:, 0] * np.uint64(0x9E3779B97F4A7C15) + words[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F))


def widened(data: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, length: int):
    """Runs split by the side of their anchor on which their strings have more bytes:
    (document, first start, last start, hash of the anchor with half of the other bytes on that side)."""
    more = -(-(length - GRAM) // 2)
    right = place + GRAM + more - length  # from this start on there are ``more`` bytes after the anchor
    sides = []
    for a, b, low in ((first, np.minimum(last, right - 1), place - more), (np.maximum(first, right), last, place)):
        held = a <= b
        low = low[held]
        sides.append((doc[held], a[held], b[held], common.mix(
            _words_hash(data, low) * np.uint64(0x9E3779B97F4A7C15) + _words_hash(data, low + more))))
    return tuple(np.concatenate(x) for x in zip(*sides))


def _shared_anchors(docs: DataFrame, length: int, chosen) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the anchor hashes (32 bits) that two documents or more have, and of the hot ones; ``chosen`` filters a batch's rows."""
    ranges = common.n_ranges(docs.sparkSession)

    def gather(batches):
        held, size = [], 0

        def send():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            both = np.repeat(values, np.where(counts < MANY, np.minimum(counts, 2), OFTEN))
            sent = list(common.to_ranges(both, ranges))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int32()),
                                               pa.array([b for _, b in sent], pa.binary())], ["range", "hashes"])

        for batch in batches:
            for part in common.slices(chosen(batch)):
                doc, _, _, h, _ = runs(*common.utf8(part.column("text")), length)
                if not len(h):
                    continue
                h = (h >> np.uint64(32)).astype(np.uint64)
                once = np.unique((doc.astype(np.uint64) << np.uint64(32)) | h)  # once a document
                held.append((once & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                size += len(once)
                if size >= GATHERED:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    blobs = docs.mapInArrow(common.lean(gather), "range int, hashes binary")
    counts = common.written(common.hash_counts(blobs, 2), "anchors")
    return common.bitmap(counts.select("hash")), common.bitmap(counts.where(F.col("n") >= HOT).select("hash"), HOT_BITS)


# ---------------------------------------------------------------- runs on their way

_RUNS = "anchor bigint, doc_id bigint, mark int, start bigint, stop bigint, run binary"  # run null: settled already


def _planes(values: np.ndarray) -> bytes:
    """uint32 values, their lowest bytes first, then the next and so on."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _values(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack(anchor: np.ndarray, doc: np.ndarray, ids: np.ndarray, marks: np.ndarray,
         start: np.ndarray, found: list[bytes]) -> bytes:
    """Runs in order of their anchors (uint32), in one compressed array; ``doc``
    is each run's place in ``ids`` and ``marks``, of which only those in use are written."""
    used, doc = np.unique(doc, return_inverse=True)
    return zstandard.ZstdCompressor(level=3).compress(b"".join((
        np.array([len(anchor), len(used)], "<u4").tobytes(), common.packed(anchor), _planes(doc), _planes(start),
        _planes(np.array([len(r) for r in found])), ids[used].astype("<i8").tobytes(), marks[used].astype("<i4").tobytes(),
        *found)))


def unpack(blob: bytes):
    """(anchor, doc_id, mark, start, list of runs) of :func:`pack`'s array."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, d = (int(x) for x in raw[:8].view("<u4"))
    at = 8 + 16 * n
    start, size = _values(raw[8 + 8 * n:8 + 12 * n]), _values(raw[8 + 12 * n:at])
    doc = _values(raw[8 + 4 * n:8 + 8 * n])
    ids = np.frombuffer(raw[at:at + 8 * d].tobytes(), "<i8")
    marks = np.frombuffer(raw[at + 8 * d:at + 12 * d].tobytes(), "<i4")
    ends = np.cumsum(size.astype(np.int64)).tolist()
    text = raw[at + 12 * d:].tobytes()
    return (common.unpacked(raw[8:8 + 4 * n].tobytes()), ids[doc], marks[doc], start,
            [text[a:b] for a, b in zip([0, *ends], ends)])


def settled(raw: bytes, anchor: np.ndarray, ids: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which runs an equal one (bytes ``at`` .. ``to`` of ``raw``) with a smaller id covers; anchors are in order."""
    gone = np.zeros(len(anchor), bool)
    same = anchor[1:] == anchor[:-1]
    several = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
    least: dict[bytes, int] = {}
    found = []
    for k, i, a, b in zip(several.tolist(), ids[several].tolist(), at[several].tolist(), to[several].tolist()):
        run = raw[a:b]
        found.append((k, i, run))
        if i < least.setdefault(run, i):
            least[run] = i
    gone[[k for k, i, run in found if i > least[run]]] = True
    return gone


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Stretches of documents, those that meet made one; all of one width or more, so stops follow starts."""
    order = np.lexsort((stop, start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])]) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[:len(first)] - 1
    return doc[first], start[first], stop[last]


def _unpacked(batches):
    """Rows of ``_RUNS`` from packed runs and settled stretches."""
    for batch in batches:
        for blob, done in zip(batch.column("runs"), batch.column("settled")):
            if blob.is_valid:
                anchor, ids, marks, start, found = unpack(blob.as_py())
                stop, anchor = start + np.array([len(r) for r in found], np.int64), anchor.astype(np.int64)
            else:
                ids, marks, start, stop = np.frombuffer(done.as_py(), "<i8").reshape(4, -1)
                anchor, found = np.full(len(ids), -1), [None] * len(ids)
            rows = pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(ids), pa.array(marks.astype(np.int32)), pa.array(start.astype(np.int64)),
                 pa.array(stop.astype(np.int64)), pa.array(found, pa.binary())], ["anchor", "doc_id", "mark", "start", "stop", "run"])
            for at in range(0, rows.num_rows, 8192):
                yield rows.slice(at, 8192)


# ---------------------------------------------------------------- two-stage sorting

def sorted_suffixes(text: np.ndarray, places: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes at ``places`` by their first ``length`` bytes at
    least, and those bytes as words, a column for each eight.

    ``places`` are consecutive within a run; ``last`` marks a run's last one,
    which is not greater than its successor and so is sorted directly. Columns
    are gathered and sorted by one after another, so that the keys are held once.
    """
    n = len(places)
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)
    keys = [eight[places + k].view(">u8").ravel().astype(np.uint64) for k in range(0, length, 8)]
    keys[-1] &= np.uint64((1 << 64) - (1 << 8 * (-length % 8)))
    first = text[places]
    induced = np.zeros(n, bool)
    induced[:-1] = ~last[:-1] & (first[:-1] > first[1:])
    direct = np.flatnonzero(~induced)
    for key in reversed(keys):
        direct = direct[np.argsort(key[direct], kind="stable")]
    cuts = np.searchsorted(first[direct], np.arange(257))
    has_before = np.concatenate([[False], ~last[:-1]])
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for c in range(256):
        # greater than their successors, these came from earlier buckets and precede the bucket's others
        bucket = np.concatenate([*buckets[c], direct[cuts[c]:cuts[c + 1]]])
        buckets[c] = []
        if not len(bucket):
            continue
        order.append(bucket)
        bucket = bucket.astype(np.int64)
        before = bucket[has_before[bucket]] - 1
        before = before[induced[before]]
        heads = first[before]
        for head in np.unique(heads):
            buckets[head].append(before[heads == head])
    return np.concatenate(order).astype(np.int64), keys


def covered(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(run, first, last start) of the strings that a run with a smaller id holds too."""
    sizes = np.array([len(t) for t in texts])
    base = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(texts) + bytes(length), np.uint8)
    starts = sizes - length + 1
    # a run goes on to the next suffix that is sorted directly, from which its last string is induced
    direct = text[:-1] <= text[1:]
    direct[base + sizes - 1] = True
    following = np.where(direct, np.arange(len(direct)), len(direct))
    following = np.minimum.accumulate(following[::-1])[::-1]
    counts = following[base + starts - 1] - base + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    order, keys = sorted_suffixes(text, base[owner] + inside, inside == counts[owner] - 1, length)
    order = order[inside[order] < starts[owner[order]]]
    same = np.ones(len(order), bool)  # as the suffix before: a common prefix of `length` bytes
    same[:1] = False
    for key in keys:
        key = key[order]
        same[1:] &= key[1:] == key[:-1]
    group = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(ids[owner[order]], group), np.diff(np.append(group, len(order))))
    hit = np.zeros(len(owner), bool)
    hit[order] = ids[owner[order]] > least
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])])
    first = at[np.flatnonzero(new)]
    final = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    return list(zip(owner[first].tolist(), inside[first].tolist(), inside[final].tolist()))


_FOUND = "doc_id bigint, mark int, start bigint, stop bigint, run binary, low int"


def _anchor_place(run: bytes, length: int) -> int:
    """Where in a run the anchor of its strings is."""
    return int(np.argmin(_gram_hashes(np.frombuffer(run[:length], np.uint8)) >> np.uint64(24)))


def _cover(length: int, again: bool = False):
    """Streams runs sorted by (anchor, run, doc_id) to covered stretches; runs of too
    large an anchor come back, with the place of the gram that they share (``again``: as given in ``low``)."""
    def work(batches):
        held: list[tuple] = []  # (doc_id, mark, start, run) of whole anchors, then of the present one
        whole = 0
        anchor = run = least = None
        large = False
        out: list[tuple] = []

        def too_many(d, mark, start, r, low):
            return d, mark, start, start, r, low if again else _anchor_place(r, length)

        def settle(k):
            if k:
                for i, a, b in covered([x[3] for x in held[:k]], np.array([x[0] for x in held[:k]]), length):
                    d, mark, start = held[i][:3]
                    out.append((d, mark, start + a, start + b + length, None, None))

        def sent():
            cols = list(zip(*out)) if out else [()] * 6
            out.clear()
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                              ["doc_id", "mark", "start", "stop", "run", "low"])

        for batch in batches:
            lows = batch.column("low").to_pylist() if again else [None] * batch.num_rows
            for h, d, mark, start, stop, r, low in zip(
                    *(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "mark", "start", "stop", "run")), lows):
                if len(out) >= 4096:
                    yield sent()
                if r is None:
                    out.append((d, mark, start, stop, None, None))
                    continue
                if h != anchor:
                    if len(held) >= BATCH:
                        settle(len(held))
                        held = []
                    anchor, run, whole, large = h, None, len(held), False
                if r == run and d > least:
                    out.append((d, mark, start, stop, None, None))
                    continue
                if r != run:
                    run, least = r, d
                if large:
                    out.append(too_many(d, mark, start, r, low))
                    continue
                held.append((d, mark, start, r, low))
                if len(held) - whole > GROUP:
                    out.extend(too_many(*x) for x in held[whole:])
                    del held[whole:]
                    large = True
        settle(len(held))
        yield sent()

    return work


def _split(runs_: DataFrame, width: int, length: int) -> DataFrame:
    """Runs with a shared gram of ``width`` bytes at ``low``, split as in :func:`widened`:
    rows of ``_RUNS`` and the place ``low`` of the wider gram, whose hash is the new anchor."""
    more = -(-(length - width) // 2)
    starts = F.octet_length("run") - (length - 1)
    right = F.greatest(F.lit(0), F.least(starts, F.col("low") + (width + more - length)))

    def side(first, count, low):
        return F.struct(F.xxhash64(F.substring("run", low + 1, F.lit(width + more))).alias("anchor"), "doc_id", "mark",
                        (F.col("start") + first).alias("start"), (F.col("start") + first + count + (length - 1)).alias("stop"),
                        F.substring("run", first + 1, count + (length - 1)).alias("run"),
                        (low - first).cast("int").alias("low"), (count > 0).alias("held"))

    both = F.array(side(F.lit(0), right, F.col("low") - more), side(right, starts - right, F.col("low")))
    return runs_.select(F.inline(F.filter(both, lambda x: x["held"]))).drop("held")


# ---------------------------------------------------------------- the operator

def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, mark, sha): mark tells rows of one id apart."""
    return (common.narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("mark", F.hash("text")).withColumn("sha", F.sha2(F.encode("text", "UTF-8"), 256)))


def copies_of(base: DataFrame, length: int) -> DataFrame:
    """(doc_id, mark, sha, least) of each row with an id, and the least id of its text, where a string fits."""
    rows = base.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)).select("doc_id", "mark", "sha")
    least = rows.groupBy("sha").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "sha")


def stretches(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, start, stop): covered bytes of documents; those of one
    document may overlap. Written to the shared folder."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    base = _identified(docs, id_col, text_col)
    classes = common.written(copies_of(base, length), "copies")
    firsts = spark.sparkContext.broadcast(common.bitmap(
        classes.where("doc_id = least").select(F.xxhash64("doc_id").alias("h"))))
    keyed = base.where(F.col("doc_id").isNotNull()).select("doc_id", "mark", F.xxhash64("doc_id").alias("h"), "text")

    def of_firsts(batch):
        return batch.filter(pa.array(common.in_bitmap(firsts.value, batch.column("h").to_numpy().view(np.uint64))))

    often, most = _shared_anchors(keyed.select("h", "text"), length, of_firsts)
    shared, hot = spark.sparkContext.broadcast(often), spark.sparkContext.broadcast(most)

    ranges = common.n_ranges(spark)

    def ship(batches):
        held, size, docs_held = [], 0, 0

        def send():
            anchor, doc, start, at, to = (np.concatenate([x[k] for x in held]) for k in range(5))
            ids, marks = (np.concatenate([x[k] for x in held]) for k in (5, 6))
            raw = b"".join(x[7] for x in held)
            order = np.argsort(anchor, kind="stable")
            anchor, doc, start, at, to = (x[order] for x in (anchor, doc, start, at, to))
            gone = settled(raw, anchor, ids[doc], at, to)
            done = merged(doc[gone], start[gone].astype(np.int64), (start + to - at)[gone].astype(np.int64))
            anchor, doc, start, at, to = (x[~gone] for x in (anchor, doc, start, at, to))
            cuts = np.searchsorted(anchor, (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges))
            sent = [(k, pack(anchor[a:b], doc[a:b], ids, marks, start[a:b], [raw[x:y] for x, y in zip(at[a:b].tolist(), to[a:b].tolist())]))
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
            to_range, blobs, stretches_ = [k for k, _ in sent], [b for _, b in sent], [None] * len(sent)
            if gone.any():
                to_range.append(int(ids[done[0][0]]) % ranges)
                blobs.append(None)
                stretches_.append(b"".join(x.astype("<i8").tobytes() for x in (ids[done[0]], marks[done[0]], *done[1:])))
            return pa.RecordBatch.from_arrays([pa.array(to_range, pa.int32()), pa.array(blobs, pa.binary()),
                                               pa.array(stretches_, pa.binary())], ["range", "runs", "settled"])

        for batch in batches:
            for part in common.slices(of_firsts(batch)):
                offsets, data = common.utf8(part.column("text"))
                doc, first, last, h, place = runs(offsets, data, length)
                h >>= np.uint64(32)
                kept = common.in_bitmap(shared.value, h)
                if not kept.any():
                    continue
                doc, first, last, h, place = (x[kept] for x in (doc, first, last, h, place))
                split = common.in_bitmap(hot.value, h)
                if split.any():
                    *wide, key = widened(data, *(x[split] for x in (doc, first, last, place)), length)
                    parts = zip((doc[~split], first[~split], last[~split], h[~split]), (*wide, key >> np.uint64(32)))
                    doc, first, last, h = (np.concatenate(x) for x in parts)
                held.append((h, doc + docs_held, first - offsets[doc], first + size, last + length + size,
                             *(part.column(c).to_numpy() for c in ("doc_id", "mark")), data.tobytes()))
                docs_held += part.num_rows
                size += len(data)
                if size >= GATHERED_TEXT:
                    yield send()
                    held, size, docs_held = [], 0, 0
        if held:
            yield send()

    found = common.written(
        keyed.mapInArrow(common.lean(ship), "range int, runs binary, settled binary").repartitionById(ranges, F.col("range"))
        .mapInArrow(common.lean(_unpacked), _RUNS).sortWithinPartitions("anchor", "run", "doc_id")
        .mapInArrow(common.lean(_cover(length)), _FOUND), "stretches")
    out, width = found.where("run is null").select("doc_id", "mark", "start", "stop"), GRAM
    while width < length:  # six rounds at most, for what is left
        rest = found.where("run is not null")
        if rest.isEmpty():
            break
        found = common.written(
            _split(rest, width, length).repartition(ranges, "anchor").sortWithinPartitions("anchor", "run", "doc_id")
            .mapInArrow(common.lean(_cover(length, True)), _FOUND), "stretches")
        out = out.unionByName(found.where("run is null").select("doc_id", "mark", "start", "stop"))
        width += -(-(length - width) // 2)
    whole = (classes.where("doc_id > least").select("doc_id", "mark", F.lit(0).cast("bigint").alias("start"),
                                                    F.lit(-1).cast("bigint").alias("stop")))  # to the end
    return out.unionByName(whole)


def cut(text: bytes, spans: list[tuple[int, int]], characters: bool = False) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without its covered bytes, and the maximal runs of those. With
    ``characters`` what is left of a character that a run's edge cuts goes too."""
    merged: list[list[int]] = []
    for a, b in sorted((a, len(text) if b < 0 else b) for a, b in spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    if characters:  # a valid text's stretch is invalid only where it begins or ends inside a character
        kept = [k.decode(errors="ignore").encode() for k in kept]
    return b"".join(kept), [(a, b) for a, b in merged]


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """doc_id, kept binary (``characters``: whole ones only), removed array<struct<start, stop>>,
    carried struct (the columns named in ``carry``) of every document.

    Documents without a covered byte are passed on where they are read; only
    the others meet their stretches in a shuffle.
    """
    spark = docs.sparkSession
    found = stretches(docs, length, id_col, text_col)
    touched = spark.sparkContext.broadcast(common.bitmap(found.select(F.xxhash64("doc_id").alias("h"))))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("bigint")
    base = docs.select(doc_id.alias("doc_id"), F.hash(text).alias("mark"), F.xxhash64(doc_id).alias("h"), text.alias("text"),
                       F.struct(F.lit(None).cast("string").alias("_"), *carry).alias("carried"))
    kind = T.StructType([f for f in base.schema if f.name != "h"])

    def split(want):
        def work(batches):
            for batch in batches:
                got = common.in_bitmap(touched.value, batch.column("h").to_numpy().view(np.uint64))
                yield batch.filter(pa.array(got if want else ~got)).select(kind.names)
        return work

    spans_kind = "array<struct<start: bigint, stop: bigint>>"
    whole = base.mapInArrow(common.lean(split(False)), kind).select(
        "doc_id", F.encode("text", "UTF-8").alias("kept"), F.array().cast(spans_kind).alias("removed"), "carried")
    spans = found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # of one document
    joined = base.mapInArrow(common.lean(split(True)), kind).join(spans, ["doc_id", "mark"], "left")

    def apply(batches):
        for batch in batches:
            kept, removed = [], []
            for text, stretch in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                left, gone = cut(text.encode(), [(s["start"], s["stop"]) for s in stretch or ()], characters)
                kept.append(left)
                removed.append([{"start": a, "stop": b} for a, b in gone])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), batch.column("carried")],
                ["doc_id", "kept", "removed", "carried"])

    return whole.unionByName(joined.select("doc_id", "text", "spans", "carried").mapInArrow(common.lean(apply), whole.schema))


def summary(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of :func:`remove`'s rows."""
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, r: s + (r["stop"] - r["start"]))
    return removed.select("doc_id", (F.octet_length("kept") + gone).cast("bigint").alias("n_bytes"),
                          gone.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))
