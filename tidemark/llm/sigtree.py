"""N-gram Jaccard join by signature trees.

Two documents link when the Jaccard similarity of their sets of distinct word
shingles is PERCENT / 100 or more. The join is exact on 64-bit shingle hashes.

1. Documents of equal sets are one class; only its first document goes on.
2. Shingles are counted over all classes (packed arrays of their hashes' first bits,
   as many as tell so many shingles apart but for one in 64). Each set is
   ordered: shingles of its own first, then ones of two classes or more, then
   widespread ones. Two sets that link share one of the first
   ``n - ceil(0.75 n) + 1`` of their shingles, so classes meet in the groups of
   those: a class with a quarter of its own meets none, and a passage that many
   documents share does not bring them together. Shingles under which one class stands
   alone are dropped, and sets are made for the classes that then meet others only.
3. First rounds: each class is compared with the most central class (the
   smallest share of shingles of its own) that it meets in VOTES of its groups.
   Widespread groups are dealt over SALTS tasks by class; a further round joins
   what the salts kept apart. That settles the large groups of near copies with
   one comparison a class.
4. Last round, over groups that still hold more than one component. Groups with
   the same first class are one bundle (near copies meet in many groups, mostly
   with the same first class, so their sets travel once or twice instead of
   once a group). A bundle's
   classes become leaves of a signature tree, whose nodes hold OR-combined
   shingle bitmaps, size ranges and component ranges. A dual traversal from the
   root drops node pairs of one component, of sizes too far apart, or whose
   largest possible overlap is too small. Bundles over CELL classes or
   CELL_SHINGLES shingles are cut into cells, a pair of blocks each.
5. What survives is compared exactly where it is found, unless links found before
   already join the two: a cell gives at most one link less than it has
   classes, however many pairs link. Links join components.

The bitmaps that are broadcast have 16 MB, that of shared shingles up to 64 (see common.filter_bits);
false positives cost time, and eight bytes each until they are dropped, never results.

Defined results: a null text and one without words have an empty set, link
with nothing and are their own component; with fewer words than a shingle the
whole sequence is the one shingle; repeated rows are one class; a row without
an id takes part, and its component is the smallest id reached (null if none);
texts of any length are read whole; extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.components import components

SHINGLE, PERCENT = 5, 75
#: Share of a class's groups in which another must come first to be compared in the first round.
VOTES = 0.3
#: Classes that may hold a shingle before it counts as widespread.
WIDESPREAD = 64
#: Classes of one bundle, and their shingles, that make a block; children of a tree node; node pairs looked at together.
CELL, CELL_SHINGLES, FAN, PAIRS = 4096, 1 << 22, 8, 4096
#: Sets compared with one at once.
TOGETHER = 64
#: Tasks that share one widespread shingle's group in the first round.
SALTS = 16
GATHERED = 1 << 21
#: Shingles are counted by hashes of so many bits more than their number has: by fewer, ones that
#: are no one else's would pass for shared, and each class would meet others by chance.
ROOM = 6

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.full(n, x, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lower-cased, cut at white space), and each text's number of words."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[data]
    first = space[:-1] & ~space[1:]  # at a word's first byte
    last = ~space[:-1] & space[1:]  # just after its last byte
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    inner = edge[~space[edge] & ~space[edge + 1]]  # texts that meet inside a word
    first[inner], last[inner] = True, True
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
    h = common.mix((total[b] - total[a]) * _powers(_INVERSE, len(data) + 1)[a] + (b - a).astype(np.uint64))
    cuts = np.searchsorted(a, offsets)
    return h, np.diff(cuts)


def shingles(offsets: np.ndarray, data: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    if not len(offsets) - 1:
        return []
    h, counts = words(offsets, data)
    mult = [np.uint64(pow(_BASE, k + 2, 1 << 64)) for k in range(size)]
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    n = len(h)
    all_h = sum((padded[k:k + n] * mult[k] for k in range(size)), np.zeros(n, np.uint64))
    all_h = common.mix(all_h)
    out, at = [], 0
    for c in counts.tolist():
        if c >= size:
            out.append(np.unique(all_h[at:at + c - size + 1]))
        elif c:
            out.append(common.mix((h[at:at + c] * np.array(mult[:c])).sum(keepdims=True, dtype=np.uint64) + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def set_key(shingle_set: np.ndarray) -> int:
    """A hash of a whole set, as a signed 64-bit number."""
    total = common.mix(shingle_set).sum(dtype=np.uint64) + np.uint64(len(shingle_set))
    return int(common.mix(np.array([total], np.uint64)).view(np.int64)[0])


def needed(a, b, percent: int = PERCENT):
    """Least overlap with which sets of sizes a and b link: o >= p (a + b) / (100 + p)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _size_class(n: int) -> int:
    return n.bit_length() - 1


def signature(shingle_set: np.ndarray) -> bytes:
    """Bitmap of a set: 8 x the power of two not above its size, in bits (a byte at least)."""
    bits = 8 << _size_class(len(shingle_set))
    low = (shingle_set & np.uint64(bits - 1)).astype(np.int64)
    packed = np.zeros(bits, np.uint8)
    packed[low] = 1
    return np.packbits(packed, bitorder="little").tobytes()


# ---------------------------------------------------------------- signature trees

class Tree:
    """Levels of nodes, leaves first: bitmaps, size and component ranges, and
    ``hidden``, the most shingles of a member that share a bit with others."""

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        hidden = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmaps, sizes, sizes, comps, comps, hidden)]
        while len(self.levels[-1][0]) > 1:
            m, lo, hi, c0, c1, hid = self.levels[-1]
            at = np.arange(0, len(m), FAN)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                                np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at), np.maximum.reduceat(hid, at)))


def traverse(a: Tree, b: Tree | None, percent: int = PERCENT) -> np.ndarray:
    """Leaf pairs of two trees, or of one with itself, that may link and are of different components."""
    return np.concatenate([np.zeros((0, 2), np.int64), *walk(a, b, percent)])


def walk(a: Tree, b: Tree | None, percent: int = PERCENT) -> Iterator[np.ndarray]:
    """The same, a block of pairs at a time."""
    own = b is None
    b = a if own else b

    def alive(la, lb, i, j):
        m, lo, hi, c0, c1, hid = (x[i] for x in a.levels[la])
        m2, lo2, hi2, c02, c12, hid2 = (x[j] for x in b.levels[lb])
        keep = ~((c0 == c1) & (c02 == c12) & (c0 == c02))
        keep &= (100 * hi >= percent * lo2) & (100 * hi2 >= percent * lo)
        both = np.bitwise_count(m & m2).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(hid, hid2) + both, np.minimum(hi, hi2))
        return keep & (most >= needed(lo, lo2, percent))

    top = (len(a.levels) - 1, len(b.levels) - 1)
    stack = [(*top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > PAIRS:
            stack += [(la, lb, i[k:k + PAIRS], j[k:k + PAIRS]) for k in range(0, len(i), PAIRS)]
            continue
        keep = alive(la, lb, i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == lb == 0:
            if own:
                i, j = i[i < j], j[i < j]
            yield np.stack([i, j], axis=1)
            continue

        def down(level, nodes, tree):
            if not level:
                return nodes[:, None]
            kids = nodes[:, None] * FAN + np.arange(FAN)
            return np.where(kids < len(tree.levels[level - 1][0]), kids, -1)

        ki, kj = down(la, i, a), down(lb, j, b)
        x, y = np.broadcast_arrays(ki[:, :, None], kj[:, None, :])
        x, y = x.reshape(-1), y.reshape(-1)
        good = (x >= 0) & (y >= 0)
        if own:
            good &= x <= y
        stack.append((max(0, la - 1), max(0, lb - 1), x[good], y[good]))


def leaf_pairs(keys: np.ndarray, sizes: np.ndarray, comps: np.ndarray, signatures: list[bytes],
               side: np.ndarray | None = None, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group's classes (their numbers) that may link, in blocks. With ``side``: only pairs across its two sides.

    A tree for each size class and side; pairs within a class and with the next.
    """
    classes = np.array([_size_class(int(n)) for n in sizes])
    side = np.zeros(len(keys), np.int64) if side is None else side
    trees = {}
    for c, s in sorted(set(zip(classes.tolist(), side.tolist()))):
        at = np.flatnonzero((classes == c) & (side == s))
        at = at[np.lexsort((keys[at], sizes[at], comps[at]))]
        m = np.frombuffer(b"".join(signatures[k] for k in at), np.uint8).reshape(len(at), 1 << c)
        trees[c, s] = (at, m, Tree(m, sizes[at], comps[at]))
    crossed = len(set(side.tolist())) > 1
    for (c, s), (at, m, tree) in trees.items():
        for other in ((c, s), (c, 1 - s), (c + 1, 0), (c + 1, 1)):
            if other not in trees or crossed and other[1] == s or other == (c, 1 - s) and s:
                continue
            at2, m2, tree2 = trees[other]
            if other == (c, s):
                pairs = walk(tree, None, percent)
            elif other[0] == c:
                pairs = walk(tree, tree2, percent)
            else:  # the wider bitmaps are folded to the narrower ones' width
                half = m2.shape[1] // 2
                pairs = walk(tree, Tree(m2[:, :half] | m2[:, half:], sizes[at2], comps[at2]), percent)
            for block in pairs:
                yield at[block[:, 0]], at2[block[:, 1]]


def candidates(keys: np.ndarray, sizes: np.ndarray, comps: np.ndarray, signatures: list[bytes],
               side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of keys of a group that may link."""
    return [(int(keys[i]), int(keys[j])) for a, b in leaf_pairs(keys, sizes, comps, signatures, side, percent)
            for i, j in zip(a.tolist(), b.tolist())]


def forest(keys: np.ndarray, sets: list[np.ndarray], comps: np.ndarray, side: np.ndarray | None = None,
           percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join a group's components as far as all its links do: at most one
    less than there are components. Pairs that earlier links join are not compared."""
    sizes = np.array([len(s) for s in sets], np.int64)
    root, comp = np.unique(comps, return_inverse=True)
    root = np.arange(len(root))  # of each component
    out = []
    for a, b in leaf_pairs(keys, sizes, comps, [signature(s) for s in sets], side, percent):
        apart = root[comp[a]] != root[comp[b]]
        a, b = a[apart], b[apart]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        for i, left in zip(np.unique(a).tolist(), np.split(b, np.flatnonzero(np.diff(a)) + 1)):
            mine = sets[i]
            while len(left := left[root[comp[left]] != root[comp[i]]]):
                now, left = left[:TOGETHER], left[TOGETHER:]
                theirs = np.concatenate([sets[k] for k in now])
                same = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
                both = np.add.reduceat(same, np.cumsum(sizes[now]) - sizes[now], dtype=np.int64)
                for k in now[100 * both >= percent * (len(mine) + sizes[now] - both)].tolist():
                    if root[comp[k]] != root[comp[i]]:
                        out.append((int(keys[i]), int(keys[k])))
                        root[root == root[comp[k]]] = root[comp[i]]
    return out


# ---------------------------------------------------------------- Spark steps

def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    return shingles(*common.utf8(batch.column("text")))


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n (distinct shingles), key (hash of the set) of every document."""
    def work(batches):
        for batch in batches:
            for part in common.slices(batch):
                sets = _sets(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())], ["doc_id", "text_hash", "n", "key"])

    return (common.narrow(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(common.lean(work), "doc_id bigint, text_hash bigint, n bigint, key bigint"))


def _of_firsts(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, object]:
    """Rows (h, text), and a bitmap of the ids of classes' first documents."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(common.bitmap(classes.select(F.xxhash64("first").alias("h"))))
    return docs.select(F.xxhash64("doc_id").alias("h"), "text"), bits


def _first_rows(bits, batch):
    return batch.filter(pa.array(common.in_bitmap(bits.value, batch.column("h").to_numpy().view(np.uint64))))


def _counted_bits(total: int) -> int:
    return min(max(32, total.bit_length() + ROOM), 63)


def _shingle_bitmaps(rows: DataFrame, firsts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the shingles (their first bits) that two classes or more hold, and of the widespread ones."""
    ranges = common.n_ranges(rows.sparkSession)

    def gather(batches):
        held, size = [], 0

        def send():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            sent = list(common.to_ranges(np.repeat(values, np.minimum(counts, WIDESPREAD + 1)), ranges, bits))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in sent], pa.int32()),
                                               pa.array([b for _, b in sent], pa.binary())], ["range", "hashes"])

        for batch in batches:
            for part in common.slices(_first_rows(firsts, batch)):
                for s in _sets(part):
                    if len(s):
                        held.append(_first_bits(s, bits))
                        size += len(s)
                if size >= GATHERED:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    counts = common.written(common.hash_counts(rows.mapInArrow(common.lean(gather), "range int, hashes binary"), 2, bits), "shingles")
    return (common.bitmap(counts.select("hash"), common.filter_bits(counts.count())),
            common.bitmap(counts.where(F.col("n") > WIDESPREAD).select("hash")))


def _first_bits(shingle_set: np.ndarray, bits: int) -> np.ndarray:
    first = shingle_set >> np.uint64(64 - bits)
    return first.astype(np.uint32) if bits <= 32 else first


def _prefixes(rows: DataFrame, firsts, shared, widespread, bits: int, percent: int) -> DataFrame:
    """(shingle, key, n, wide, own): the shingles by which classes may
    meet; own is a class's share of unshared shingles."""
    def work(batches):
        for batch in batches:
            for part in common.slices(_first_rows(firsts, batch)):
                cols = []
                for s in _sets(part):
                    if not len(s):
                        continue
                    both = common.in_bitmap(shared.value, _first_bits(s, bits))
                    wide = both & common.in_bitmap(widespread.value, _first_bits(s, bits))
                    own = int((~both).sum())
                    most = max(0, prefix(len(s), percent) - own)  # its own fill the rest
                    order = np.concatenate([np.flatnonzero(both & ~wide), np.flatnonzero(wide)])[:most]
                    if len(order):
                        k = len(order)
                        cols.append((s[order].view(np.int64), np.full(k, set_key(s)), np.full(k, len(s)), wide[order],
                                     np.full(k, own / len(s))))
                if cols:
                    a, b, c, d, e = (np.concatenate(x) for x in zip(*cols))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a), pa.array(b), pa.array(c, pa.int32()), pa.array(d), pa.array(e)],
                        ["shingle", "key", "n", "wide", "own"])

    return rows.mapInArrow(common.lean(work), "shingle bigint, key bigint, n int, wide boolean, own double")


def _meeting(groups: DataFrame) -> DataFrame:
    """The groups that hold two classes or more."""
    met = (groups.groupBy("shingle").agg(F.min("key").alias("k0"), F.max("key").alias("k1"))
           .where("k0 <> k1").select("shingle"))
    return groups.join(met, "shingle", "left_semi")


def _class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, shingles): the sets of some classes."""
    rows, firsts = _of_firsts(docs, classes)

    def work(batches):
        for batch in batches:
            for part in common.slices(_first_rows(firsts, batch)):
                sets = [s for s in _sets(part) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "shingles"])

    return (rows.mapInArrow(common.lean(work), "key bigint, shingles binary")
            .join(classes.select("key"), "key", "left_semi").dropDuplicates(["key"]))


def _hubs(groups: DataFrame, percent: int, salts: int) -> DataFrame:
    """(src, dst): each class with the most central one that it meets in VOTES of its groups, if any."""
    def work(batches):
        group, hubs = None, []
        for batch in batches:
            out = []
            for s, salt, key, n in zip(*(batch.column(c).to_pylist() for c in ("shingle", "salt", "key", "n"))):
                if (s, salt) != group:
                    group, hubs = (s, salt), []
                hub = next((k for k, m in hubs if 100 * m >= percent * n and 100 * n >= percent * m), None)
                if hub is None:
                    hubs.append((key, n))  # no two hubs are of near sizes, so they are few
                elif key != hub:
                    out.append((hub, key))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["hub", "key"])

    salt = F.when(F.col("wide"), F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    met = (groups.select("shingle", salt.alias("salt"), "own", "n", "key")
           .repartition(common.n_ranges(groups.sparkSession), "shingle", "salt")
           .sortWithinPartitions("shingle", "salt", "own", "n", "key").mapInArrow(common.lean(work), "hub bigint, key bigint"))
    meetings = groups.groupBy("key").agg(F.count("*").alias("meetings"))
    best = met.groupBy("hub", "key").count().groupBy("key").agg(F.max(F.struct("count", "hub")).alias("best"))
    return (best.join(meetings, "key").where(F.col("best.count") >= VOTES * F.col("meetings"))
            .select(F.col("best.hub").alias("src"), F.col("key").alias("dst")))


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (src, dst) of class keys whose sets link, written."""
    def compare(batches):
        for batch in batches:
            src, dst = [], []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("src", "dst", "x", "y"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    src.append(a)
                    dst.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    joined = (pairs.join(sets.select(F.col("key").alias("src"), F.col("shingles").alias("x")), "src")
              .join(sets.select(F.col("key").alias("dst"), F.col("shingles").alias("y")), "dst"))
    return common.written(joined.select("src", "dst", "x", "y").mapInArrow(common.lean(compare), "src bigint, dst bigint"), "links")


def _tree_links(groups: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(src, dst): links between components, found by signature trees over bundles of groups."""
    spark = groups.sparkSession
    with_comp = common.written(
        groups.select("shingle", "key", "n").join(found.select(F.col("node").alias("key"), "component"), "key", "left")
        .withColumn("component", F.coalesce("component", "key")), "members")
    mixed = (with_comp.groupBy("shingle")
             .agg(F.min("key").alias("bundle"), F.min("component").alias("c0"), F.max("component").alias("c1"))
             .where("c0 <> c1").select("shingle", "bundle"))
    members = common.written(with_comp.join(mixed, "shingle").select("bundle", "key", "n", "component").distinct(), "bundles")
    # a large bundle is cut into blocks by key; a cell holds two blocks, or one with itself
    blocks = F.greatest(F.ceil(F.count("*") / CELL), F.ceil(F.sum("n") / CELL_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    cells = (members.join(members.groupBy("bundle").agg(blocks.alias("blocks")), "bundle")
             .join(sets.select("key", "shingles"), "key").withColumn("own", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("own", "with")).withColumn("hi", F.greatest("own", "with")))

    def work(batches):
        cell, held = None, []

        def settle():
            got = []
            if len(held) > 1 and len({x[1] for x in held}) > 1:
                key, comp, own_block, blobs = zip(*held)
                side = None if cell[1] == cell[2] else (np.array(own_block) == cell[2]).astype(np.int64)
                got = forest(np.array(key), [np.frombuffer(b, np.uint64) for b in blobs], np.array(comp), side, percent)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in got], pa.int64()) for k in (0, 1)], ["src", "dst"])

        for batch in batches:
            for bundle, lo, hi, *rest in zip(*(batch.column(c).to_pylist() for c in
                                               ("bundle", "lo", "hi", "key", "component", "own", "shingles"))):
                if (bundle, lo, hi) != cell:
                    yield settle()
                    cell = (bundle, lo, hi)
                held.append(rest)
        yield settle()

    parts = common.n_ranges(spark)
    return common.written(
        cells.select("bundle", "lo", "hi", "key", "component", "own", "shingles")
        .repartition(parts, "bundle", "lo", "hi").sortWithinPartitions("bundle", "lo", "hi")
        .mapInArrow(common.lean(work), "src bigint, dst bigint"), "links")


def join(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reached by links, its own
    included), and to tell rows and groups apart where ids are null or repeated:
    text_hash, and group (null for an empty set), a number of the component."""
    spark = docs.sparkSession
    common.arrow_batches(spark)
    docs = common.narrow(docs, id_col, text_col)
    profile = common.written(profiles(docs), "profiles")
    classes = common.written(profile.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("n").alias("n")), "classes")
    bits = _counted_bits(classes.agg(F.sum("n")).first()[0] or 0)
    classes = classes.select("key", "first")
    rows, firsts = _of_firsts(docs, classes)
    shared, widespread = (spark.sparkContext.broadcast(b) for b in _shingle_bitmaps(rows, firsts, bits))
    groups = common.written(_prefixes(rows, firsts, shared, widespread, bits, percent), "prefixes")
    groups = common.written(_meeting(groups), "groups")
    sets = common.written(_class_sets(docs, classes.join(groups, "key", "left_semi")), "sets")

    links = _compared(_hubs(groups, percent, SALTS), sets, percent)
    found = components(links)
    # the most central class of each component, and classes without a link
    member = groups.select("key", "own").distinct().join(found.withColumnRenamed("node", "key"), "key", "left")
    central = (member.groupBy(F.coalesce("component", "key").alias("component"))
               .agg(F.min(F.struct("own", "key")).alias("c")).select(F.col("c.key").alias("key")))
    links = links.unionByName(_compared(_hubs(groups.join(central, "key", "left_semi"), percent, 1), sets, percent))
    found = components(links)
    found = components(links.unionByName(_tree_links(groups, found, sets, percent)))

    least = (classes.join(found.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("group", F.coalesce("component", "key")))
    smallest = least.groupBy("group").agg(F.min("first").alias("component_id"))
    labels = least.join(smallest, "group").select("key", "component_id", "group")
    alone = profile.where(F.col("key").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("bigint").alias("group"))
    return (profile.where(F.col("key").isNotNull()).join(labels, "key")
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "group").unionByName(alone))
