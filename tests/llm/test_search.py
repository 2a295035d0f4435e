"""Top-k search, sampling and the conversation trie, against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common, prefixtrie, resample, topk

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


# ---------------------------------------------------------------- top-k search

def whole(x: float) -> int:
    return int(x) * 64 if abs(x) >= 2.0 ** 53 else math.floor(x * 64)


def brute_topk(rows, k, every):
    ok = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    end = topk.LONG_END
    out = []
    for a, (q, qv) in enumerate(ok):
        if q is None or q % every:
            continue
        got = [(-max(-end, min(end, sum(x * y for x, y in zip(qv, cv)))), c is None, c if c is not None else 0)
               for b, (c, cv) in enumerate(ok) if a != b]
        out += [(q, rank, None if missing else c, -s) for rank, (s, missing, c) in enumerate(sorted(got)[:k], 1)]
    return sorted(out, key=repr)


def run_topk(spark, rows, k=5, every=4, parts=5):
    df = spark.createDataFrame(rows, VECTORS).repartition(parts).withColumns({c: F.lit("clash") for c in ("cell", "side", "a", "v", "n")})
    return sorted((tuple(r) for r in topk.search(df, k, every).collect()), key=repr)


@pytest.mark.parametrize("scale", [0.2, 30.0, 3e4, 5e12])
def test_topk_matches_brute_force(spark, scale):
    r = random.Random(7)
    rows = [(i, [r.gauss(0, scale) if r.random() < 0.7 else 0.0 for _ in range(r.choice([12, 12, 3, 30]))]) for i in range(150)]
    rows += [(300 + i, rows[5][1]) for i in range(60)]  # repeated vectors: ties by id
    assert run_topk(spark, rows) == brute_topk(rows, 5, 4)


def test_topk_blocks_and_cells(spark, monkeypatch):
    """More cells, query lines and blocks than one give the same rows."""
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 0.1) for _ in range(8)]) for i in range(1300)]
    once = run_topk(spark, rows, 20, 20)
    assert once == brute_topk(rows, 20, 20)
    monkeypatch.setattr(topk, "QUERY_CELL", 9)
    assert run_topk(spark, rows, 20, 20, parts=11) == once


def test_topk_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [3.0, 3.0]), (None, [3.0, 3.0]),
            (8, []), (8, [0.5, -0.01]), (8, [0.5, -0.01]), (9, [-0.001]), (12, [1e300, 1e300]), (13, [-1e300, 2.0]), (-4, [1.0, 2.0]),
            (16, [float(2 ** 40), 1.0]), (17, [float(2 ** 30), -1.0]), (20, [-1.7e308]), (20, [1.0, 2.0])]
    got = run_topk(spark, rows, 30, 4)
    assert got == brute_topk(rows, 30, 4)
    assert {r[0] for r in got} == {0, 8, 12, -4, 16, 20}
    assert run_topk(spark, rows, 2, 4) == brute_topk(rows, 2, 4)


def test_topk_few_or_no_rows(spark):
    assert run_topk(spark, []) == []
    assert run_topk(spark, [(0, [1.0])]) == []
    assert run_topk(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run_topk(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 64 * 128)]


# ---------------------------------------------------------------- importance resampling

def brute_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute_resample(docs, target, percent=5, least=20):
    raw, goal = Counter(), Counter()
    for counts, texts in ((raw, [t for _, t in docs]), (goal, target)):
        for t in texts:
            counts.update(map(brute_bucket, brute_features(t)[1]))
    s_all, t_all = sum(raw.values()), sum(goal.values())
    rows = []
    for i, t in docs:
        words, got = brute_features(t)
        weight = sum(math.floor(1000 * math.log((goal[b] + 1) * (s_all + 10000) / ((raw[b] + 1) * (t_all + 10000)))) for b in map(brute_bucket, got))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((len(words), i, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = percent * len(long) // 100
    out = [(*r[1:], k if k <= drawn else None) for k, r in enumerate(long, 1)]
    return sorted(out + [(*r[1:], None) for r in rows if r[0] < least], key=repr)


def run_resample(spark, documents, texts, target, ids=None, **more):
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id bigint, text string")
    return sorted((tuple(r) for r in resample.resample(documents(texts, ids), goal, **more).collect()), key=repr)


def test_features_of_odd_texts(odd_texts):
    odd = [*odd_texts, "Mixed CASE Straße-é 12a", "x" * 49 + " " + "y" * 48 + " " + "z" * 5000 + " end", "a", "b c"]
    offsets, data = common.utf8(pa.array(odd, pa.string()))
    got, first = resample.features(offsets, data)
    for k, t in enumerate(odd):
        mine = [b for buckets, at in got for b, a in zip(buckets.tolist(), at.tolist()) if first[k] <= a < first[k + 1]]
        assert sorted(mine) == sorted(map(brute_bucket, brute_features(t)[1]))
        assert first[k + 1] - first[k] == len(brute_features(t)[0])


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resample_matches_brute_force(spark, documents, odd_texts, percent):
    r = random.Random(percent)
    vocab = [f"w{k}" for k in range(60)] + ["é", "日本", "Cat"]
    texts = odd_texts + [" ".join(r.choices(vocab, k=r.choice([3, 19, 20, 21, 60]))) for _ in range(300)]
    target = [" ".join(r.choices(vocab[:12], k=30)) for _ in range(9)] + [None, ""]
    assert run_resample(spark, documents, texts, target, percent=percent) == brute_resample(list(enumerate(texts)), target, percent)


def test_resample_repeated_and_null_ids(spark, documents):
    """A third of the rows have one id and one text, a third no id."""
    r = random.Random(3)
    same = " ".join(f"w{k}" for k in range(25))
    texts = [same] * 120 + [" ".join(r.choices("abcdefgh", k=30)) for _ in range(120)] + [same] * 120
    ids = [7] * 120 + list(range(100, 220)) + [None] * 120
    got = run_resample(spark, documents, texts, [same], ids, percent=50)
    want = brute_resample(list(zip(ids, texts)), [same], 50)
    assert sorted(repr(x[:4]) for x in got) == sorted(repr(x[:4]) for x in want)
    assert sorted(x[4] for x in got if x[4]) == list(range(1, 181))
    assert Counter((x[0], x[4] is None) for x in got) == Counter((x[0], x[4] is None) for x in want)


def test_resample_empty_tables(spark, documents):
    docs = [" ".join(f"w{k}" for k in range(30))] * 25
    assert run_resample(spark, documents, docs, []) == brute_resample(list(enumerate(docs)), [])
    empty = documents(["x"]).limit(0)
    assert resample.resample(empty, empty).collect() == []
    assert {x[4] for x in run_resample(spark, documents, ["few words"] * 30, ["x"])} == {None}


def test_ranks_split_a_hot_score(spark):
    """Rows equal in score and id are dealt to several segments; ranks stay 1..n."""
    df = spark.range(0, 4000, 1, 9).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"), F.lit(1).cast("bigint").alias("score"))
    got = [(r["doc_id"], r["rank"]) for r in resample.ranked(df).collect()]
    assert sorted(x[1] for x in got) == list(range(1, 4001))
    by_rank = [x[0] for x in sorted(got, key=lambda x: x[1])]
    assert by_rank == sorted(by_rank)
    assert {x[1] is None for x in ((r["doc_id"], r["rank"]) for r in resample.ranked(df, 0).collect())} == {True}


# ---------------------------------------------------------------- conversation trie

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def brute_trie(rows):
    convs: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for c, own in convs.items():
        mark = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
        convs[c] = [(r, t) for _, r, t in sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, x[1], mark(*x[1:])))]
    again = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    member: dict = {}
    for c, path in again.items():
        for d in range(len(path) + 1):
            member.setdefault(tuple(path[:d]), []).append(c)
    kids = Counter(p[:-1] for p in member if p)
    leaves, saved = Counter(), Counter()
    for p, m in member.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in member.items():
        end = ",".join(str(c) for c in sorted(m) if len(again[c]) == len(p))
        out.append((min(m), len(p), min(member[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=repr)


def run_trie(spark, rows, parts=3):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(parts).withColumns({c: F.lit("clash") for c in ("c", "d", "k", "pos", "part", "size")})
    return sorted((tuple(r) for r in prefixtrie.trie(df).collect()), key=repr)


def conversations(seed, n, length, vocab):
    """Random conversations, half of them grown from the first turns of another."""
    r = random.Random(seed)
    made = []
    for _ in range(n):
        old = r.choice(made)[:r.randint(0, length)] if made and r.random() < 0.5 else []
        made.append(old + [(r.choice(("user", "assistant", None)), r.choice(vocab)) for _ in range(r.randint(1, length))])
    return [(c, turn, role, text) for c, path in enumerate(made) for turn, (role, text) in enumerate(path)]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_matches_brute_force(spark, seed):
    rows = conversations(seed, 120, 6, ["a", "b", "é日", "", None])
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_odd_rows(spark):
    rows = [(0, 1, "u", "x"), (0, None, None, None), (0, 1, "u", "a"), (0, 1, "u", "a"), (None, 0, "u", "x"), (3, 5, "u", "x"), (3, 5, "u", "x"),
            (-7, 0, "u", "neg"), (-5, 0, "u", "base"), (41, 0, "u", "no base"), (42, 0, "u", "no base"), (44, 0, "u", "no base"), (9, 0, "1:u", "x"), (8, 0, "1", ":ux")]
    assert run_trie(spark, rows) == brute_trie(rows)
    assert run_trie(spark, rows[4:5]) == [] and run_trie(spark, []) == []


def test_trie_one_conversation_holds_most_turns(spark, monkeypatch):
    """A chain of 400 turns, its runs split between tasks, and many conversations that end at one node."""
    rows = [(25, k, "u", f"t{k}") for k in range(400)] + [(c, 0, "u", "hi") for c in range(1000, 1300)]
    monkeypatch.setattr(prefixtrie, "CHUNK", 64)
    assert run_trie(spark, rows, 6) == brute_trie(rows)


def test_contraction_of_deep_and_wide_trees(spark):
    """Caterpillars, stars and random trees: every subtree total."""
    r = random.Random(5)
    parents = {0: None}
    for k in range(1, 300):
        parents[k] = k - 1 if r.random() < 0.6 else r.randrange(k) if r.random() < 0.5 else 0
    depth = {0: 0}
    for k in range(1, 300):
        depth[k] = depth[parents[k]] + 1
    own = {k: r.randrange(9) for k in parents}
    total = dict(own)
    for k in reversed(range(1, 300)):
        total[parents[k]] += total[k]
    df = spark.createDataFrame([(k, depth[k], p, None if p is None else depth[p], 1, own[k]) for k, p in parents.items()],
                               "c bigint, d bigint, pc bigint, pd bigint, l bigint, s bigint")
    got = {r["c"]: r["s"] for r in prefixtrie.subtree_totals(df).collect()}
    assert got == total
