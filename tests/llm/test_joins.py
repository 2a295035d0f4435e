"""Operators that compare documents, against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, components, decontam, multisethash, sigtree, stages, suffixdup, urlalias

VOCAB = [a + b for a in ("th", "er", "on", "an", "re", "st") for b in ("", "e", "ing", "ation", "ed", "ly")]


def corpus(seed: int, n: int, odd=()) -> list[str | None]:
    """Random texts with exact copies, edited copies, shared passages and lines."""
    r = random.Random(seed)
    passage = " ".join(r.choices(VOCAB, k=40))
    out: list[str | None] = list(odd)
    for _ in range(n):
        words = r.choices(VOCAB, k=r.choice([1, 3, 5, 8, 40, 120]))
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
            continue
        if out and kind < 0.5:
            base = (r.choice(out) or "").split(" ")
            for _ in range(r.randint(1, 4)):
                base[r.randrange(len(base))] = r.choice(VOCAB)
            words = base
        if kind > 0.7:
            at = r.randrange(len(words))
            words = words[:at] + passage.split() + words[at:]
        out.append(" ".join(words))
    return out


# ---------------------------------------------------------------- multiset hash

def test_edited_texts_and_fingerprints(spark, documents, odd_texts):
    texts = corpus(1, 60, odd_texts)
    ids = [k * 3 - 50 for k in range(len(texts))]
    got = {r["doc_id"]: r for r in multisethash.compared(documents(texts, ids)).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    prints = defaultdict(set)
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        edited = t[:len(t) - n] + after[:n]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        prints[t].add(got[i]["fingerprint"])
        prints[edited].add(got[i]["edited_fingerprint"])
    assert all(len(x) == 1 for x in prints.values())


def test_fingerprint_ignores_order_and_takes_edits(spark, documents):
    parts = [f"line {k} of the text, with clause {k}" for k in range(30)]
    mixed = parts[:]
    random.Random(2).shuffle(mixed)
    rows = {r["doc_id"]: r["lanes"] for r in multisethash.fingerprints(documents(
        ["\n".join(parts), "\n".join(mixed), "\n".join(parts[:20]), "\n".join(parts[20:])])).collect()}
    assert rows[0] == rows[1] != rows[2]
    both = spark.createDataFrame([(rows[2], rows[3], rows[0])], "a array<bigint>, b array<bigint>, c array<bigint>")
    r = both.select(multisethash.added(F.col("a"), F.col("b")).alias("sum"), multisethash.removed(F.col("c"), F.col("b")).alias("less"),
                    multisethash.likeness(F.col("a"), F.col("c")).alias("near"),
                    multisethash.likeness(F.col("a"), F.col("b")).alias("far")).first()
    assert r["sum"] == rows[0] and r["less"] == rows[2]
    assert r["near"] > 0.5 > r["far"]


def test_likeness_of_texts_whose_lanes_wrap(spark, monkeypatch):
    monkeypatch.setattr(multisethash, "_BITS", 8)  # lanes wrap at 256 clauses instead of 2**20
    monkeypatch.setattr(multisethash, "_MASK", sum(255 << (21 * k) for k in range(3)))
    texts = [",".join(f"{p}{k}" for k in range(600)) for p in "ab"] + ["one, two, three."]
    texts.append(",".join(texts[0].split(",") + texts[1].split(",")[:100]))
    df = multisethash.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).drop("text")
    a, b = df.select("doc_id", F.col("lanes").alias("x")), df.select(F.col("doc_id").alias("other"), F.col("lanes").alias("y"))
    got = {(r[0], r[1]): r[2] for r in a.crossJoin(b).select("doc_id", "other", multisethash.likeness(F.col("x"), F.col("y"))).collect()}
    assert all(got[k, k] == 1 for k in range(4)) and got[0, 1] < 0.5 and got[0, 2] < 0.5 and got[0, 3] > 0.8


def test_multiset_hash_of_rows_without_or_with_one_id(spark, documents):
    got = multisethash.compared(documents(["a b", "c d e f", None, "x y z"], [None, 7, 7, None])).collect()
    assert len(got) == 4
    assert multisethash.compared(documents([])).collect() == []
    assert [r["near_edited"] for r in multisethash.compared(documents(["only one"], [5])).collect()] != []


# ---------------------------------------------------------------- connected components

def test_components_against_union_find(spark, tmp_path):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(0, k) for k in range(300, 400)] + [(5, 5)] \
        + [(k, k + 1) for k in range(500, 560)]
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges + [(None, 1)], "src bigint, dst bigint")
    got = {x["node"]: x["component"] for x in components.components(df).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(df.limit(0)).collect() == []


# ---------------------------------------------------------------- URLs

def test_url_rules_and_aliases(spark):
    canonical = '<html><head><link rel="canonical" href="%s"></head></html>'
    refresh = "<meta http-equiv='refresh' content='0; URL=%s'>"
    pages = [
        (0, "https://a.example.org/es/1", ""),                                     # block
        (1, "http://free.net/x?p=1", canonical % "https://a.example.org/es/1"),     # alias of a blocked page
        (2, "http://other.net/y", refresh % "//free.net/x?p=1"),                       # alias of the alias
        (3, "http://good.com/fr/1", canonical % "http://other.net/y"),              # an explicit allow joins: all are allowed
        (4, "http://mirror.net/z", canonical % "http://www.bad.com/de/9/"),         # alias of a blocked url that is no page
        (5, "http://mirror.net/z#top", None), (6, None, None), (7, "no scheme", "x"), (8, "HTTP://X.COM", ""),
        (9, "http://example.org/en/1", ""), (10, "http://notexample.org/es/1", ""), (9, "http://example.org/en/1", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'clash' host", "'c' node", "'r' rule")
    rows = urlalias.judge(df).collect()
    assert len(rows) == len(pages)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1][2:] == (None, "allow") and got[2][2:] == (None, "allow") and got[3][2:] == ("com/fr/", "allow")
    assert got[4] == ("mirror.net", "/z", None, "block") and got[5][2:] == (None, "block")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("x.com", "", None, "allow")
    assert got[9][2:] == ("example.org/en/1", "block") and got[10][2:] == ("org/", "allow")
    assert {r["node"] for r in rows if r["page_id"] in (4, 5)} == {"mirror.net/z"}
    without_allow = urlalias.judge(df.where("page_id in (0, 1, 2)")).collect()
    assert {r["verdict"] for r in without_allow} == {"block"}
    assert urlalias.judge(df.limit(0)).collect() == []


def test_verdicts_against_union_find(spark):
    """Generated pages: rules by a scan of all, aliases by union-find over canonical and redirect links."""
    import re

    r = random.Random(17)
    hosts = ["a.org", "www.example.org", "example.org", "b.com", "www.b.com", "free.net", "x.free.net", "WWW.Up.net"]
    paths = ["", "/", "/es/", "/es/1", "/en/1", "/en/12", "/de/", "/de/3", "/fr/9", "/x", "/x/"]

    def url():
        return r.choice(["http", "https"]) + "://" + r.choice(hosts) + r.choice(paths) + r.choice(["", "", "?id=1", "?id=2", "#top", "?id=1#top"])

    pages = [(k, url(), r.choice(["<link rel=canonical href='{}'>", '<meta http-equiv="refresh" content="3;url={}">', "<p>{}</p>"]).format(url())
              if r.random() < 0.3 else None) for k in range(400)] + [(400, None, "x"), (401, "no scheme", None)]

    def split(u):
        m = re.match(r"[^:]*://([^/?#]*)([^?#]*)(\?[^#]*)?", u or "")
        return (m[1].lower(), m[2], m[3] or "") if m else ("", "", "")

    def node(u):
        host, path, query = split(u)
        return host and host + (path or "/") + query

    def rule(u):
        host, path, _ = split(u)
        fits = [(len(h + p), h + p, kind) for kind, h, p in urlalias.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, None)

    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    said = {}
    for _, u, html in pages:
        m = re.match(r"<link.*href='(.*)'>|<meta.*url=(.*)\">", html or "")
        to = m and (m[1] or m[2])
        if to and node(u) and node(to):
            parent[find(node(u))] = find(node(to))
        for x in (u, to):
            if x and node(x):
                said.setdefault(node(x), set()).add(rule(x)[1])
    whole = {}
    for n, verdicts in said.items():
        whole.setdefault(find(n), set()).update(verdicts)
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    changed = 0
    for x in urlalias.judge(df).collect():
        u = pages[x["page_id"]][1]
        name, own = rule(u)
        around = whole.get(find(node(u)), set()) if node(u) else set()
        want = own or ("allow" if "allow" in around or "block" not in around else "block")
        assert (x["host"], x["path"], x["rule"], x["verdict"]) == (*split(u)[:2], name, want)
        changed += own is None and want == "block"
    assert changed >= 10


# ---------------------------------------------------------------- Jaccard join

def brute_join(rows):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[x] = y
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(s), str(least.get(find(k)))) for k, ((i, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("seed, cell, widespread", [(4, 4096, 64), (5, 4, 3)])
def test_join_against_brute_force(spark, documents, odd_texts, monkeypatch, seed, cell, widespread):
    monkeypatch.setattr(sigtree, "CELL", cell)
    monkeypatch.setattr(sigtree, "WIDESPREAD", widespread)
    texts = corpus(seed, 150, odd_texts)
    ids = list(range(len(texts)))
    ids[-1], ids[-2] = None, 3
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in sigtree.join(documents(texts, ids)).collect())
    assert got == brute_join(list(zip(ids, texts)))


def test_join_of_an_empty_table(spark, documents):
    assert sigtree.join(documents([])).collect() == []


def test_traversal_loses_no_link():
    r = random.Random(6)
    for _ in range(60):
        base = np.unique(np.array([r.getrandbits(64) for _ in range(r.randint(1, 60))], np.uint64))
        sets = []
        for _ in range(r.randint(2, 40)):
            s = base[[r.random() < r.choice([0.5, 0.9, 0.97, 1]) for _ in base]]
            s = np.unique(np.concatenate([s, np.array([r.getrandbits(64) for _ in range(r.randint(0, 8))], np.uint64)]))
            if len(s):
                sets.append(s)
        comps = np.array([r.randrange(len(sets)) for _ in sets])
        side = np.array([r.randrange(2) for _ in sets]) if r.random() < 0.5 else None
        got = {tuple(sorted(p)) for p in sigtree.candidates(
            np.arange(len(sets)), np.array([len(s) for s in sets]), comps, [sigtree.signature(s) for s in sets], side)}
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if comps[a] != comps[b] and (side is None or len(set(side)) < 2 or side[a] != side[b]) \
                        and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    assert (b, a) in got


def brute_components(sets, comps, side=None):
    root = list(comps)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if (side is None or len(set(side)) < 2 or side[a] != side[b]) and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root = [root[b] if x == root[a] else x for x in root]
    return root


def test_forest_joins_what_all_links_join():
    r = random.Random(16)
    for _ in range(60):
        base = np.unique(np.array([r.getrandbits(64) for _ in range(r.randint(1, 60))], np.uint64))
        sets = []
        for _ in range(r.randint(2, 40)):
            s = base[[r.random() < r.choice([0.5, 0.85, 0.97, 1]) for _ in base]]
            s = np.unique(np.concatenate([s, np.array([r.getrandbits(64) for _ in range(r.randint(0, 8))], np.uint64)]))
            sets += [s] if len(s) else []
        comps = np.array([r.randrange(len(sets)) for _ in sets])
        side = np.array([r.randrange(2) for _ in sets]) if r.random() < 0.4 else None
        got = sigtree.forest(np.arange(len(sets)), sets, comps, side)
        assert len(got) < len(set(comps.tolist())) or not got
        root = comps.tolist()
        for a, b in got:
            assert root[a] != root[b]
            root = [root[b] if x == root[a] else x for x in root]
        want = brute_components(sets, comps.tolist(), side)
        assert {frozenset(k for k, x in enumerate(root) if x == y) for y in root} == {frozenset(k for k, x in enumerate(want) if x == y) for y in want}


def test_near_copies_without_a_centre_give_a_forest():
    """2,000 sets in a circle, each like its neighbours only, and 600 just under the threshold."""
    r = random.Random(17)
    ring = np.array([r.getrandbits(64) for _ in range(2000 + 100)], np.uint64)
    sets = [np.unique(ring[k:k + 100]) for k in range(2000)]
    assert len(sigtree.forest(np.arange(2000), sets, np.arange(2000))) == 1999
    base = np.array([r.getrandbits(64) for _ in range(200)], np.uint64)
    under = [np.unique(np.concatenate([base[:171], np.array([r.getrandbits(64) for _ in range(29)], np.uint64)])) for _ in range(600)]
    assert sigtree.forest(np.arange(600), under, np.arange(600)) == []   # 171 / 229 of any two


def test_join_of_copies_without_a_centre(spark, documents, monkeypatch):
    """A chain of windows on one text: each links with its neighbours only; one component, in several cells."""
    r = random.Random(18)
    words = [f"w{r.getrandbits(40):x}" for _ in range(700)]
    texts = [" ".join(words[k:k + 60]) for k in range(0, 600, 3)] + ["something else altogether, of no group"]
    monkeypatch.setattr(sigtree, "CELL", 16)
    got = {r["doc_id"]: r["component_id"] for r in sigtree.join(documents(texts)).collect()}
    assert got == {k: 0 if k < 200 else 200 for k in range(201)}


def test_hashes_of_more_than_32_bits_are_counted_apart(spark):
    """By 32 bits, a quarter of the shingles of 6 GB of text meet others by chance."""
    r = np.random.default_rng(20)
    same = (r.integers(0, 1 << 32, 500, np.uint64) << np.uint64(8)) + np.uint64(3)
    values = np.sort(np.concatenate([same, same, same + np.uint64(1)]))   # the last have 32 bits in common with others
    assert (common.unpacked(common.packed(values, 40), 40) == values).all()
    assert common.packed(values[:9] >> np.uint64(8)) == common.packed((values[:9] >> np.uint64(8)).astype(np.uint32))
    blobs = spark.createDataFrame([(k, bytearray(b)) for k, b in common.to_ranges(values, 3, 40)], "range int, hashes binary")
    got = {x["hash"]: x["n"] for x in common.hash_counts(blobs, 2, 40).collect()}
    assert got == {int(x): 2 for x in np.unique(same)}
    for total in (10**6, 25 * 10**7, 15 * 10**8, 10**12):
        assert 32 <= sigtree._counted_bits(total) <= 63 and total / 2 ** sigtree._counted_bits(total) <= 1 / 64
    assert common.filter_bits(1000) == common.FILTER_BITS < common.filter_bits(10**8) <= common.filter_bits(10**10) == common.MOST_BITS


def test_only_sets_of_classes_that_meet_are_written(spark, documents, monkeypatch):
    """Also where the bitmap of shared shingles is full, so that each class seems to meet others."""
    bitmap, names = common.bitmap, {}
    monkeypatch.setattr(common, "bitmap", lambda values, bits=common.FILTER_BITS: bitmap(values, 4 if values.columns == ["hash"] else bits))
    written = common.written
    monkeypatch.setattr(common, "written", lambda df, name: names.setdefault(name, written(df, name)))
    r = random.Random(21)
    alone = [" ".join(f"w{r.getrandbits(40):x}" for _ in range(60)) for _ in range(40)]
    texts = [*alone, *(f"{t} end" for t in alone[:3])]
    got = {x["doc_id"]: x["component_id"] for x in sigtree.join(documents(texts)).collect()}
    assert got == {k: k if k < 40 else k - 40 for k in range(43)}
    assert names["sets"].count() == 6
    assert "shingles" not in names["groups"].columns and names["groups"].select("key").distinct().count() == 6


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_written_gives_its_shuffles_back(spark):
    df = spark.range(100_000).groupBy(F.xxhash64("id").alias("k")).count()
    before, setting = shuffle_files(spark), spark.conf.get(common._CLEANUP, None)
    assert common.written(df, "t-shuffles").count() == 100_000
    for _ in range(50):
        if shuffle_files(spark) <= before + 2:   # those of count()
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before + 2
    assert spark.conf.get(common._CLEANUP, None) == setting


def test_near_duplicates_deals_texts_once(spark, documents):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = stages.near_duplicates(spark, common.written(documents(corpus(22, 20)), "t-near"), "")
        plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    dealt = [x for x in re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan) if "text#" in x or "valueSet#" in x]   # also as a partial first()
    assert len(dealt) == 1, dealt


@pytest.mark.parametrize("ids, kept", [([None, None, 5, 7], {5}), ([7, 7, 7, 7], {7}), ([None] * 4, {None}), ([9, 3, None, 4], {3})])
def test_one_row_of_each_group_stays(spark, documents, ids, kept):
    """Near copies with null and repeated ids beside a text of its own that has one of these ids."""
    r = random.Random(19)
    words = r.choices(VOCAB, k=120)
    near = [" ".join(words[:k] + ["edit"] + words[k + 1:]) for k in (5, 40, 70, 100)]
    other = " ".join(r.choices(VOCAB, k=80))
    df = documents([*near, other, None, None, ""], [*ids, 7, 50, 50, None], clash=False)
    got = stages.near_duplicates(spark, df, "").collect()
    assert [r["doc_id"] for r in got if r["text"] in near] == list(kept)
    rest = [(r["doc_id"], r["text"]) for r in got if r["text"] not in near]
    assert len(rest) == 3 and set(rest) == {(7, other), (50, None), (None, "")}


# ---------------------------------------------------------------- benchmark decontamination

def test_copies_of_test_items(spark, documents, odd_texts):
    r = random.Random(7)
    items = [" ".join(r.choices(VOCAB, k=r.randint(15, 50))) for _ in range(12)] + ["too short", None, ""]
    texts, planted = list(odd_texts), {}
    for k in range(60):
        words = r.choices(VOCAB, k=150)
        if k % 2:
            j = r.randrange(12)
            copy = items[j].split()
            for _ in range(len(copy) // 10):
                copy[r.randrange(len(copy))] = "edited"
            words[70:70] = [w.upper() + "," for w in copy]
            planted[len(texts)] = j
        texts.append(" ".join(words))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    for block in (decontam.BLOCK_BYTES, 600):
        rows = decontam.copies(documents(texts), bench, block_bytes=block).collect()
        assert {(x["doc_id"], x["item_id"]) for x in rows} == set(planted.items())
        assert all(0.5 <= x["score"] <= 1 and x["first_word"] >= 60 for x in rows)
    kept = {x["doc_id"] for x in decontam.clean(documents(texts), bench).collect()}
    assert kept == set(range(len(texts))) - set(planted)
    assert decontam.copies(documents([]), bench).collect() == []
    assert decontam.copies(documents(texts), bench.limit(0)).collect() == []


@pytest.mark.parametrize("many", [2, 2000])
def test_edited_copies_are_found_however_many(spark, documents, many):
    r = random.Random(13)
    item = [f"w{k}" for k in range(40)]
    edited = [f"x{k}" if k % 10 in (0, 4) or k % 20 == 9 else w for k, w in enumerate(item)]  # 25 % of the words
    other = [f"w{k}" for k in range(4)] + [f"v{k}" for k in range(36)]  # begins with the same phrase
    texts = [" ".join([str(r.random()), "before", *edited, "after", *item[20:24], str(k)]) for k in range(many)]
    texts += [" ".join(["no", *item[:4], "copy", str(k)]) for k in range(many)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other))], "item_id bigint, text string")
    rows = decontam.copies(documents(texts), bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in rows} == {(k, 1) for k in range(many)}
    assert {x["score"] for x in rows} == {(2 * 30 - 9) / 80}  # the first word lies outside
    kept = {x["doc_id"] for x in decontam.clean(documents(texts), bench).collect()}
    assert kept == set(range(many, 2 * many))


def test_long_stretches_of_hits_are_aligned_whole():
    r = random.Random(14)
    item = [str(r.randrange(30)) for _ in range(30)]
    items = decontam.Items([(1, " ".join(item))], 4)
    for _ in range(20):
        copy = [w if r.random() < 0.85 else "edited" for w in item]
        words = (item[3:7] + ["x"]) * r.randrange(60) + copy + (item[20:25] + ["y"]) * r.randrange(60)
        raw = " ".join(words).encode()
        h, _ = decontam.word_hashes(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
        score = decontam.align(items.words[0], h)[0] / 60
        assert [x[1] for x in decontam.search(items, h, 0.5, {})] == [score] * (score >= 0.5)


def brute_align(a: list, b: list) -> list[list[int]]:
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
    return rows


def test_alignment_is_smith_waterman():
    r = random.Random(8)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randint(1, 9))] for _ in range(2))
        best = max(map(max, brute_align(a, b)))
        score, first, last = decontam.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == best and (score == 0 or 0 <= first <= last < len(b))
        if score:  # the words named hold the whole score, and no shorter stretch that ends there does
            assert brute_align(a, b[first:last + 1])[-1] and max(map(max, brute_align(a, b[first:last + 1]))) == score
            assert max(map(max, brute_align(a, b[first + 1:last + 1]))) < score
        assert decontam.align(np.array(a, np.uint64), np.array(b, np.uint64), 100) == (score, -1, -1)


def test_a_long_item_is_aligned_in_little_memory():
    import tracemalloc

    item = np.arange(6_000, dtype=np.uint64)
    copy = np.concatenate([np.full(3_000, 9_999_999, np.uint64), item, np.full(3_000, 9_999_999, np.uint64)])
    tracemalloc.start()
    assert decontam.align(item, copy) == (12_000, 3_000, 8_999)
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("edit", ["every fourth", "a quarter", "a quarter, cut and put in too"])
def test_edited_items_are_found(spark, documents, edit):
    r = random.Random(15)
    vocab = [f"v{k}" for k in range(3_000)]
    items = [r.choices(vocab, k=r.randint(12, 60)) for _ in range(200)]
    texts = []
    for item in items:
        copy = []
        for k, w in enumerate(item):
            if k % 4 == 3 if edit == "every fourth" else r.random() < 0.25:
                copy += r.choice([["edited"], ["edited"], [], [w, "more"]]) if "cut" in edit else ["edited"]
            else:
                copy.append(w)
        texts.append(" ".join([*r.choices(vocab, k=100), *copy, *r.choices(vocab, k=100)]))
    bench = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id bigint, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontam.copies(documents(texts), bench).collect()}
    want = {k for k, (i, t) in enumerate(zip(items, texts)) if max(map(max, brute_align(i, t.split()))) >= len(i)}
    assert got <= {(k, k) for k in want} and len(got) >= 0.95 * len(want) and len(want) >= 150
    if edit == "every fourth":
        assert len(got) == len(items)


def test_short_items_and_scripts_without_spaces(spark, documents):
    items = ["zwei worte", "eins", "", "!?", "敏捷的棕色狐狸跳过了懒狗", "สวัสดีครับผม", "ひらがな、カタカナ。漢字を読む"]
    texts = ["es sind zwei Worte hier", "zwei andere worte", "Eins, zwei", "他说：敏捷的棕色狐狸跳过了那懒狗。然后走了", "พูดว่าสวัสดีครับผมแล้ว",
             "これはひらがなカタカナ漢字を読む人", "完全不同的内容没有关系", "x" * 50, None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(x["doc_id"], x["item_id"], round(x["score"], 3)) for x in decontam.copies(documents(texts), bench).collect()}
    assert {(d, i) for d, i, _ in got} == {(0, 0), (2, 1), (3, 4), (4, 5), (5, 6)}
    assert (0, 0, 1.0) in got and (2, 1, 1.0) in got and (5, 6, 1.0) in got and (3, 4, round(23 / 24, 3)) in got


# ---------------------------------------------------------------- suffix sorting

def brute_removal(rows, length):
    least: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1 if i is not None else 0):
            least[b[p:p + length]] = min(least.get(b[p:p + length], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1 if i is not None else 0):
            if least[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [1, suffixdup.HOT])
@pytest.mark.parametrize("group", [24_000, 3])
def test_removal_against_brute_force(spark, documents, odd_texts, monkeypatch, group, hot):
    monkeypatch.setattr(suffixdup, "HOT", hot)
    monkeypatch.setattr(suffixdup, "GROUP", group)
    texts = corpus(9, 120, odd_texts)
    ids = [(k * 37) % 1000 for k in range(len(texts))]
    ids[20], ids[21], ids[22] = None, ids[23], ids[23]
    got = sorted((str(r["doc_id"]), *list(r)[1:]) for r in suffixdup.summary(suffixdup.remove(documents(texts, ids))).collect())
    assert got == brute_removal(list(zip(ids, texts)), 50)
    assert suffixdup.summary(suffixdup.remove(documents([]))).collect() == []


@pytest.mark.parametrize("hot", [1, suffixdup.HOT])
def test_one_anchor_in_50_000_runs(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(suffixdup, "HOT", hot)  # split before they travel, or where they gather
    r = random.Random(20)
    letters = "abcdefghijklmnopqrstuvwxyz "
    grams = ["".join(r.choices(letters, k=16)) for _ in range(20_000)]
    gram = grams[int(np.argmin([suffixdup._gram_hashes(np.frombuffer(g.encode(), np.uint8))[0] for g in grams]))]
    texts = ["".join("".join(r.choices(letters, k=18)) + gram + "".join(r.choices(letters, k=18)) for _ in range(250)) for _ in range(200)]
    for k in range(0, 200, 7):  # strings around the anchor that two documents hold, of all lengths
        for n in range(40):
            at = texts[k].index(gram, r.randrange(12_000))
            a, b = at - r.randrange(18), at + 16 + r.randrange(30, 60)
            to = r.randrange(12_000)
            texts[k + 3 if k < 197 else 0] = (x := texts[k + 3 if k < 197 else 0])[:to] + texts[k][a:b] + x[to:]
    ids = r.sample(range(1000), 200)
    got = sorted((str(x["doc_id"]), *list(x)[1:]) for x in suffixdup.summary(suffixdup.remove(documents(texts, ids))).collect())
    assert sum(t.count(gram) for t in texts) >= 50_000 and sum(x[2] for x in got) > 1000
    assert got == brute_removal(list(zip(ids, texts)), 50)


def test_settled_runs_and_merged_stretches():
    raw, runs = b"aaabbbaaaaaa", [(0, 3), (3, 6), (6, 9), (9, 12)]
    at, to = (np.array(x) for x in zip(*runs))
    ids = np.array([5, 5, 4, 5])
    assert suffixdup.settled(raw, np.array([1, 1, 1, 1]), ids, at, to).tolist() == [True, False, False, True]
    assert suffixdup.settled(raw, np.array([1, 2, 3, 4]), ids, at, to).tolist() == [False] * 4
    got = suffixdup.merged(np.array([1, 0, 1, 1]), np.array([9, 0, 5, 20]), np.array([14, 5, 10, 25]))
    assert [x.tolist() for x in got] == [[0, 1, 1], [0, 5, 20], [5, 14, 25]]
    assert [len(x) for x in suffixdup.merged(*[np.zeros(0, np.int64)] * 3)] == [0, 0, 0]


def test_only_cut_characters_go_with_a_passage(spark, documents):
    passage = "one passage that two documents hold, of over fifty bytes in all "
    # the shared bytes end inside the second text's first character after them (0xC3 begins both), and begin inside another
    texts = ["\u00c2\u00a9" + passage + "\u00e9 first", "\ufffd kept \ufffd \u00e8" + passage + "\u00e8 \ufffd second", "\ufffd alone"]
    got = {x["doc_id"]: x["text"] for x in stages.repeated_passages(spark, documents(texts, clash=False), "").collect()}
    assert got == {0: texts[0], 1: "\ufffd kept \ufffd \u00e8 \ufffd second", 2: texts[2]}
    text = ("\ufffd" + "\u65e5" * 3 + "\ufffd").encode()
    assert suffixdup.cut(text, [(4, 10)], True)[0].decode() == "\ufffd\ufffd"  # 0xE6 and the rest of another 0xE6 0x97 0xA5
    assert suffixdup.cut(text, [(4, 10)])[0] == text[:4] + text[10:]


def test_covered_strings_against_brute_force():
    r = random.Random(10)
    for _ in range(200):
        length = r.choice([3, 5, 50])
        letters = r.choice([b"ab", b"abc", b"a"])
        texts = [bytes(r.choice(letters) for _ in range(r.randint(length, length + 20))) for _ in range(r.randint(1, 8))]
        ids = np.array([r.randint(0, 4) for _ in texts])
        least: dict[bytes, int] = {}
        for t, i in zip(texts, ids):
            for p in range(len(t) - length + 1):
                least[t[p:p + length]] = min(least.get(t[p:p + length], 9), i)
        want = {(k, p) for k, (t, i) in enumerate(zip(texts, ids)) for p in range(len(t) - length + 1) if i > least[t[p:p + length]]}
        assert {(k, s) for k, a, b in suffixdup.covered(texts, ids, length) for s in range(a, b + 1)} == want


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, documents, odd_texts, tmp_path):
    import corpus_pipeline

    r = random.Random(11)
    items = [" ".join(r.choices(VOCAB, k=30)) for _ in range(5)]
    texts = corpus(12, 80, odd_texts)
    leak = len(texts)
    texts.append("before " * 20 + items[0] + " after" * 20)
    langs = ["aa"] * len(texts)
    documents(texts, langs=langs, clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append((name, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {name: {x["doc_id"]: x["text"] for x in df.collect()} for name, df in seen}
    spoken = {k: t for k, t in enumerate(texts) if t and any(map(str.isalpha, t))}
    assert rows["language_id"] == spoken
    comps = brute_join(sorted(spoken.items()))
    assert set(rows["near_duplicates"]) == {int(c) for _, _, c in comps}
    assert set(rows["repeated_passages"]) == set(rows["near_duplicates"])
    sizes = Counter()
    for i, n, gone, _, _ in brute_removal(sorted(rows["near_duplicates"].items()), 50):
        sizes[int(i)] = n - gone
    assert all(len(t.encode()) <= sizes[i] for i, t in rows["repeated_passages"].items())
    assert leak not in rows["decontamination"] and set(rows["tokens"]) == set(rows["decontamination"])
    assert rows["tokens"] == {k: t.replace("▁", " ") for k, t in rows["decontamination"].items()}  # the marker stands for a space
    assert {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(rows["tokens"])
