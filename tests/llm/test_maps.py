"""Operators that work text by text: language ID, notices, tokens, pieces, main text."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, langid, maintext, notices, pieces, tokencount


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- language ID

def brute_phrases(reference: str, text: str) -> int:
    """Greedy longest matches of a coded text in a coded reference."""
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at:at + k + 1] in reference:
            k += 1
        n, at = n + 1, at + (k if text[at:at + k] in reference else 1)
    return n


def test_cross_parsing_counts_longest_matches():
    r = random.Random(1)
    texts = {"x": "".join(r.choice("abcd ") for _ in range(300)), "y": "".join(r.choice("cdef ") for _ in range(300))}
    model = langid.Model(texts)
    asked = ["".join(r.choice("abcdefg ") for _ in range(r.randint(1, langid.BLOCK))) for _ in range(40)]
    got, lengths = model.phrases(asked)
    for j, lang in enumerate(model.langs):
        ref = "".join(map(chr, langid.encoded(model.codes, [texts[lang]])[0]))
        for k, t in enumerate(asked):
            coded = "".join(map(chr, langid.encoded(model.codes, [t])[0]))
            assert len(coded) == lengths[k]
            assert got[k, j] == brute_phrases(ref, coded)


def test_language_of_held_out_documents(spark, documents):
    r = random.Random(2)
    vocab = {"aa": ["the", "house", "is", "green", "and", "old"], "bb": ["das", "haus", "ist", "schön", "über", "zwölf"]}
    langs = [r.choice(sorted(vocab)) for _ in range(200)]
    df = documents([" ".join(r.choices(vocab[x], k=r.randint(5, 30))) for x in langs], langs=langs)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, langid.fit(df)).collect()}
    assert sum(got[k] == x for k, x in enumerate(langs)) >= 198


def test_language_of_odd_texts(spark, documents, odd_texts):
    df = documents(odd_texts, langs=["aa"] * len(odd_texts))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(df, {"aa": "one line here", "bb": "xyz"}).collect()}
    for k, t in enumerate(odd_texts):
        assert (got[k][0] == "und") == (not any(map(str.isalpha, t or "")))
        assert 0.0 <= got[k][1] <= 1.0
    assert got[4] == got[5]
    assert {r["lang_pred"] for r in langid.identify(df, {}).collect()} == {"und"}
    assert langid.identify(df.limit(0), {"aa": "x"}).collect() == []


def test_learning_leaves_held_out_rows_alone(spark, documents):
    df = documents([f"text {k}" for k in range(60)], langs=[f"l{k}" for k in range(60)])
    import zlib

    assert set(langid.fit(df)) == {f"l{k}" for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1}


# ---------------------------------------------------------------- notices

def brute_places(text: str):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(label, k) for phrase, label in notices.PHRASES.items() for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_many_languages_share_the_sample(spark, documents):
    r = random.Random(8)
    words = {f"l{k:03}": ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 8))) for _ in range(60)] for k in range(200)}
    rows = [(lang, " ".join(r.choices(vocab, k=60))) for lang, vocab in words.items() for _ in range(12)]
    df = documents([t for _, t in rows], langs=[x for x, _ in rows])
    texts = langid.sample(df, F.col("lang"))
    assert set(texts) == set(words) and sum(t.count(" ") for t in texts.values()) < langid.TOTAL_ROWS * langid.SAMPLE_CHARS
    assert max(len(t) for t in texts.values()) <= 6 * (langid.SAMPLE_CHARS + 1)  # 1,024 rows by 200 labels
    model = langid.Model(texts)
    assert sum(t.nbytes for t in model.tables) < 100 << 20
    asked = [(lang, " ".join(r.choices(vocab, k=40))) for lang, vocab in words.items()]
    got, _ = model.predict([t for _, t in asked])
    assert sum(a == b for a, (b, _) in zip(got, asked)) >= 190
    assert set(langid.sample(df, F.col("lang"), total=150)) == set(sorted(words)[:150])


def test_notices_against_brute_force(spark, documents, odd_texts):
    r = random.Random(3)
    bits = ["cc", "by", "CC BY", "General Public", "license", "All rights reserved.", "é", "x-y", "\n", "_"]
    texts = odd_texts + [" ".join(r.choices(bits, k=r.randint(0, 12))) for _ in range(150)]
    found = {r["doc_id"]: r for r in notices.scan(documents(texts)).collect()}
    rows = {r["doc_id"]: r for r in notices.summary(notices.scan(documents(texts))).collect()}
    for k, t in enumerate(texts):
        n, places = brute_places(t)
        assert found[k]["n_words"] == n
        assert sorted((p["label"], p["word"]) for p in found[k]["places"]) == places
        row = rows[k]
        assert row["n_base"] == len(places)
        assert row["first_word"] == min((w for _, w in places), default=None)
        assert row["last_word"] == max((w for _, w in places), default=None)
        assert row["base_labels"] == ",".join(sorted({a for a, _ in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_notices_with_edits():
    scanner = notices.Scanner(notices.PHRASES, notices.NOTICES, notices.CHARS_AN_EDIT)
    n, places, spans = scanner.scan(b"so Licensed under the Apach Licence, Version 2.0; all rights resrved, and more")
    assert places == [] and [(s[0], s[3]) for s in spans] == [("apache", 2), ("reserved", 1)]
    assert spans[0][1:3] == (1, 8) and spans[1][1:3] == (9, 11)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_pieces_of_a_notice_find_every_edited_copy():
    """All of them that leave the notice's key as it is."""
    r = random.Random(4)
    scanner = notices.Scanner({}, notices.NOTICES, notices.CHARS_AN_EDIT)
    for notice, label in notices.NOTICES.items():
        key = notices.KEYS[notice]
        at = f" {notice} ".index(f" {key} ")
        free = [k for k in range(1, len(notice) - 1) if not at - 1 <= k <= at + len(key)]
        for _ in range(30):
            copy, k = list(notice), notices.edits(notice)
            for place in sorted(r.choices(free, k=r.randint(0, k)), reverse=True):
                copy[place:place + 1] = r.choice([[], ["q"], [copy[place], "z"]])
            copy = " ".join("".join(copy).split())
            if edit_distance(notice, copy) <= k:
                assert label in {s[0] for s in scanner.scan(f"qqq {copy} qqq".encode())[2]}, copy


@pytest.mark.parametrize("notice", list(notices.NOTICES))
def test_each_notice_keeps_its_own_label(notice):
    scanner = notices.Scanner({}, notices.NOTICES, notices.CHARS_AN_EDIT)
    assert {s[0] for s in scanner.scan(f"Here: {notice.upper()}, and more".encode())[2]} == {notices.NOTICES[notice]}


@pytest.mark.parametrize("text", [
    *(f"released under the {x} license" for x in ("bsd", "new", "isc", "zlib", "mpl", "mitt", "wtf", "x11", "m it")),
    *(f"licensed under the {x} license version 2 0" for x in ("eclipse", "academic", "openssl", "ecos", "artistic")),
    *(f"subject to the terms of the {x} public license" for x in ("eclipse", "common", "erlang", "sun", "netizen", "lucent")),
    "licensed under cc 0", "licensed under cc bb", "licensed under cc zero", "all rights reverted", "this work is dedicated to the public works",
    "generic public license", "redistribution and use in source and text forms",
    "permission is hereby granted free of charge to a student obtaining a copy"])
def test_a_like_licence_gets_no_other_label(text):
    assert notices.Scanner({}, notices.NOTICES, notices.CHARS_AN_EDIT).scan(text.encode())[2] == []


def test_places_of_a_long_text_take_linear_time():
    import time

    scanner = notices.Scanner(notices.PHRASES, notices.NOTICES, notices.CHARS_AN_EDIT)
    seconds = []
    for n in (20_000, 160_000):
        begin = time.process_time()
        words, places, spans = scanner.scan(b"cc by all rights reserved " * n)
        seconds.append(time.process_time() - begin)
        assert words == 5 * n and [w for x, w in places if x == "cc-by"] == list(range(0, 5 * n, 5))
        assert [s[1:] for s in spans] == [(5 * k + 2, 5 * k + 4, 0) for k in range(n)]
    assert seconds[1] < 24 * seconds[0] + 1  # 8 times the text; by counting from the start it were 64 times


# ---------------------------------------------------------------- tokens and pieces

ODD = ["a", "b", "'s", " ", "  ", "   ", "\n", " ", "\r", "日", "\t", "\x00", "<|endoftext|>", "the", ".", "　", "𝒳", "1",
       "\x1c", "\x85", "\xa0", "²", "▁", "<s>", "é", "̈"]


@pytest.fixture(scope="module")
def mixed_texts(odd_texts):
    r = random.Random(5)
    return odd_texts + ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(1500)]


def test_token_counts_are_the_librarys(spark, documents, mixed_texts):
    from tokenizers import Tokenizer

    path = common.tokenizer_path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    got = {r["doc_id"]: r for r in tokencount.count_tokens(documents(mixed_texts), path, table_rows=50).collect()}
    for k, t in enumerate(mixed_texts):
        n = len(model.encode(t or "", add_special_tokens=False))
        assert (got[k]["n_tokens"], got[k]["n_bytes"], got[k]["over_limit"]) == (n, len((t or "").encode()), n > 1024)
    assert tokencount.count_tokens(documents([]), path).collect() == []


def test_small_caches_change_nothing(monkeypatch, mixed_texts):
    path = common.tokenizer_path("byte_bpe_50k.json")
    want = tokencount.Lengths(path, {}).count(mixed_texts)
    monkeypatch.setattr(tokencount, "CACHE_ROWS", 20)
    monkeypatch.setattr(tokencount, "CACHE_CHARS", 2)
    small = tokencount.Lengths(path, {})
    assert [n for k in range(0, len(mixed_texts), 7) for n in small.count(mixed_texts[k:k + 7])] == want


def test_pieces_are_the_librarys(spark, documents, mixed_texts):
    import sentencepiece

    path = common.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = documents(mixed_texts)
    got = {r["doc_id"]: r for r in pieces.digests(df, path).collect()}
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(df, path), path).collect()}
    for k, t in enumerate(mixed_texts):
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = model.decode(ids)
        assert got[k]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert back[k] == text
    assert pieces.digests(documents([]), path).collect() == []


def test_a_small_piece_cache_changes_nothing(monkeypatch, mixed_texts):
    path = common.tokenizer_path("piece_bpe_32k.model")
    want = pieces.Codec(path).encode(mixed_texts)
    monkeypatch.setattr(pieces, "KEPT", 20)
    monkeypatch.setattr(pieces, "KEPT_CHARS", 2)
    small = pieces.Codec(path)
    assert [x for k in range(0, len(mixed_texts), 7) for x in small.encode(mixed_texts[k:k + 7])] == want


# ---------------------------------------------------------------- main text

PAGE = """<html><body class="page"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div id=cookie-notice>We use cookies. OK.</div><main><h1>Title &amp; more</h1><p>Short.<p>Second para with
<a href=x>link</a> in&nbsp;it.<ul><li>one<li>two</ul><form><input>Subscribe here <button>Go</button></form>
<aside>Related things.</aside><pre>a
 b</pre><script>var p = "<p>no</p>";</script></main><div class="comments"><p>Nice post, I read it all.</p></div>
<footer>2020</footer></body></html>"""


def test_main_text_of_a_page():
    assert maintext.main_text(PAGE) == "Title & more\n\nShort.\n\nSecond para with link in it.\n\none\n\ntwo\n\na b"


def test_main_text_of_odd_pages(spark):
    pages = [(0, None, None), (1, "u", ""), (2, "u", "plain words without any tag, but a sentence. And one more of them."),
             (3, "u", "<p>unclosed <b>bold <i>text that goes on for a while, with words."), (4, "u", "</div></p><<>&amp;&bogus;"),
             (5, None, "<nav><a href=1>x</a></nav>"), (1, "u", "")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'clash' text", "1 n_chars")
    got = collected(maintext.extract(df))
    assert len(got) == 7 and (0, None, "", 0) in got and got.count((1, "u", "", 0)) == 2 and (5, None, "", 0) in got
    assert (2, "u", pages[2][2], len(pages[2][2])) in got
    assert maintext.extract(df.limit(0)).collect() == []


def random_page(r: random.Random) -> str:
    def text():
        words = r.choices(["word", "text", "<b>bold</b>", "a &lt; b", "und"], k=r.choice([1, 2, 4, 9, 30]))
        return " ".join(words) + r.choice(["", "."])

    def block():
        t = text()
        return r.choice([f"<p>{t}</p>", f"<p>{t}", f"<h2 id=search>{t}</h2>", f"<ul><li>{t}<li><a href=x>{text()}</a></ul>",
                         f"<p><a href='y>z'>{t}</a></p>", f"<div class=comments>{t}</div>", f"<nav><a href=z>{t}</a></nav>", t])

    inner = "".join(block() for _ in range(r.randint(0, 3)))
    around = r.choice(["<article>{}</article>", "<div class='story with-sidebar'>{}</div>", "<div>{}</div>", "<div class=widget><main>{}</main></div>"])
    return block() + around.format(inner) + block() + r.choice(["", "<footer>end</footer>", "</div></p>"])


def test_main_text_against_brute_force(spark):
    """The cheapest of all labellings of a page's blocks, of several the one of most blocks, and what the cut changes."""
    r = random.Random(16)
    pages = [random_page(r) for _ in range(250)]
    df = spark.createDataFrame([(k, "u", p) for k, p in enumerate(pages)], "page_id bigint, url string, html string")
    got = {x["page_id"]: x["text"] for x in maintext.extract(df).collect()}
    changed = 0
    for k, p in enumerate(pages):
        found = maintext.blocks(p)
        scores, edges = [maintext.score(b) for b in found], maintext.smoothness(found)

        def cost(sides):
            return (sum(abs(s) for s, x in zip(scores, sides) if (s > 0) != x) + sum(c for a, b, c in edges if sides[a] != sides[b]))

        sides = [[bool(m >> j & 1) for j in range(len(found))] for m in range(1 << len(found))]
        least = min(map(cost, sides))
        best = max((s for s in sides if cost(s) < least + 1e-9), key=sum)
        assert got[k] == "\n\n".join(b.text for b, x in zip(found, best) if x), p
        changed += best != [s >= 0 for s in scores]
    assert changed >= 50  # the classifier alone says otherwise


LONG = "A paragraph of more than twenty words that tells a story, one that nobody would take for a menu or for an advert at all."


@pytest.mark.parametrize("page, text", [
    (f'<div class="content with-sidebar"><article><p>{LONG}</p></article></div>', LONG),
    (f'<div class="widget"><article><h2 id="search">Search</h2><p>{LONG}</p></article></div>', f"Search\n\n{LONG}"),
    (f'<div><h2>Steps</h2><p>{LONG}</p><p>Salt</p><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div>',
     f"Steps\n\n{LONG}\n\nSalt\n\n{LONG}"),  # by the classifier alone the short blocks went
    (f'<article><p>{LONG}</p><p><a href=x>The paper</a></p><p>{LONG}</p></article>', f"{LONG}\n\nThe paper\n\n{LONG}"),
    ("<nav><a href=/>Home</a></nav><div class=ad>Buy it now, really.</div><article><p>One</p></article><footer>End.</footer>", "One"),
    ("<div class=ad>Buy it now, really.</div><article>One</article><footer>End.</footer>", "One"),
    (f'<article><p title="a > b">{LONG}</p><p title="never closed>{LONG}</article>', f"{LONG}\n\n{LONG}"),
    (f'<p>{LONG}<!-- <p>{LONG}', LONG), (f'<p>{LONG}</p><script>if (a > b) "{LONG}"', LONG),
])
def test_main_text_of_wrapped_and_broken_pages(page, text):
    assert maintext.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<a " + '"' * 200_000, "<a x=\">\"" * 50_000, "<b>" * 30_000 + "</div>" * 30_000, "<div>a" * 20_000, "<button>x" * 30_000,
    "</a" * 200_000, "<!" * 200_000, "<noscript>" * 30_000, "<p><b>" * 30_000, "<td><i>" * 30_000 + "</b>" * 30_000,
    "<a '" * 50_001 + ">", "<a x=\"" * 50_001 + ">"])
def test_no_page_takes_long(page):
    import time

    begin = time.process_time()
    maintext.main_text(page)
    assert time.process_time() - begin < 10


def test_minimum_cut_is_least_by_brute_force():
    r = random.Random(6)
    for _ in range(300):
        n = r.randint(1, 8)
        scores = [round(r.uniform(-3, 3), 2) for _ in range(n)]
        edges = [(a, b, round(r.uniform(0, 2), 2)) for a in range(n) for b in range(a + 1, n) if r.random() < 0.4]

        def cost(sides):
            return (sum(s for s, x in zip(scores, sides) if s > 0 and not x) + sum(-s for s, x in zip(scores, sides) if s < 0 and x)
                    + sum(c for a, b, c in edges if sides[a] != sides[b]))

        least = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert abs(cost(maintext.minimum_cut(scores, edges)) - least) < 1e-9
