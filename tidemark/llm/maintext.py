"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks of text, each with its place in the element tree. A
classifier scores each block (above 0: content). The score is the capacity of
its edge to the source (content) or the sink (boilerplate); neighbours in
page order and blocks under one parent are tied by smoothness edges, the
weaker the farther apart they are in the tree. The maximum flow saturates the
cheapest cut, and the blocks left on the source's side are the main text.

Defined results: a null or empty page, and one whose blocks are all
boilerplate, give an empty text; unclosed and stray tags are borne with; a quote
that is never closed hides nothing, nor do quotes after a tag that never ends; pages
of any length and depth are read whole, in time that follows their length; repeated rows are worked on one by one; extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Elements (fixed values of the markup language).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style template noscript svg math iframe object canvas audio video select option datalist "
                    "textarea button title head".split())
RAW = frozenset("script style textarea title iframe noscript template svg math".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
                   "table caption tbody td tfoot th thead tr ul".split())
#: Elements that end an open element of the same group.
CLOSED_BY_SAME = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
                  "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that speak for boilerplate and for content.
AGAINST = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                    "disclaimer disqus footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice "
                    "pager pagination popup promo promoted promotion recommended related reply replies respond search share "
                    "sharing sidebar signup social sponsor sponsored subscribe subscription tags toolbar widget widgets "
                    "complementary contentinfo dialog alert alertdialog form".split())
IN_FAVOUR = frozenset("article articlebody body content entry main post story text".split())
#: Beginnings of a class name that say what a wrapper has beside it, not what it is.
LAYOUT = ("with", "without", "has", "no", "has-no")
#: Parameters of the classifier, in the cut's units, and of smoothness.
WEIGHTS = {"base": -0.6, "boilerplate": -6.0, "named": -3.4, "article": 1.2, "favour": 0.5, "links": -1.2, "words": 0.08,
           "words_most": 2.0, "sentence": 0.6, "heading": 0.3}
ADJACENT, SIBLING = 0.9, 0.45

# an attribute's value may hold a > between quotes; what has been read is not given back, so that no page takes long
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<([a-zA-Z][^\s/>]*+)|</([a-zA-Z][^\s/>]*+)[^>]*+>|<[!?][^>]*+>", re.S)
_STRICT = re.compile(r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>", re.S)
_LOOSE = re.compile(r"([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?", re.S)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")


class Node:
    """A block element of the tree."""

    __slots__ = ("parent", "depth")

    def __init__(self, parent):
        self.parent, self.depth = parent, parent.depth + 1 if parent else 0


class Block:
    """Text under one parent: its pieces, how many characters stand in links, and what surrounds it."""

    __slots__ = ("text", "linked", "node", "boilerplate", "named", "article", "favour", "heading")

    def __init__(self, text, linked, node, boilerplate, named, article, favour, heading):
        self.text, self.linked, self.node, self.boilerplate, self.named = text, linked, node, boilerplate, named
        self.article, self.favour, self.heading = article, favour, heading


def _evidence(name: str, attributes: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element is hidden or boilerplate by its tag, boilerplate by its names, or spoken for by them."""
    against = name in ("nav", "footer", "aside", "form", "menu", "dialog") or name == "header" and not in_article
    named = favour = False
    if attributes and not attributes.isspace():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(
                    r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                against = True
            elif key in ("class", "id", "role") and name not in ("html", "body") and name not in HEADINGS:
                for part in value.split():
                    words = [w.lower() for w in _WORD.findall(part)]
                    if words and words[0] in LAYOUT:
                        continue
                    favour = favour or not IN_FAVOUR.isdisjoint(words)
                    named = named or name not in ("article", "main") and not AGAINST.isdisjoint(words)
    return against, named, favour and not (against or named)


class _Open:
    """An open element."""

    __slots__ = ("name", "node", "against", "named", "article", "favour", "link", "before", "block_before")

    def __init__(self, name, node, against, named, article, favour, link, before, block_before):
        self.name, self.node, self.against, self.named, self.article = name, node, against, named, article
        self.favour, self.link, self.before, self.block_before = favour, link, before, block_before


def blocks(page: str) -> list[Block]:
    """The page's blocks of text, in page order."""
    out: list[Block] = []
    # open elements; each knows the place of the one before of its name and of the block before it (-1: none)
    stack = [_Open("", Node(None), False, False, False, False, False, -1, -1)]
    newest: dict[str, int] = {}  # place of the innermost open element of a name
    block_at = 0                 # place of the innermost open block
    pieces: list[str] = []
    linked = at = 0
    last_end = page.rfind(">")
    never_closed: set[str] = set()
    tag = _STRICT

    def flush():
        nonlocal linked
        text = " ".join(entities.unescape("".join(pieces)).split())
        if text:
            top = stack[-1]
            out.append(Block(text, linked, stack[block_at].node, top.against, top.named, top.article, top.favour,
                             any(e.name in HEADINGS for e in stack[-3:])))
        pieces.clear()
        linked = 0

    def add(text):
        nonlocal linked
        if text:
            pieces.append(text)
            if stack[-1].link:
                linked += len(text.strip())

    def pop_to(k):
        nonlocal block_at
        if block_at >= k:
            flush()
        for e in reversed(stack[k:]):
            newest[e.name] = e.before
            if len(stack) - 1 == block_at:
                block_at = e.block_before
            stack.pop()

    def close_same(open_name):
        """Ends an open element that a new one of its group replaces."""
        k = block_at
        while k > 0:
            if stack[k].name == open_name:
                return pop_to(k)
            if stack[k].name not in ("p", "td", "th"):
                return None
            k = stack[k].block_before

    while at <= last_end:
        m = _TOKEN.search(page, at, last_end + 1)
        add(page[at:m.start() if m else last_end + 1])
        if not m:
            at = last_end + 1
            break
        at = m.end()
        name, end = m.group(1), m.group(2)
        if name:
            got = tag.match(page, at, last_end + 1)
            if not got:  # it never ends: from here on a tag ends with the next >
                tag = _LOOSE
                got = tag.match(page, at, last_end + 1)
            attributes, at = got.group(1), got.end()
            closed = attributes.endswith("/")
            name = name.lower()
            if name in SKIPPED and not (closed and name in ("svg", "math")):
                if name in RAW or name in ("button", "select", "datalist", "object", "canvas", "audio", "video"):
                    close = None if name in never_closed else re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at, last_end + 1)
                    if name in ("button", "select"):
                        add(" ")
                    # an element that is never closed hides no text, but for those whose content is raw
                    if close:
                        at = close.end()
                    elif name in ("script", "style", "textarea", "title"):
                        at = len(page)
                    else:
                        never_closed.add(name)
                if name != "head":
                    continue
            if name == "br":
                add(" ")
                continue
            if name in BLOCKS:
                flush()
                for open_name in ("p", "li", "dt", "dd", "td", "th", "tr"):
                    if name in CLOSED_BY_SAME[open_name] and newest.get(open_name, -1) >= 0:
                        close_same(open_name)
            if name in VOID or closed:
                continue
            parent = stack[-1]
            against, named, favour = _evidence(name, attributes, parent.article)
            article = name in ("article", "main")
            # names of what lies around an article say nothing of the article itself
            stack.append(_Open(name, Node(stack[block_at].node) if name in BLOCKS else None, parent.against or against,
                               named or parent.named and not article, parent.article or article, parent.favour or favour,
                               parent.link or name == "a", newest.get(name, -1), block_at))
            newest[name] = len(stack) - 1
            if name in BLOCKS:
                block_at = len(stack) - 1
        elif end:
            end = end.lower()
            if end in BLOCKS:
                flush()
            k = newest.get(end, -1)
            if k > 0 and (end in BLOCKS or k > block_at):
                pop_to(k)
        elif page.startswith("<!--", m.start()) and not m.group().endswith("-->") or (
                page.startswith("<![CDATA[", m.start()) and not m.group().endswith("]]>")):
            at = len(page)  # never closed
    add(page[at:].partition("<!--")[0])
    flush()
    return out


def score(block: Block) -> float:
    """The classifier: above 0 for content. Weighed evidence of tags, names, links, length and sentences."""
    w = WEIGHTS
    if block.boilerplate:
        return w["boilerplate"]
    n = len(block.text.split())
    total = w["base"] + w["named"] * block.named + min(w["words_most"], w["words"] * n)
    total += w["article"] * block.article + w["favour"] * block.favour + w["heading"] * block.heading
    total += w["sentence"] * bool(_SENTENCE.search(block.text))
    return total + w["links"] * min(1.0, block.linked / max(1, len(block.text)))


def _distance(a: Node, b: Node) -> int:
    """Steps in the element tree between two blocks' parents."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a, steps = a.parent, steps + 1
        else:
            b, steps = b.parent, steps + 1
    return steps


def smoothness(page_blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours in page order and consecutive blocks under one grandparent."""
    out, last = [], {}
    for k, block in enumerate(page_blocks):
        if k:
            out.append((k - 1, k, ADJACENT / (1 + _distance(page_blocks[k - 1].node, block.node))))
        above = block.node.parent
        if above in last and last[above] != k - 1:
            out.append((last[above], k, SIBLING / 3))
        last[above] = k
    return out


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut (Dinic's algorithm).

    A positive score is the node's capacity from the source, a negative one to
    the sink; edges hold in both directions. Of several minimum cuts the one
    with the smallest sink side, so that undecided nodes stay.
    """
    if not edges or min(scores, default=0) >= 0 or max(scores, default=0) < 0:
        return [s >= 0 for s in scores]
    n = len(scores)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def edge(a, b, there, back):
        out[a].append(len(to)); to.append(b); room.append(there)  # noqa: E702
        out[b].append(len(to)); to.append(a); room.append(back)  # noqa: E702

    for k, s in enumerate(scores):
        if s > 0:
            edge(source, k, s, 0.0)
        elif s < 0:
            edge(k, sink, -s, 0.0)
    for a, b, c in edges:
        edge(a, b, c, c)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            break
        at, path = [0] * (n + 2), []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                keep = next(k for k, e in enumerate(path) if room[e] <= tiny)
                node = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while at[node] < len(out[node]):
                e = out[node][at[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                at[node] += 1
            if at[node] < len(out[node]):
                path.append(out[node][at[node]])
                node = to[path[-1]]
            elif path:
                node = to[path.pop() ^ 1]
                at[node] += 1
            else:
                break
    # what still reaches the sink is boilerplate
    cut, queue = [True] * (n + 2), deque([sink])
    cut[sink] = False
    while queue:
        a = queue.popleft()
        for e in out[a]:
            if room[e ^ 1] > tiny and cut[to[e]] and to[e] != source:
                cut[to[e]] = False
                queue.append(to[e])
    return cut[:n]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    kept = minimum_cut([score(b) for b in found], smoothness(found))
    return "\n\n".join(b.text for b, keep in zip(found, kept) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    common.arrow_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(p) for p in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return (pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("text"))
            .mapInArrow(run, "page_id bigint, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("bigint")))
