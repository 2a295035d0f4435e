"""URL filters with redirect equivalence.

A url is judged by the longest rule that fits its host and path. Urls that
redirect to one another, or name one another as canonical, are aliases:
connected components over those edges carry a decision from judged urls to
aliases that no rule fits. Inside a component an explicit allow precedes a
block; without either a url is allowed.

Edges come from the pages: ``<link rel=canonical href>``, ``<meta
http-equiv=refresh>``, and a url's own normal form (no scheme and no fragment,
``/`` for an empty path), which is the node that stands for it. Urls that differ
in their query, in ``www.`` or in a last slash are aliases only where an edge says so.

Defined results: a null url or one without ``://`` has an empty host and path
and no rule, is no alias of any other and is allowed; a null html has no
edges; repeated rows are judged one by one; extra columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components

#: (verdict, host, path) of each rule (fixed values).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    """The query with its question mark; empty without one."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does. Equal lengths: the first given."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones, the longer, win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def node_of(url: Column) -> Column:
    """The normal form that stands for a url and its variants; null without a host."""
    host, path = host_of(url), path_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query_of(url)))


def target_of(url: Column, html: Column) -> tuple[Column, Column]:
    """Absolute urls that a page redirects to and names as canonical (null: none)."""
    def value(tag, name):
        return F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(?:\"\s*([^\"]*?)\s*\"|'\s*([^']*?)\s*'|([^\s>]+))", 0)

    def unquoted(attribute):
        return F.trim(F.regexp_replace(F.regexp_replace(attribute, r"(?is)^\w+\s*=\s*", ""), r"^[\"']|[\"']$", ""))

    def absolute(link):
        root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
        scheme = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
        folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*(?=/))?)", 1)
        link = F.regexp_replace(link, "&amp;", "&")
        return (F.when(link == "", F.lit(None)).when(link.contains("://"), link)
                .when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("/"), F.concat(root, link))
                .when(link.startswith("#"), url)
                .when(link.startswith("?"), F.concat(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), link)).otherwise(F.concat(folder, F.lit("/"), link)))

    html = F.coalesce(html, F.lit(""))
    canonical = F.regexp_extract(html, r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?\s*canonical\b)[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b)[^>]*>", 0)
    to = F.regexp_extract(unquoted(value(refresh, "content")), r"(?is)url\s*=\s*[\"']?\s*([^\"'\s]+)", 1)
    return absolute(to), absolute(unquoted(value(canonical, "href")))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, node, component (null: no alias) of every page."""
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = base.withColumn("host", host).withColumn("path", path)
    rule, own = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("page_id", "host", "path", rule.alias("rule"), own.alias("own"),
                           node_of(F.col("url")).alias("node"))

    redirect, canonical = target_of(F.col("url"), F.col("html"))
    links = (base.select("url", F.explode(F.array_distinct(F.array_compact(F.array(redirect, canonical)))).alias("to"))
             .select(node_of(F.col("url")).alias("src"), node_of(F.col("to")).alias("dst"),
                     host_of(F.col("to")).alias("to_host"), path_of(F.col("to")).alias("to_path")))
    found = components(links.select("src", "dst"))

    # explicit decisions of each component: of its pages and of targets that are not pages
    flags = lambda verdict: (F.max((verdict == "allow").cast("int")).alias("allowed"),
                             F.max((verdict == "block").cast("int")).alias("blocked"))
    target_own = rule_of(F.col("to_host"), F.col("to_path"), rules)[1]
    said = (judged.where(F.col("own").isNotNull() & F.col("node").isNotNull()).select("node", "own")
            .unionByName(links.where(F.col("dst").isNotNull()).select(F.col("dst").alias("node"), target_own.alias("own")))
            .where(F.col("own").isNotNull()))
    by_node = said.groupBy("node").agg(*flags(F.col("own")))
    # a node without edges is its own component: variants of one url share its decisions
    by_component = (by_node.join(found, "node", "left")
                    .groupBy(F.coalesce("component", "node").alias("component"))
                    .agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")))
    return (judged.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            .join(by_component, "component", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("own", F.when(F.col("allowed") == 1, F.lit("allow")).when(F.col("blocked") == 1, F.lit("block")),
                               F.lit("allow")).alias("verdict"), "node", "component"))
