"""URL filters over redirect equivalence: aliases of a blocked address are blocked as well."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fxtape.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
TARGET = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)"""


@dataclass(frozen=True)
class UrlRule:
    """Fits a host with all its subdomains, for paths that begin with ``path``."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def address(url: Column) -> Column:
    """One name for the forms of an address that redirect to each other: no scheme, no fragment, no
    default port, no trailing slash. Null without a host."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 3)
    return F.when(host != "", F.concat(host, path, query))


def rule_for(host: Column, path: Column, rules: list[UrlRule], value: str) -> Column:
    """The longest rule that fits, an allow before a block of the same length; else null."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.action != "allow", r.text))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(getattr(r, value))) for r in ranked])


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of the canonical link and the refresh redirect a page states.

    Targets may be absolute, begin with ``//`` or with ``/``; others name no host and are left out.
    """
    def link(tag: str, value: str) -> Column:
        return F.regexp_extract(F.regexp_extract(F.col(html), tag, 0), value, 1)

    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), PARTS, 1)
    found = pages.select(
        F.col(url).alias("url"), host.alias("host"),
        F.explode(F.array(link(CANONICAL, HREF), link(REFRESH, TARGET))).alias("to"),
    ).where("to != ''")
    to = F.col("to")
    full = (
        F.when(to.contains("://"), to)
        .when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("/") & (F.col("host") != ""), F.concat(F.lit("http://"), "host", to))
    )
    return found.select("url", full.alias("target")).where("target IS NOT NULL")


def filtered(
    pages: DataFrame, edges: DataFrame, rules: list[UrlRule], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """(key, host, path, rule, verdict, source) for every page.

    The page's own rule decides first. A page without one takes the decision of its component over
    ``edges`` (url, target): an explicit allow of any alias wins over blocks; without a rule in the
    whole component the page is allowed. Forms of one address are aliases of each other without an edge. ``source`` is ``rule``, ``alias`` or ``default``.

    Rules are configuration: they are compiled into one expression. Decisions are reduced per
    address before they meet the edges, so a host or an address with a third of all rows is a small
    group. Null, empty and malformed addresses have an empty host, no rule and no alias; repeated
    rows are judged alike; empty tables give no rows; other columns are not touched. Edge ends need not be pages.
    """
    own = pages.select(
        F.col(key), address(F.col(url)).alias("node"),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    )
    host, path = F.col("host"), F.col("path")
    own = own.select(
        "*", rule_for(host, path, rules, "text").alias("rule"),
        rule_for(host, path, rules, "action").alias("action"),
    )
    ends = edges.select("url", "target")
    pairs = ends.select(address(F.col("url")).alias("a"), address(F.col("target")).alias("b"))
    linked = components(pairs)

    def weight(action: Column) -> Column:
        return F.when(action == "allow", 2).when(action == "block", 1)

    every = ends.select(F.explode(F.array("url", "target")).alias("u")).select(
        address(F.col("u")).alias("node"), host_of(F.col("u")).alias("host"),
        path_of(F.col("u")).alias("path"),
    )
    stated = every.select("node", weight(rule_for(host, path, rules, "action")).alias("w")).union(
        own.select("node", weight(F.col("action")))
    )
    by_node = stated.where("node IS NOT NULL AND w IS NOT NULL").groupBy("node").agg(F.max("w").alias("w"))
    # A node without an edge to another one is a group of its own: its forms share their decisions.
    grouped = by_node.join(linked, "node", "full").select("node", F.coalesce("component", "node").alias("component"), "w")
    by_group = grouped.where("w IS NOT NULL").groupBy("component").agg(F.max("w").alias("w"))
    aliases = grouped.select("node", "component").join(by_group, "component").select("node", "w")
    word = F.when(F.col("w") == 1, "block").otherwise("allow")
    return own.join(aliases, "node", "left").select(
        key, "host", "path", "rule",
        F.coalesce("action", word).alias("verdict"),
        F.when(F.col("action").isNotNull(), "rule").when(F.col("w").isNotNull(), "alias")
        .otherwise("default").alias("source"),
    )
