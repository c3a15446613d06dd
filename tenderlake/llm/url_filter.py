"""URL policy with redirect equivalence, DataFrame operations only.

Rules name a host (it and all subdomains) and a path prefix; the longest
fitting rule decides.  Redirects and canonical links make URLs aliases of each
other; aliases are the connected components of the link graph.  A URL without
a rule of its own takes the decision of its aliases: allowed when any alias
has an explicit allow, else blocked when any alias is blocked, else allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import cut
from tenderlake.llm.components import connected_components


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path



def ascii_host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest fitting rule (of equally long ones an allow), else NULL."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.name)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: Sequence[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: r.verdict == "allow"):
        out = F.when(rule == r.name, F.lit(r.verdict)).otherwise(out)
    return out


def node(url: Column) -> Column:
    """A URL as a graph node: no fragment (it never reaches a server), scheme and host lower-cased.  No ``://``: NULL."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    return F.when(head != "", F.concat(F.lower(head), F.substring(bare, F.length(head) + 1, F.length(bare))))


def _tag_attribute(html: Column, tag: str, must: str, attribute: str) -> Column:
    """Value of ``attribute`` in the first ``tag`` whose text matches ``must``, in any attribute order."""
    found = F.regexp_extract(html, rf"(?is)<{tag}\b(?=[^>]*{must})[^>]*>", 0)
    quoted = F.regexp_extract(found, rf"(?is)\b{attribute}\s*=\s*([\"'])(.*?)\1", 2)
    bare = F.regexp_extract(found, rf"(?is)\b{attribute}\s*=\s*([^\s\"'>]+)", 1)
    return F.when(quoted != "", quoted).when(bare != "", bare)


def absolute(link: Column, base: Column) -> Column:
    """Resolve a link against its page: absolute, ``//host``, ``/path``, or relative to the page's folder."""
    link = F.trim(F.regexp_replace(link, "&amp;", "&"))
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(scheme, link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link != "", F.concat(F.regexp_replace(folder, r"([^/])$", "$1/"), link)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) nodes: canonical links and immediate (meta refresh) redirects of the pages."""
    url, html = F.col(url_col), F.col(html_col)
    canonical = _tag_attribute(html, "link", r"\brel\s*=\s*[\"']?canonical\b", "href")
    refresh = F.regexp_extract(_tag_attribute(html, "meta", r"http-equiv\s*=\s*[\"']?refresh\b", "content"),
                               r"(?is)url\s*=\s*[\"']?([^\"'>]+)", 1)
    # most pages have neither tag: a plain substring test spares them the patterns
    low = F.lower(html)
    return (pages.select(url.alias("url"), F.explode(F.array(
                F.when(low.contains("canonical"), canonical),
                F.when(low.contains("refresh"), refresh))).alias("link"))
            .where(F.col("link").isNotNull() & (F.col("link") != ""))
            .select(node(F.col("url")).alias("src"), node(absolute(F.col("link"), F.col("url"))).alias("dst"))
            .where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst"))


def alias_decisions(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(node, alias_verdict) for the nodes whose component holds a ruled URL."""
    members = cut(connected_components(edges))
    ruled = members.withColumn("verdict", rule_verdict(
        matching_rule(ascii_host_of(F.col("node")), path_of(F.col("node")), rules), rules))
    decided = (ruled.where("verdict IS NOT NULL").groupBy("component")
               .agg(F.min("verdict").alias("alias_verdict")))  # allow sorts before block
    return members.join(decided, "component").select("node", "alias_verdict")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, default: str = "allow",
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, decided_by of every page.

    ``redirects`` adds (src, dst) URLs of a crawl log.  NULL urls and urls
    without ``://`` have an empty host and path, no rule and no alias.
    """
    url = F.col(url_col)
    edges = page_links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("src")).alias("src"), node(F.col("dst")).alias("dst")))
    alias = alias_decisions(edges, rules)
    own = (pages.select(F.col(id_col).alias("page_id"), ascii_host_of(url).alias("host"), path_of(url).alias("path"),
                        node(url).alias("node"))
           .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)))
    return (own.join(alias, "node", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(rule_verdict(F.col("rule"), rules), "alias_verdict", F.lit(default)).alias("verdict"),
                    F.when(F.col("rule").isNotNull(), "rule").when(F.col("alias_verdict").isNotNull(), "alias")
                    .otherwise("default").alias("decided_by")))
