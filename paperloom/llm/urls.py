"""URL rules whose decisions reach aliases of a page.

A rule names a host and the start of a path, and allows or blocks the host's and its subdomains'
pages below that path; of the rules that fit, the longest decides. Pages without a rule follow their
aliases: redirects (meta refresh) and canonical links in the pages' HTML are edges between URLs, and
the connected components of that graph are sets of aliases. If any URL of the component is allowed
by a rule, its pages are allowed; else, if any is blocked, they are blocked; all others are allowed.

URLs are nodes without scheme, default port, fragment, tracking parameters and trailing slash, as
64-bit hashes. Everything is a built-in expression, a join or an aggregation; decisions are
combined per component before they are joined back, and the components are found in rounds on
written tables.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule, is no
node, and is allowed; null HTML has no edges; repeated rows are judged alike; an empty table gives
no rows. Columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import whole
from .components import components

ALLOW, BLOCK = "allow", "block"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)
# Query parameters that do not change the page.
TRACKING = r"(?i)(?:^|&)(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.substr(url, F.locate("://", url) + 3)
    known = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return (F.when(known, F.translate(host, UPPER, UPPER.lower())).otherwise(""), F.when(known, path).otherwise(""))


def fitting(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The fitting rule as ``name, verdict``, or null. The rules are a short fixed list."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first, as it is put on last
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def node(url: Column) -> Column:
    """The URL's place in the alias graph; null if it is none."""
    host, path = host_and_path(url)
    query = F.regexp_replace(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    bare = F.concat(F.regexp_replace(host, ":(?:80|443)$", ""), F.regexp_replace(path, "/$", ""),
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", F.xxhash64(bare))


def targets(url: Column, html: Column) -> Column:
    """Absolute URLs that the page names as its redirect or canonical address."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^<>]*+>"), F.lit(0))
    value = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"

    def attribute(tag: Column, name: str) -> Column:
        pattern = rf"(?i)[\s\"']{name}{value}"
        return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])

    def named(tag: Column) -> Column:
        canonical = F.lower(attribute(tag, "rel")).rlike(r"(?:^|\s)canonical(?:\s|$)")
        refresh = F.lower(F.trim(attribute(tag, "http-equiv"))) == "refresh"
        to = F.regexp_extract(attribute(tag, "content"), r"(?i)\burl\s*=\s*['\"]?([^'\"]*)", 1)
        return F.trim(F.when(canonical, attribute(tag, "href")).when(refresh, to).otherwise(""))

    scheme = F.regexp_extract(url, "^([^:/?#]*)://", 1)
    root = F.regexp_extract(url, "^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(url, "^[^:/?#]*://[^/?#]*(?:[^?#]*/)?", 0)

    def absolute(to: Column) -> Column:
        to = F.replace(to, F.lit("&amp;"), F.lit("&"))
        joined = F.when(folder.endswith("/"), F.concat(folder, to)).otherwise(F.concat(root, F.lit("/"), to))
        return (F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), to).when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
                .when(to.startswith("/"), F.concat(root, to)).otherwise(joined))

    found = F.filter(F.transform(tags, named), lambda t: (t != "") & ~t.startswith("#"))
    return F.coalesce(F.transform(found, absolute), F.array().cast("array<string>"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``row`` (all columns), ``host``, ``path``, ``rule`` and ``verdict``."""
    url = F.col(f"`{url_col}`").cast("string")
    sources = pages.select(url.alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")).dropna()
    links = sources.select("url", targets(F.col("url"), F.col("html")).alias("to"))
    links = materialize(links.select("url", F.explode("to").alias("to")), "links")
    edges = links.select(node(F.col("url")).alias("a"), node(F.col("to")).alias("b")).dropna()
    aliases = materialize(components(edges), "aliases")
    # Every URL that is known, with its rule; decisions are put together per node, then per component.
    known = pages.select(url.alias("url")).union(links.select("to"))
    host, path = host_and_path(F.col("url"))
    ruled = known.select(node(F.col("url")).alias("node"), fitting(host, path, rules)["verdict"].alias("v"))
    ruled = ruled.where("v is not null and node is not null").groupBy("node").agg(
        F.max((F.col("v") == ALLOW).cast("int")).alias("allow"), F.max((F.col("v") == BLOCK).cast("int")).alias("block"))
    ruled = ruled.join(aliases, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.max("allow").alias("allow"), F.max("block").alias("block"))
    blocked = ruled.where((F.col("block") == 1) & (F.col("allow") == 0)).select("root")
    members = blocked.join(aliases, "root").select("node").union(blocked.select("root")).distinct()
    # Only nodes that take a block from an alias are joined back.
    host, path = host_and_path(url)
    out = pages.select(whole(pages).alias("row"), host.alias("host"), path.alias("path"), node(url).alias("node"))
    out = out.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    out = out.join(members.withColumn("hit", F.lit(True)), "node", "left")
    alias = F.when(F.col("hit"), BLOCK).otherwise(ALLOW)
    return out.select("row", "host", "path", F.col("fit.name").alias("rule"),
                      F.coalesce(F.col("fit.verdict"), alias).alias("verdict"))


def allowed(pages: DataFrame, rules: Sequence[Rule] = RULES, **columns) -> DataFrame:
    """The pages that are not blocked, with their own columns."""
    return judge(pages, rules, **columns).where(F.col("verdict") == ALLOW).select("row.*")
