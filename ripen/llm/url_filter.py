"""URL filtering under redirect equivalence.

URLs that redirect to one another or name one another as canonical are aliases:
the classes are the connected components of redirect edges (a given table, and
``<meta http-equiv=refresh>`` targets), canonical-link edges (``<link
rel=canonical>``) and the edge from each URL to its bare form (without fragment
and ``utm_*`` parameters, which never select another document).  Targets are
resolved against the page's URL, or its ``<base href>``, with their character
references decoded.

A rule is an action, a host and a path prefix; it fits its host and all
subdomains, and the longest fitting rule decides a URL.  A URL without a rule
takes the decision of its class: allow if any alias is explicitly allowed, else
block if any alias is blocked, else allow.

Rules are a parameter of the caller (they are in the plan, not in a table), so
judging them needs no join.  Class decisions meet the pages in an equi-join on
the URL; only URLs with an edge take part in it.

Nulls: a null URL, or one without "://", has an empty host and path, fits no
rule, has no aliases and is allowed.  Rows with equal URLs get equal verdicts.
A null html has no links.  Input columns named host, path, rule, verdict or class are
replaced.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .components import connected_components
from .html_extract import attributes_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TAG = r"""(?is)<(?:link|meta|base)(?=[\s/>])(?:"[^"]*+"|'[^']*+'|[^>"'])*+>"""
_REFRESH = re.compile(r"""\s*[\d.]*\s*(?:[;,\s]\s*(?:url\s*=\s*)?|url\s*=\s*)(?:"([^"]*)|'([^']*)|(.*))""", re.I | re.S)
_ABSOLUTE = re.compile(r"[a-z][a-z0-9+.-]*://", re.I)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, action) of the longest fitting rule, or null.  rules: (action, host/path)."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):        # later ones are longer and win
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def bare_url(url: Column) -> Column:
    """Without fragment and utm_* parameters; the host in lower case."""
    url = F.regexp_replace(url, "#.*$", "")
    url = F.regexp_replace(F.regexp_replace(url, r"(?<=[?&])utm_[^&]*(&|$)", ""), r"[?&]$", "")
    cut = F.length(F.regexp_extract(url, r"(?s)^.*?://[^/?]*", 0))
    return F.concat(F.translate(F.substring(url, F.lit(1), cut), UPPER, LOWER), F.substring(url, cut + 1, F.length(url)))


def _resolve(base: str, target: str) -> str | None:
    target = re.sub(r"[\t\n\r]", "", target).strip()
    if not target:                                              # names nothing
        return None
    if _ABSOLUTE.match(target):                                 # stays as it is written
        return target
    try:
        url = urljoin(base, target)
    except ValueError:
        return None
    return url if "://" in url else None


def targets_of(url: str, tags: list[str]) -> list[str]:
    """The canonical and refresh targets among a page's link, meta and base tags."""
    base, found = None, []
    for tag in tags:
        name = re.match("<([a-zA-Z]+)", tag)[1].lower()
        given = attributes_of(tag[1 + len(name):-1])
        if name == "base" and base is None and "href" in given:
            base = _resolve(url, given["href"])
        elif name == "link" and "canonical" in given.get("rel", "").lower().split():
            found.append(given.get("href", ""))
        elif name == "meta" and given.get("http-equiv", "").strip().lower() == "refresh":
            m = _REFRESH.match(given.get("content", ""))
            found.append(next((x for x in m.groups() if x), "") if m else "")
    out = (_resolve(base or url, x) for x in found)
    return [x for x in out if x]


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): edges that a page declares, targets resolved, and the edge to its bare form."""
    known = pages.where(F.col(url).contains("://"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b) for a, tags in zip(batch.column("a").to_pylist(), batch.column("tags").to_pylist()) for b in targets_of(a, tags)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["a", "b"])

    declared = (known.where(F.lower(F.col(html)).rlike("canonical|refresh"))
                .select(F.col(url).alias("a"), F.regexp_extract_all(html, F.lit(_TAG), 0).alias("tags")).where(F.size("tags") > 0)
                .mapInArrow(run, "a string, b string"))
    bare = known.select(F.col(url).alias("a"), bare_url(F.col(url)).alias("b"))
    return declared.unionByName(bare).where("a <> b")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` (without ``html``) with host, path, rule, verdict and class (the smallest alias, null without one).

    redirects: (source, target) URLs.
    """
    edges = link_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.toDF("a", "b").where("a is not null and b is not null and a <> b"))
    parts = cut_lineage(connected_components(edges))
    node = F.col("node")
    action = best_rule(host_of(node), path_of(node), rules)["action"]
    verdicts = (parts.select("component", action.alias("action")).groupBy("component")
                .agg(F.max((F.col("action") == "allow").cast("int")).alias("allowed"), F.max((F.col("action") == "block").cast("int")).alias("blocked")))
    by_class = F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").otherwise("allow")
    aliases = (parts.join(verdicts, "component")
               .select(F.struct(F.col("node").alias("url"), F.lit(0).cast("long").alias("salt")).alias("__at"), F.col("component").alias("__class"), by_class.alias("__by_class")))
    # URLs that are in no edge can't match; each gets a key of its own, so that a null key gathers no rows
    rows = pages.drop(html).withColumn("__at", F.when(F.col(url).isNotNull(), F.struct(F.col(url).alias("url"), F.lit(0).cast("long").alias("salt")))
                                       .otherwise(F.struct(F.lit("").alias("url"), F.monotonically_increasing_id().alias("salt"))))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    return (rows.join(aliases, "__at", "left")
            .withColumns({"host": host, "path": path, "__rule": best_rule(host, path, rules)})
            .select(*(c for c in pages.columns if c not in (html, "host", "path", "rule", "verdict", "class")), "host", "path",
                    F.col("__rule.rule").alias("rule"),
                    F.coalesce("__rule.action", "__by_class", F.lit("allow")).alias("verdict"), F.col("__class").alias("class")))
