"""URL filter by redirect equivalence (DataFrame functions only).

A rule is (verdict, host, path): it fits its host and all subdomains where the URL's path starts
with the rule's; of the fitting rules the longest decides.  URLs joined by redirects or canonical
links form components; a URL that no rule fits takes its component's decision: allowed if a
member is allowed by a rule (explicit allow goes first), else blocked if a member is blocked by
one, else allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .storage import fresh

#: Rules up to this number become one literal expression; a longer list is joined as a table.
INLINE_RULES = 500

_QUOTED = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*>"""
_BASE = r"""(?is)<base\b(?=[^>]*\bhref\s*=)[^>]*>"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _node(url: Column) -> Column:
    """Key of a URL in the graph: without fragment, scheme and host in lower case."""
    return F.concat(
        F.lower(F.regexp_extract(url, r"(?s)^(.*?://)", 1)), url_host(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    )


def _flat(path: Column) -> Column:
    """``path`` without segments ``.`` and ``..``; a query stays as it is."""
    way, rest = F.regexp_extract(path, r"(?s)^([^?#]*)", 1), F.regexp_extract(path, r"(?s)^[^?#]*(.*)$", 1)
    way = F.regexp_replace(way, r"/(\.\.?)$", "/$1/")
    up = lambda kept: F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
    kept = F.aggregate(F.split(way, "/"), F.array().cast("array<string>"), lambda k, x: F.when(x == ".", k).when(x == "..", up(k)).otherwise(F.concat(k, F.array(x))))
    return F.when(way.contains("/."), F.concat(F.array_join(kept, "/"), rest)).otherwise(path)


def _resolved(base: Column, href: Column) -> Column:
    """An absolute URL for ``href`` as found on page ``base``, without dot segments; null where there is none."""
    href = F.trim(F.regexp_replace(href, "&amp;", "&"))
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url_path(base), r"(?s)^(.*/)", 1)
    return (
        F.when(href.isNull() | (href == "") | href.startswith("#") | (origin == ""), None)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), href))
        .when(href.startswith("/"), F.concat(origin, _flat(href)))
        .when(href.startswith("?"), F.concat(origin, url_path(base), href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .otherwise(F.concat(origin, _flat(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), href))))
    )


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)\b{name}\s*=\s*{_QUOTED}"
    return F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (src, dst) of URLs from each page's canonical link and refresh redirect; a ``<base href>`` is what they start from."""
    told = _resolved(F.col(url), F.nullif(_attribute(F.regexp_extract(html, _BASE, 0), "href"), F.lit("")))
    base = F.coalesce(told, F.col(url))
    canonical = _attribute(F.regexp_extract(html, _CANONICAL, 0), "href")
    content = _attribute(F.regexp_extract(html, _REFRESH, 0), "content")
    refresh = F.regexp_replace(F.regexp_extract(content, r"(?is)\burl\s*=\s*(.*)$", 1), r"""^\s*['"]|['"]\s*$""", "")
    found = pages.where(F.col(url).isNotNull() & F.col(html).rlike(r"""(?i)\b(rel\s*=\s*["']?canonical|http-equiv\s*=\s*["']?refresh)\b"""))
    return found.select(F.col(url).alias("src"), F.explode(F.array(_resolved(base, canonical), _resolved(base, refresh))).alias("dst")).where(
        "dst is not null"
    )


def _fits(host: Column, path: Column, rule_host: Column, rule_path: Column) -> Column:
    return ((host == rule_host) | F.endswith(host, F.concat(F.lit("."), rule_host))) & F.startswith(path, rule_path)


def _ruled(df: DataFrame, rules: list[tuple[str, str, str]], host: str, path: str, rule: str, said: str) -> DataFrame:
    """``df`` with the longest fitting rule (a string like ``net/``) and its verdict, or nulls."""
    if len(rules) <= INLINE_RULES:
        best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
        for kind, h, p in sorted(set(rules), key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r)):
            fits = _fits(F.col(host), F.col(path), F.lit(h), F.lit(p))
            best = F.coalesce(best, F.when(fits, F.lit(h + p)))
            verdict = F.coalesce(verdict, F.when(fits, F.lit(kind)))
        return df.withColumns({rule: best, said: verdict})
    # A long list: equi-join on the host's suffixes, on distinct (host, path) only; ties go as above.
    table = df.sparkSession.createDataFrame(sorted(set(rules)), "kind string, rule_host string, rule_path string")
    h, p = fresh(df, "host_key", "path_key")
    parts = F.split(F.col(h), r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    order = F.struct((-F.length(F.concat("rule_host", "rule_path"))).alias("n"), (F.col("kind") != "allow").alias("b"), "kind", "rule_host", "rule_path")
    won = (
        df.select(F.col(host).alias(h), F.col(path).alias(p))
        .distinct()
        .withColumn("rule_host", F.explode(suffix))
        .join(table, "rule_host")
        .where(F.startswith(p, "rule_path"))
        .groupBy(h, p)
        .agg(F.min(order).alias("w"))
        .select(h, p, F.concat("w.rule_host", "w.rule_path").alias(rule), F.col("w.kind").alias(said))
    )
    return df.join(won, (F.col(host) == F.col(h)) & (F.col(path) == F.col(p)), "left").drop(h, p)


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    links: DataFrame | None = None,
    url: str = "url",
    host: str = "host",
    path: str = "path",
    rule: str = "rule",
    verdict: str = "verdict",
) -> DataFrame:
    """Judge every row of ``pages``; all its columns stay, host, path, rule and verdict are added.

    ``links`` (src, dst URLs) holds redirects and canonical links; those found by
    :func:`page_links` are one source of it.  A null URL, or one without ``://``, has an empty
    host and path, belongs to no component and is allowed unless a rule fits.  Repeated rows get
    the same answer each; an empty table gives an empty result.  A column of ``pages`` with the
    name of an added one is replaced.
    """
    out = pages.drop(*(c for c in (host, path, rule, verdict) if c != url))
    key, said, decided = fresh(out, "url_key", "rule_said", "component_said")
    out = _ruled(out.withColumns({host: url_host(F.col(url)), path: url_path(F.col(url))}), rules, host, path, rule, said)
    if links is None:
        return out.withColumn(verdict, F.coalesce(said, F.lit("allow"))).drop(said)
    ends = links.select(_node(F.col("src")).alias("src"), _node(F.col("dst")).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    parts = connected_components(ends, "src", "dst")
    parts = parts.withColumns({"h": url_host(F.col("node")), "p": url_path(F.col("node"))})
    parts = _ruled(parts, rules, "h", "p", "r", "k")
    whole = parts.groupBy("component").agg(
        F.when(F.max(F.col("k") == "allow"), F.lit("allow")).when(F.max(F.col("k") == "block"), F.lit("block")).alias(decided)
    )
    # Only components that carry a block can change a verdict, so only their nodes are joined.
    blocked = parts.join(whole.where(F.col(decided) == "block"), "component").select(F.col("node").alias(key), decided)
    out = out.withColumn(key, _node(F.col(url))).join(blocked, key, "left")
    return out.withColumn(verdict, F.coalesce(said, decided, F.lit("allow"))).drop(key, said, decided)
