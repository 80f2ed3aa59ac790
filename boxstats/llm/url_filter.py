"""Operator 9: URL rules, with block decisions propagated over redirects and canonical links.

Only DataFrame expressions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstats.llm.common import saved, small
from boxstats.llm.components import connected_components

# (verdict, host, path prefix); a rule fits its host and all subdomains.
DEFAULT_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = (r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*"
           r"[\"'][^\"'>]*\burl\s*=\s*([^\"'\s>]+)")
ENTITIES = "/:=?#%+'\"@;,~.-_<>&"
NAMES = {"&": ["amp", "AMP"], "'": ["apos"], '"': ["quot"], "<": ["lt"], ">": ["gt"]}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #``, A-Z lower-cased; '' without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?`` or ``#``; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments, as RFC 3986 removes them."""
    segments = F.split(path, "/")
    last = F.size(segments) - 1

    def add(done: Column, at: Column) -> Column:
        s = F.get(segments, at)
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))
        left = F.when(s == "..", up).when(s == ".", done).otherwise(F.array_append(done, s))
        return F.when(s.isin(".", "..") & (at == last), F.array_append(left, F.lit(""))) \
            .otherwise(left)

    kept = F.aggregate(F.sequence(F.lit(1), last), F.array(F.get(segments, 0)), add)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.array_join(kept, "/")).otherwise(path)


def url_key(url: Column) -> Column:
    """What a URL stands for in the link graph: no scheme and no fragment, host lower-cased, dot
    segments removed; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*[^?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(url_host(url), without_dots(url_path(url)), query))


def decoded(link: Column) -> Column:
    """Character references of what is special in a URL, by name or number; ``&`` itself last, so
    nothing is decoded twice."""
    for char in ENTITIES:
        names = [f"#0*{ord(char)}", f"#[xX]0*(?:{ord(char):x}|{ord(char):X})", *NAMES.get(char, [])]
        link = F.regexp_replace(link, f"&(?:{'|'.join(names)});",
                                char)
    return link


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` found on the page ``base``; null for an empty link."""
    scheme = F.regexp_extract(base, r"(?s)\A(.*?):", 1)
    root = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)", 1)
    return (F.when(F.coalesce(link, F.lit("")) == "", None)
            .when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .otherwise(F.concat(F.when(folder.endswith("/"), folder)
                                .otherwise(F.concat(folder, F.lit("/"))), link)))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]):
    """(rule, its verdict): of the rules that fit, the longest (host and path together); equal
    lengths go to the longer host, then to allow. Null where none fits."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "allow"))

    def pick(value):
        def fits(rule):
            return (((host == rule[1]) | host.endswith("." + rule[1]))
                    & path.startswith(rule[2]))
        return reduce(lambda chain, r: chain.when(fits(r), F.lit(value(r))), order,
                      F.when(F.lit(False), F.lit(None).cast("string")))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(u, v): keys of each page and of the target of its canonical link and its refresh."""
    links = pages.select(F.col(url_col).cast("string").alias("url"), F.explode(F.array(
        *[F.regexp_extract(F.col(html_col).cast("string"), p, 1) for p in (CANONICAL, REFRESH)]))
        .alias("link")).where("url IS NOT NULL AND link <> ''")
    target = resolve(F.col("url"), decoded(F.col("link")))
    return (links.select(url_key(F.col("url")).alias("u"), url_key(target).alias("v"))
            .where("u IS NOT NULL AND v IS NOT NULL AND u <> v"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html",
               rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES,
               redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, propagated: one row per input row.

    The verdict is that of the page's own rule. A page without one is blocked if some alias of it
    (reached over ``redirects`` (src, dst URLs), canonical links or refreshes, in any number of
    steps) is blocked by a rule and none is explicitly allowed; else it is allowed. ``propagated``
    marks decisions taken over from aliases. A null URL, or one without ``://``, has empty host and
    path, no rule and no aliases, and is allowed. Only URLs on links enter the component search;
    repeated rows are judged each. ``rules`` is a short list on the driver.
    """
    base = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parts = base.select("page_id", host.alias("host"), path.alias("path"),
                        url_key(F.col("url")).alias("key"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = parts.select("page_id", "host", "path", "key", rule.alias("rule"),
                          verdict.alias("own"))

    links = None if html_col is None else page_links(pages, url_col, html_col)
    if redirects is not None:
        given = redirects.select(url_key(F.col("src").cast("string")).alias("u"),
                                 url_key(F.col("dst").cast("string")).alias("v"))
        links = given if links is None else links.unionByName(given)
    if links is not None:
        links = saved(links, "links")
    if links is None or links.isEmpty():
        return judged.select("page_id", "host", "path", "rule", F.coalesce(
            "own", F.lit("allow")).alias("verdict"), F.lit(False).alias("propagated"))

    members = saved(connected_components(links), "aliases")
    # Every member of a component, page or mere link target, is judged by the rules.
    address = F.concat(F.lit("x://"), F.col("node"))
    _, member_verdict = rule_columns(url_host(address), url_path(address), rules)
    decided = members.groupBy("component").agg(
        F.max((member_verdict == "block").cast("int")).alias("blocked"),
        F.max((member_verdict == "allow").cast("int")).alias("allowed"))
    blocked = decided.where("blocked = 1 AND coalesce(allowed, 0) = 0").select("component")
    aliases = saved(members.join(blocked, "component").select(
        F.col("node").alias("key"), F.lit(True).alias("hit")), "blocked")
    # Pages without a key have no aliases; they would all meet in one task of a shuffle join.
    out = judged.where("key IS NOT NULL").join(small(aliases), "key", "left").unionByName(
        judged.where("key IS NULL").withColumn("hit", F.lit(None).cast("boolean")))
    taken = F.col("own").isNull() & F.col("hit").isNotNull()
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "own", F.when(taken, "block").otherwise("allow")).alias("verdict"),
        taken.alias("propagated"))
