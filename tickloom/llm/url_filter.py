"""URL filter with redirect equivalence.

Rules name a host (with all its subdomains) and a path prefix; the longest rule
that fits a url decides it.  A page that no rule fits takes the decision of its
aliases: pages joined by redirects (``<meta http-equiv="refresh">`` and an
optional redirect table) and canonical links form components; a component with
an explicitly allowed member allows, otherwise one with a blocked member blocks,
otherwise its pages are allowed.  Allow thus takes precedence over a block that
is only passed on, and a rule on the page itself over both.

Links are read attribute by attribute from link, meta and base tags outside
comments and scripts: rel is a list of words, quoted values may hold ">", the
first attribute of a name counts, "&amp;" and its numeric forms are decoded, and
a base tag moves relative links.  Only DataFrame functions are used.  The page text is read once, for the edges;
what is shuffled is the edges and the pages' short keys.

Defined cases: a null url or one without ``://`` has an empty host and path, fits
no rule and has no aliases; null html has no links; links may be absolute,
scheme-relative, root-relative or relative; fragments and the scheme do not
distinguish pages; repeated pages are judged row by row; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize
from tickloom.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
MENTIONED = r"(?i)canonical|refresh"  # pages without either word have no links
HIDDEN = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)"
TAG = r"(?is)<(?:link|meta|base)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
TAG_NAME = r"(?i)^<[a-z]+"
ATTRIBUTE = r"(?s)([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?"
REFRESH = r"(?is)\burl\s*=\s*(?:\"\s*([^\"]*?)\s*(?:\"|$)|'\s*([^']*?)\s*(?:'|$)|([^\s\"'].*?)\s*$)"
AMPERSAND = r"(?i)&(?:amp|#0*38|#x0*26);"


def first_match(col: Column, pattern: str, group: int) -> Column:
    """The group of the first match, empty without one or for null."""
    return F.coalesce(F.regexp_extract(col, pattern, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(first_match(url, PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return first_match(url, PARTS, 2)


def page_key(url: Column) -> Column:
    """What names a page: host, path and query; null where there is no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), first_match(url, PARTS, 3)))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The text host + path of the longest fitting rule, null if none fits."""
    out = F
    for rule_host, rule_path, _ in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2], r[0])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        out = out.when(fits, F.lit(rule_host + rule_path))
    return F.lit(None).cast("string") if out is F else out


def verdict_of(rule: Column, rules: list[tuple[str, str, str]]) -> Column:
    blocked = [h + p for h, p, action in rules if action == "block"]
    return F.when(rule.isNotNull(), F.when(rule.isin(blocked), "block").otherwise("allow"))


def absolute(link: Column, url: Column) -> Column:
    """A link as seen from its page or base; empty links give null."""
    link = F.trim(F.regexp_replace(link, AMPERSAND, "&"))
    origin = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (F.when(F.contains(link, F.lit("://")), link)
            .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
            .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
            .when(link != "", F.concat(origin, F.when(folder == "", "/").otherwise(folder), link)))


def attributes(tag: Column) -> tuple[Column, Column]:
    """Lower-case attribute names of a tag, and their values (empty without one)."""
    body = F.regexp_replace(tag, TAG_NAME, "")
    names, *values = (F.regexp_extract_all(body, F.lit(ATTRIBUTE), F.lit(g)) for g in (1, 2, 3, 4))
    joined = F.zip_with(values[0], F.zip_with(values[1], values[2], lambda x, y: F.concat(x, y)), lambda x, y: F.concat(x, y))
    return F.transform(names, F.lower), joined


def attribute(names: Column, values: Column, name: str) -> Column:
    """The value of the first attribute of that name, empty without one."""
    at = F.array_position(names, name)
    return F.coalesce(F.when(at > 0, F.get(values, (at - 1).cast("int"))), F.lit(""))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Distinct (a, b) page keys joined by a canonical link or a redirect."""
    shown = pages.filter(F.rlike("html", F.lit(MENTIONED))).select(
        "url", F.regexp_extract_all(F.regexp_replace("html", HIDDEN, ""), F.lit(TAG), F.lit(0)).alias("tags"))
    base = F.get(F.filter("tags", lambda t: F.rlike(t, F.lit(r"(?i)^<base\b.*\bhref"))), F.lit(0))
    tags = shown.select("url", base.alias("base"), F.explode("tags").alias("tag"))
    names, values = attributes(F.col("tag"))
    base_names, base_values = attributes(F.col("base"))
    tags = tags.select("url", F.rlike("tag", F.lit(r"(?i)^<link")).alias("is_link"), F.rlike("tag", F.lit(r"(?i)^<meta")).alias("is_meta"),
                       names.alias("names"), values.alias("values"), attribute(base_names, base_values, "href").alias("base"))

    def of(name):
        return attribute(F.col("names"), F.col("values"), name)

    canonical = F.col("is_link") & F.array_contains(F.split(F.lower(of("rel")), r"\s+"), "canonical")
    refresh = F.col("is_meta") & (F.trim(F.lower(of("http-equiv"))) == "refresh")
    said = F.concat(*(first_match(of("content"), REFRESH, g) for g in (1, 2, 3)))
    # Without quotes a space ends the content, and its url stands as an attribute.
    link = F.when(canonical, of("href")).when(refresh, F.when(said != "", said).otherwise(of("url")))
    seen_from = F.coalesce(absolute(F.col("base"), F.col("url")), F.col("url"))
    pairs = tags.select("url", absolute(link, seen_from).alias("target"))
    if redirects is not None:
        pairs = pairs.union(redirects.select("from_url", "to_url"))
    keys = pairs.select(page_key(F.col("url")).alias("a"), page_key(F.col("target")).alias("b"))
    return keys.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.  ``rules``: (host,
    path prefix, "allow" or "block"); ``redirects``: from_url, to_url."""
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    components = connected_components(alias_edges(named, redirects))
    host, path = F.regexp_extract("node", r"(?s)^([^/?]*)", 1), F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1)
    member = verdict_of(longest_rule(host, path, rules), rules)
    decided = components.groupBy("component").agg(
        F.when(F.max(member == "allow"), "allow").when(F.max(member == "block"), "block").alias("passed_on"))
    aliases = materialize(components.join(decided.filter(F.col("passed_on").isNotNull()), "component")
                          .select(F.col("node").alias("key"), "passed_on"), "aliases")
    judged = named.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                          page_key(F.col("url")).alias("key"))
    judged = judged.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    own = verdict_of(F.col("rule"), rules)
    return judged.join(aliases, "key", "left").select(
        "page_id", "host", "path", "rule", F.coalesce(own, "passed_on", F.lit("allow")).alias("verdict"))
