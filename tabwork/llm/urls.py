"""URL block and allow rules, carried over to aliases: pages that redirects and canonical links make one resource.

A rule is a host, a path and an action. It fits the host and all its subdomains where the path starts
with the rule's; of the rules that fit, the longest decides (of equally long ones an allowing one).
A URL that no rule fits takes the decision of its aliases: URLs linked by redirects or canonical
links, in any number of steps, are one component, found by repeated joins. If a member of the component is
explicitly allowed, so are the members without a rule; else, if a member is blocked, so are they; else they are
allowed. A URL's own rule always comes first, so an explicit allow is never overruled by an alias.

All of it are DataFrame operations. Rules meet URLs by equal (host, path prefix), for the host's suffixes of
as many labels as some rule has and the lengths that the paths of the rules of that suffix have, so
the number of rules does not multiply the URLs. Rules are broadcast only while their summed
bytes are small. Decisions are made once per distinct URL.

Defined results: a NULL URL, or one without "://", has an empty host and path, fits no rule and has no
alias; repeated rows each get the URL's verdict; an empty table gives no rows; other columns are ignored.
Nodes of links are URLs without their fragment, with scheme and host in lower case and / for an empty path. In html, comments, scripts and
style sheets hold no links, a tag ends at its first ">", relative addresses are resolved against the page's URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import small_side, stored
from tabwork.llm.graph import components

RULES = "host string, path string, action string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://, or NULL."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """The URL as a node of links, NULL without ://."""
    path = url_path(url)
    scheme = F.translate(F.substring_index(url, "://", 1), _UPPER, _LOWER)
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(_rest(url).isNotNull(), F.concat(scheme, F.lit("://"), url_host(url), F.when(path == "", "/").otherwise(path), query))


def resolved(url: Column, href: Column) -> Column:
    """The address that ``href`` in the page at ``url`` means, with . and .. segments worked off."""
    target = F.trim(href)
    root = F.regexp_extract(url, r"^[^:]*://[^/?#]*", 0)
    path = F.regexp_extract(target, r"^[^?#]*", 0)
    after = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    own = url_path(url)
    folder = F.concat(F.lit("/"), F.regexp_extract(own, r"^/?(.*/)?", 1))
    whole = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(folder, path))
    parts = F.split(whole, "/")
    last = F.element_at(parts, -1)
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    clean = F.concat(F.array_join(walked, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*://")), target)
        .when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.\-]*:")), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(F.substring_index(url, "://", 1), F.lit(":"), target))
        .when(path == "", F.concat(root, own, F.when(F.startswith(after, F.lit("?")), after).otherwise(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1))))
        .otherwise(F.concat(root, clean, after))
    )


def _attribute(tag: Column, name: str) -> Column:
    text = F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.replace(F.regexp_replace(text, r"^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&"))


def html_links(pages: DataFrame) -> DataFrame:
    """Rows (source, target) of URLs: canonical links and immediate or delayed refreshes of pages (url, html)."""
    due = pages.select("url", "html").where((F.locate("://", F.col("url")) > 0) & F.rlike("html", F.lit("(?i)canonical|refresh")))
    shown = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    tags = due.select("url", F.explode(F.regexp_extract_all(shown, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.array_contains(F.split(F.lower(_attribute(F.col("tag"), "rel")), r"\s+"), "canonical") & F.rlike("tag", F.lit("(?i)^<link"))
    refresh = (F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))) == "refresh") & F.rlike("tag", F.lit("(?i)^<meta"))
    later = F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)^\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"']*)", 1)
    href = F.when(canonical, _attribute(F.col("tag"), "href")).when(refresh, later)
    found = tags.select("url", href.alias("href")).where("href <> ''")
    return found.select(F.col("url").alias("source"), resolved(F.col("url"), F.col("href")).alias("target")).where("target IS NOT NULL")


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (url, rule, action) for the distinct ``urls`` (url, host, path) that a rule (host, path, action) fits."""
    spark = urls.sparkSession
    of = rules.select(F.translate("host", _UPPER, _LOWER).alias("suffix"), F.coalesce("path", F.lit("")).alias("prefix"), "action").where("suffix <> ''").distinct()
    of = stored(spark, of, "rules")
    labels = of.agg(F.max(F.size(F.split("suffix", r"\."))).alias("labels")).first()["labels"] or 0
    lengths = of.select("suffix", F.length("prefix").alias("size")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))), lambda i: F.array_join(F.slice(parts, -i, i), "."))
    placed = urls.where("host <> ''").select("url", "path", F.explode(suffixes).alias("suffix"))
    sized = placed.join(small_side(lengths, 24, F.length("suffix")), "suffix").where(F.length("path") >= F.col("size"))
    keyed = sized.select("url", "suffix", F.expr("left(path, size)").alias("prefix"))
    fits = keyed.join(small_side(of, 24, F.length("suffix") + F.length("prefix") + F.length("action")), ["suffix", "prefix"])
    rule = F.concat("suffix", "prefix")
    best = F.max(F.struct(F.length(rule).alias("size"), (F.col("action") == "allow").alias("allows"), rule.alias("rule"), "action"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.action")


def verdicts(pages: DataFrame, rules: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (page_id, url, host, path, rule, verdict) of pages (page_id, url): the rule that decides, or NULL, and allow or block.

    ``links`` are rows (source, target) of URLs, from redirects seen by a crawler or from ``html_links``.
    """
    spark = pages.sparkSession
    links = stored(spark, links.select("source", "target").distinct(), "aliases")
    urls = pages.select("url").union(links.select("source")).union(links.select("target")).where("url IS NOT NULL").distinct()
    known = urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = stored(spark, fitting_rules(known, rules), "ruled")

    edges = links.select(url_node(F.col("source")).alias("a"), url_node(F.col("target")).alias("b")).where("a <> b").distinct()
    parts = components(edges)
    named = urls.select("url", url_node(F.col("url")).alias("node")).join(parts, "node")
    decided = named.join(ruled, "url").groupBy("component").agg(F.bool_or(F.col("action") == "allow").alias("allowed"))
    passed = named.join(decided, "component").select("url", F.when(F.col("allowed"), "allow").otherwise("block").alias("passed"))

    said = stored(spark, ruled.join(passed, "url", "full").select("url", "rule", F.coalesce("action", "passed").alias("said")), "verdicts")
    rows = pages.select("page_id", "url")
    sizes = F.length("url") + F.coalesce(F.length("rule"), F.lit(0))
    return rows.join(small_side(said, 32, sizes), "url", "left").select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "rule", F.coalesce("said", F.lit("allow")).alias("verdict"))
