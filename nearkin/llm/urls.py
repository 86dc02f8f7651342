"""Block and allow rules for URLs, with decisions that pass along redirects and canonical links.

A rule fits its host and all subdomains where the path starts with the rule's path; the longest rule wins, and of equally
long ones an allowing rule. URLs that redirect to one another or name one canonical URL are aliases: a URL without a rule
of its own is blocked if an alias is blocked by rule and none is allowed by rule.

A null URL or one without `://` has an empty host and path, fits no rule and has no aliases. Pages that repeat are judged
alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearkin.llm.components import connected_components
from nearkin.plans.scale import fits_broadcast, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL without its fragment, which never reaches a server."""
    return F.substring_index(url, "#", 1)


def resolved(link: Column, base: Column) -> Column:
    """A link as an absolute URL; null for an empty one."""
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^?#]*/)", 1)
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(link == "", None).when(link.contains("://"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(F.when(folder.endswith("://") | (folder == ""), F.concat(root, F.lit("/"))).otherwise(folder), link))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """source, target: the canonical link and the redirect in the head of each page that has one."""
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    canonical = F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1)
    redirect = F.regexp_extract(F.regexp_extract(html, REFRESH, 0), REFRESH_URL, 1)
    found = pages.where(url.contains("://")).select(
        node_of(url).alias("source"),
        F.explode(F.array(resolved(canonical, url), resolved(redirect, url))).alias("target"))
    return found.select("source", node_of(F.col("target")).alias("target")).where(F.col("target").isNotNull())


def longest_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """places with `rule` and `action` of the longest fitting rule, or nulls. places: host, path; rules: host, path, action.

    Each host is looked up by itself and its parent domains, so the work does not grow with the number of rules.
    """
    rules = written(rules.select(
        F.col("host").alias("domain"), F.col("path").alias("start"), "action",
        F.concat("host", "path").alias("rule")).dropna().distinct())
    known = places.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    domain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = known.where(F.col("host") != "").select("host", "path", F.explode(domain).alias("domain"))
    small = fits_broadcast(rules, F.length("rule") * 8 + 64)
    fitting = asked.join(F.broadcast(rules) if small else rules, "domain").where(F.expr("startswith(path, start)"))
    best = fitting.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("n"), (F.col("action") == "allow").alias("allows"), "rule", "action")).alias("best"))
    return places.join(best.select("host", "path", "best.rule", "best.action"), ["host", "path"], "left")


def judge(pages: DataFrame, rules: DataFrame, links: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of each page. links: source, target URLs without fragments."""
    judged = pages.select(id_col, F.col(url_col).alias("url")).select(
        id_col, node_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = longest_rules(judged, rules)
    groups = written(connected_components(written(links), "source", "target"))
    members = groups.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    passed_on = longest_rules(members, rules).groupBy("component").agg(
        F.when(F.max((F.col("action") == "allow").cast("int")) == 1, "allow")
        .when(F.max((F.col("action") == "block").cast("int")) == 1, "block").alias("group_action"))
    by_node = groups.join(passed_on, "component").select("node", "group_action")
    return judged.join(by_node, "node", "left").select(
        id_col, "host", "path", "rule", F.coalesce("action", "group_action", F.lit("allow")).alias("verdict"))
