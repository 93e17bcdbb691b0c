"""URL filter: host and path rules, and blocks carried over redirects and canonical links.

The longest rule that fits a url decides. A url that no rule fits is blocked if it is an alias of a
blocked one: redirects and canonical links are undirected edges, their connected components are the
aliases, and a component with a url that a rule blocks blocks all of its urls but those that a rule
allows. Only DataFrame functions are used.

Edges join urls without scheme and fragment. A relative link is read from its page's url; one without a
host otherwise is left out.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, has no
aliases and is allowed; repeated urls are judged alike; of equally long rules an allowing one wins; null
html has no links; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.components import connected_components
from tabwright.llm.tokens import free_name

Rule = tuple[str, str]  # (allow or block, host and path such as "net/es/")

CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The url without scheme and fragment, null without a host; "/" stands for an empty path."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.when(host_of(url) != "", F.concat(host_of(url), path, query))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, action) of the longest rule that fits, or null. The rules are one literal map by host."""
    by_host: dict[str, list[Rule]] = {}
    for action, rule in rules:
        by_host.setdefault(rule.partition("/")[0], []).append((action, rule))
    if not by_host:
        return F.lit(None).cast("struct<rule: string, action: string>")
    found = F.create_map(*[x for name, own in by_host.items() for x in (F.lit(name), F.array(*[F.struct(
        F.lit(len(rule)).alias("size"), F.lit(action == "allow").alias("allowed"), F.lit(rule).alias("rule"),
        F.lit(action).alias("action"), F.lit(rule[len(name):]).alias("path")) for action, rule in own]))])
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    own = F.flatten(F.filter(F.transform(domains, lambda d: F.try_element_at(found, d)), lambda x: x.isNotNull()))
    best = F.array_max(F.filter(own, lambda r: path.startswith(r["path"])))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["action"].alias("action")))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): each page's url node and that of its canonical link or of the page it refreshes to."""
    own, markup = F.col(f"`{url}`"), F.col(f"`{html}`")
    linked = pages.where(markup.rlike("(?i)canonical|refresh")) \
        .select(own.alias("url"), F.explode(F.concat(*[
            F.regexp_extract_all(markup, F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)])).alias("link"))
    link, host = F.replace(F.col("link"), F.lit("&amp;"), F.lit("&")), host_of(F.col("url"))
    folder = F.regexp_extract(path_of(F.col("url")), "^.*/", 0)
    absolute = F.when(link.rlike("(?i)^https?://"), link).when(link.startswith("//"), F.concat(F.lit("x:"), link)) \
        .when(link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None)) \
        .when(link.startswith("/"), F.concat(F.lit("x://"), host, link)) \
        .otherwise(F.concat(F.lit("x://"), host, F.when(folder == "", "/").otherwise(folder), link))
    return linked.where(host != "").select(node_of(F.col("url")).alias("a"), node_of(absolute).alias("b"))


def judge_urls(pages: DataFrame, edges: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict as last four columns (or the next free names)."""
    def action(node: Column) -> Column:
        at = F.concat(F.lit("x://"), node)
        return rule_for(host_of(at), path_of(at), rules)["action"]
    aliases = connected_components(edges)
    blocked = aliases.where(action(F.col("node")) == "block").select("component").distinct()
    carried = aliases.join(blocked, "component", "left_semi").select("node")

    own = F.col(f"`{url}`")
    names = {name: free_name(pages, name) for name in ("host", "path", "rule", "verdict")}
    judged = pages.select("*", F.struct(
        F.coalesce(host_of(own), F.lit("")).alias("host"), F.coalesce(path_of(own), F.lit("")).alias("path"),
        node_of(own).alias("node")).alias("u__"))
    judged = judged.withColumn("r__", rule_for(F.col("u__.host"), F.col("u__.path"), rules))
    judged = judged.join(carried.withColumnRenamed("node", "n__"), F.col("u__.node") == F.col("n__"), "left")
    return judged.select(
        *[F.col(f"`{c}`") for c in pages.columns], F.col("u__.host").alias(names["host"]), F.col("u__.path").alias(names["path"]),
        F.col("r__.rule").alias(names["rule"]),
        F.coalesce("r__.action", F.when(F.col("n__").isNotNull(), "block").otherwise("allow")).alias(names["verdict"]))
