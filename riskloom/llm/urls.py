"""Operator 4: URL rules, and link-graph verdicts where no rule fits.

Rules are (host, path, verdict) and fit the host with its subdomains where the URL's path
starts with the rule's; the longest ``host + path`` wins (equal lengths: the rule that
blocks). Hosts of pages that a rule allows are trusted seeds, hosts of pages that a rule
blocks are distrusted seeds, each weighted by such pages. Personalised PageRank carries
trust along host edges and distrust against them. An edge is a hyperlink between hosts
(a relative one stays at home) or the tie between a host and the domain above it. A host
is blocked if its distrust exceeds both its trust and an equal share for each host with pages.

A null URL or one without ``://`` has an empty host and path: no rule fits and the method
allows it. Null or empty html has no links. Repeated pages count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def best_rule(rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and ``path``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block")):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links from host to host, and one tie each way between a host and the
    domain one label above it, down to two labels."""
    def target(link: Column) -> Column:
        return (F.when(link.contains("://"), host_of(link))
                .when(link.startswith("//"), host_of(F.concat(F.lit("x:"), link)))
                .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit("")).otherwise(F.col("host")))

    links = pages.where("host <> ''").select(
        F.col("host").alias("a"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
        .alias("link"), "host").select("a", target(F.col("link")).alias("b")).where("b <> ''")
    links = links.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    hosts = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    levels = hosts.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(labels) - 3)),
        lambda i: F.struct(F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("low"),
                           F.array_join(F.slice(labels, i + 2, F.size(labels)), ".").alias("high")))).alias("x")
    ).select("x.*").where("low <> high and high like '%.%'").distinct()
    ties = levels.select(F.col("low").alias("a"), F.col("high").alias("b")).union(
        levels.select(F.col("high").alias("a"), F.col("low").alias("b"))).withColumn("n", F.lit(1.0))
    return links.unionByName(ties).groupBy("a", "b").agg(F.sum("n").alias("n"))


def host_trust(pages: DataFrame, rounds: int = 12, damping: float = 0.85) -> DataFrame:
    """(host, trust, distrust) from ``pages(host, html, fit)``; each sums to at most 1."""
    edges = stored(host_edges(pages), "host-edges")
    seeds = pages.where("host <> '' and fit is not null").groupBy(
        F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host").agg(
        F.count(F.lit(1)).cast("double").alias("n"))
    seeds = stored(seeds, "host-seeds")
    totals = {r["kind"]: r["n"] for r in seeds.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    start = seeds.select("kind", "host", (F.col("n") / F.when(F.col("kind") == "trust", totals.get("trust", 1.0))
                                          .otherwise(totals.get("distrust", 1.0))).alias("mass"))
    ahead = edges.select(F.lit("trust").alias("kind"), F.col("a").alias("host"), F.col("b").alias("to"), "n")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("b").alias("host"), F.col("a").alias("to"), "n")
    steps = ahead.unionByName(back)
    out = steps.groupBy("kind", "host").agg(F.sum("n").alias("out"))
    steps = stored(steps.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("out")).alias("p")),
                   "host-steps")
    state = start
    for r in range(rounds):
        moved = steps.join(state, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(
            (damping * F.sum(F.col("p") * F.col("mass"))).alias("mass"))
        state = moved.unionByName(start.withColumn("mass", (1 - damping) * F.col("mass"))).groupBy(
            "kind", "host").agg(F.sum("mass").alias("mass"))
        if r % 3 == 2 or r == rounds - 1:
            state = stored(state, "host-mass")
    return state.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0.0)).alias("distrust"))


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]], rounds: int = 12,
                 damping: float = 0.85) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    parsed = parsed.withColumn("fit", best_rule(rules))
    graph = host_trust(parsed, rounds, damping)
    n_hosts = max(1, parsed.where("host <> ''").select("host").distinct().count())
    judged = graph.withColumn("blocked", (F.col("distrust") > F.col("trust")) & (F.col("distrust") > 1 / n_hosts))
    return parsed.select("page_id", "host", "path", "fit").join(judged, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
