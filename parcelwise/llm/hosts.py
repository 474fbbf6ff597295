"""URL filters: rules by host and path, and trust and distrust propagated over the host graph.

A rule fits its host and all subdomains when the path begins with its path; the longest wins. Urls
without a rule are judged by their host. Hosts are linked by the links of their pages and by the
step between a host and its parent domain, in both directions. Three personalised PageRanks run
over these edges: trust starts where rules allow pages, distrust starts where rules block pages and
runs against the links, and a base starts at all pages. A host is blocked when distrust less trust
is above `threshold` of its base, that is, when the pages around it are mostly blocked ones.

All of it is DataFrame code: ranks are sums per host, combined before the shuffle, for a fixed number
of rounds; every few rounds the ranks are written to the shared folder. Sources send equal shares, so
a hub's links are an ordinary skewed join side and there are no cross joins.

Defined cases: a null url or one without `://` has an empty host and path, fits no rule and is
allowed, as is every host without pages under rules around it; a null html has no links; repeated
rows count as often as they come; links to the own host and relative links are no edges; an empty
table gives no rows. Extra columns are kept, those named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.scale import written

ROUNDS, DAMPING, THRESHOLD = 8, 0.5, 0.5
WRITE_EVERY = 4

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
"""(verdict, host, path)."""


def host_of(url: Column) -> Column:
    authority = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(
        F.coalesce(authority, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(verdict, rule) of the longest fitting rule, null without one."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))).otherwise(out)
    return out


def host_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, and steps between a host and its parent domain."""
    href = F.regexp_extract_all(F.col(html), F.lit(r"(?i)href\s*=\s*[\"']?([a-z][a-z0-9+.-]*://[^\"'\s>]*)"), F.lit(1))
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(href)).alias("href"))
    links = links.select("src", host_of(F.col("href")).alias("dst"))
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    # A host of three labels has a domain of two as its parent; that is as far up as steps go.
    up = pages.select("host").distinct().select(F.col("host").alias("src"), parent.alias("dst"))
    both = up.union(up.select("dst", "src"))
    edges = links.union(both).where("src <> '' and dst <> '' and src <> dst")
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, names: list[str], rounds: int = ROUNDS) -> DataFrame:
    """(host, *names): PageRank of each seed column along `edges` (src, dst, share)."""
    zero = {n: F.lit(0.0) for n in names}
    ranks = seeds
    for step in range(1, rounds + 1):
        sent = edges.join(ranks.withColumnRenamed("host", "src"), "src")
        came = sent.select(
            F.col("dst").alias("host"), *((F.lit(DAMPING) * F.col("share") * F.col(n)).alias(n) for n in names)
        )
        start = seeds.select("host", *((F.lit(1 - DAMPING) * F.col(n)).alias(n) for n in names))
        ranks = came.union(start).groupBy("host").agg(*(F.sum(n).alias(n) for n in names))
        if step % WRITE_EVERY == 0 and step < rounds:
            ranks = written(ranks, "host-ranks")
    return ranks.na.fill(dict.fromkeys(zero, 0.0))


def _shares(edges: DataFrame) -> DataFrame:
    out = edges.groupBy("src").agg(F.sum("n").alias("__all"))
    return edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("__all")).alias("share"))


def judge(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", threshold: float = THRESHOLD) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict`."""
    split = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ruled = split.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.col("__rule.verdict")
    count = lambda wanted: F.count_if(wanted).cast("double")
    seeds = (
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            count(verdict == "allow").alias("trust"),
            count(verdict == "block").alias("distrust"),
            F.count(F.lit(1)).cast("double").alias("base"),
        )
    )
    seeds = written(seeds, "host-seeds")
    edges = written(host_links(split, html), "host-links")
    forward = written(_shares(edges), "host-shares")
    backward = written(_shares(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")), "host-shares")
    trusted = propagate(forward, seeds.select("host", "trust", "base"), ["trust", "base"])
    distrusted = propagate(backward, seeds.select("host", "distrust"), ["distrust"])
    # A threshold decides, so sums of different order are rounded alike.
    excess = F.round(F.col("distrust") - F.col("trust") - threshold * F.col("base"), 6)
    blocked = (
        trusted.join(distrusted, "host").where(excess > 0).select("host", F.lit(True).alias("__blocked"))
    )
    by_host = F.when(F.col("__blocked"), "block").otherwise("allow")
    judged = ruled.join(written(blocked, "blocked-hosts"), "host", "left")
    return judged.withColumns({"rule": F.col("__rule.rule"), "verdict": F.coalesce(verdict, by_host)}).drop(
        "__rule", "__blocked"
    )
