"""URL filter: rules first, then trust and distrust that spread over links between hosts.

Every URL is judged by the longest rule that fits its host (or a domain above it) and path.
URLs without a rule get the verdict of their host. Trust is a personalised PageRank over host
links from hosts with allowed pages; distrust is one over the reversed links from hosts with
blocked pages, since who links to bad hosts is suspect, not who is linked from them.

A score by itself says little: what a bad host passes back is shared by all that link to it. So each
host has a threshold of its own, a part of what it would get if all ruled hosts were of one kind: the
same walk is also seeded with the pages of ruled hosts that are allowed (or blocked) and with
those no rule fits, and trust and distrust are the shares of a host's whole score. A host that links to
nothing but a blocked one has distrust 1, however many others do so too. It is blocked if its
distrust exceeds its trust by MARGIN. Hosts that no seed reaches have neither and are allowed.

The iteration goes on until no host's score changes by more than TOLERANCE of itself; every step
shrinks what is still to come by the damping, so it ends.

Only DataFrame functions are used. Links are counted per host pair before any join, a step of
the iteration joins scores with the link table and sums by target, and each step is written to
the shared folder, which cuts the lineage.

Defined results: a null URL or one without "://" has an empty host and path, fits no rule and
is allowed; null html has no links; links to hosts that have no page count, links of a host
to itself and relative ones do not; repeated pages count like pages of their own; an empty
table gives an empty result; other columns are ignored. Very long html is searched whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize

# The rules: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING = 0.85
TOLERANCE = 1e-4
MARGIN = 0.5
DIGITS = 3
SEEDS = ("allow", "block", "neither")
LINK = "(?i)href\\s*=\\s*[\"']?\\s*((?:https?:)?//[^\"'>\\s]+)"


def host_of(url: Column) -> Column:
    """From behind the first :// to the next slash, question mark, hash or the end, A-Z in lower case."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), "^([^/?#]*)", 1)
    return F.when(at > 0, F.translate(host, string.ascii_uppercase, string.ascii_lowercase)).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, a hash or the end."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), "^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path together, null if none does) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        rule = F.when(fits, F.lit(domain + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, by_rule, html) of every page."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, verdict = rule_for(F.col("host"), F.col("path"))
    return split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"), "html")


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target) of links between different hosts, each pair once."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), _link_host))
    found = pages.where("host <> ''").select(F.col("host").alias("source"), F.explode(targets).alias("target"))
    return found.where("target <> '' AND target <> source").distinct()


def _link_host(link: Column) -> Column:
    host = F.regexp_extract(link, "//([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def seeds(pages: DataFrame) -> DataFrame:
    """(kind, host, allow, block, neither): for both walks, the shares of a host's pages that the rules
    allow, block or say nothing of, for hosts with a ruled page."""
    share = lambda verdict: F.count_if(F.coalesce(F.col("by_rule"), F.lit("neither")) == verdict) / F.count("*")
    shares = pages.where("host <> ''").groupBy("host").agg(*[share(v).alias(v) for v in SEEDS]).where("neither < 1")
    return shares.select(F.explode(F.array(F.lit("trust"), F.lit("distrust"))).alias("kind"), "host", *SEEDS)


def spread(start: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, allow, block, neither): both PageRanks at once, trust along the links and distrust
    against them, by the kind of seed that a score comes from."""
    ways = links.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to")).unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"))
    )
    degree = ways.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    ways = materialize(ways.join(degree, ["kind", "host"]), "ways")
    base = materialize(start.select("kind", "host", *[(F.col(c) * (1 - damping)).alias(c) for c in SEEDS], F.lit(0.0).alias("before")), "scores")
    whole = sum(F.col(c) for c in SEEDS)
    scores = base
    while True:
        part = [(F.col(c) * damping / F.col("degree")).alias(c) for c in SEEDS]
        passed = scores.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), *part, F.lit(0.0).alias("before"))
        # What a host had before, so that one pass tells how far scores still move.
        known = scores.select("kind", "host", *[F.lit(0.0).alias(c) for c in SEEDS], whole.alias("before"))
        sums = [F.sum(c).alias(c) for c in (*SEEDS, "before")]
        scores = materialize(base.unionByName(passed).unionByName(known).groupBy("kind", "host").agg(*sums), "scores")
        if scores.where(F.abs(whole - F.col("before")) > tolerance * whole).isEmpty():
            return scores.drop("before")


def verdicts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and its host's trust and distrust."""
    marked = judged(pages)
    scores = spread(seeds(marked), host_links(marked))
    whole = sum(F.col(c) for c in SEEDS)
    hosts = scores.groupBy("host").agg(
        F.max(F.when(F.col("kind") == "trust", F.col("allow") / whole)).alias("trust"),
        F.max(F.when(F.col("kind") == "distrust", F.col("block") / whole)).alias("distrust"),
    )
    known = marked.drop("html").join(hosts, "host", "left").withColumns(
        {c: F.round(F.coalesce(c, F.lit(0.0)), DIGITS) for c in ("trust", "distrust")}
    )
    by_host = F.when(F.col("distrust") - F.col("trust") >= MARGIN, "block").otherwise("allow")
    return known.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), "trust", "distrust")
