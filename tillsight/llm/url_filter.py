"""URL filter: host and path rules, and link-graph propagation for the urls that no rule fits.

Trust flows from hosts under an allow rule along links (personalised PageRank with the trusted hosts as
seeds); distrust flows from hosts under a block rule against the links (the same walk on reversed edges):
who links to blocked hosts becomes suspect. Edges are distinct host pairs with their counts, aggregated
before any join, so a host that a third of all pages link to is a third of the hosts' edges at most and
sends one number. Both walks run until they have converged. A host is blocked if its distrust exceeds ``MARGIN``
times its trust; ranks up to ``FLOOR``, far beyond a hundred links from any seed, count as none.

Edge cases: a null url or one without ``://`` has an empty host and path and the verdict allow; null or empty
html has no links; repeated page ids are judged row by row; links to the same host do not count; unknown
hosts and an empty graph give allow; extra columns are ignored. A page of any length is read in one pass: a tag's scan ends
at the next angle bracket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Fixed values: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

DAMPING, MARGIN = 0.85, 1.0
#: Mass that a round may still move when a walk ends; rank up to which a host counts as not reached; rounds a written table.
TOLERANCE, FLOOR, STRIDE = 1e-12, 1e-10, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as ``host/path``, else null; a rule fits its host, subdomains, and paths it begins."""
    out = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(h + p)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for h, p, v in rules:
        out = F.when(rule == h + p, F.lit(v)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts, counted."""
    found = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)<(?:a|link|iframe)\s[^<>]*?(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1))).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    return (found.select("src", host_of(full).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, name: str) -> DataFrame:
    """``host, rank``: converged personalised PageRank over ``src, dst, n`` from ``host, weight`` (summing to 1); mass of
    hosts without links goes back to the seeds. What goes back only scales the ranks, so the walk is summed link by
    link from the seeds, until a round moves at most ``TOLERANCE``, and divided by its sum. A round moves at most ``DAMPING`` of the
    mass of the one before, so 171 rounds end any walk, however long its chains."""
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    steps = written(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), f"{name}-steps")
    now = written(seeds.select("host", F.col("weight").alias("rank"), F.col("weight").alias("fresh")), f"{name}-seeds")
    while True:
        total, fresh = now.agg(F.sum("rank"), F.sum("fresh")).first()
        if (fresh or 0.0) <= TOLERANCE or steps.isEmpty():
            return now.select("host", (F.col("rank") / F.lit(total or 1.0)).alias("rank"))
        for _ in range(STRIDE):
            moved = steps.join(now.where("fresh > 0"), F.col("src") == F.col("host")).groupBy(F.col("dst").alias("host")).agg(
                (DAMPING * F.sum(F.col("fresh") * F.col("share"))).alias("m"))
            both = now.select("host", "rank", F.lit(0.0).alias("fresh")).union(moved.select("host", "m", "m"))
            now = both.groupBy("host").agg(F.sum("rank").alias("rank"), F.sum("fresh").alias("fresh"))
        now = written(now, f"{name}-walk")


def judge(pages: DataFrame, rules=RULES, margin: float = MARGIN) -> DataFrame:
    """``page_id, host, path, rule, verdict`` with the host's ``trust`` and ``distrust``."""
    url = F.col("url")
    each = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    each = each.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("ruled", rule_verdict(F.col("rule"), rules))
    edges = written(host_edges(pages), "host-edges")
    ruled = each.where("ruled IS NOT NULL AND host <> ''").groupBy("host", "ruled").agg(F.count("*").alias("n"))
    ruled = written(ruled, "ruled-hosts")
    total = {r["ruled"]: r["n"] for r in ruled.groupBy("ruled").agg(F.sum("n").alias("n")).collect()}  # two rows at most

    def seeds(verdict):
        return ruled.where(F.col("ruled") == verdict).select("host", (F.col("n") / F.lit(total.get(verdict, 1))).alias("weight"))

    trust = propagate(edges, seeds("allow"), "trust")
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(against, seeds("block"), "distrust")
    scores = trust.select("host", F.col("rank").alias("trust")).join(distrust.select("host", F.col("rank").alias("distrust")), "host", "full")
    scores = written(scores.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
                     .withColumn("blocked", F.col("distrust") > F.greatest(margin * F.col("trust"), F.lit(FLOOR))), "host-scores")
    found = F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return each.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", found).alias("verdict"), "trust", "distrust")
