"""URL filters by link-graph propagation.

Rules settle the urls that they fit; the longest rule wins.  The hosts of ruled
pages seed two walks over the graph of links between hosts: trust, a personalised
PageRank from hosts in proportion to their allowed pages, and distrust, the same
on reversed edges from hosts in proportion to their blocked pages, so that who
links to the blocked is distrusted.  A host is blocked when its distrust exceeds
both its trust and ``threshold`` times the mean over all hosts; urls that no rule
fits follow their host.

Edges are distinct (page's host, linked host) pairs, weighted by their links, from
absolute and protocol-relative ``href`` and ``src`` values; links within a host
carry nothing.  Each step is a join on the host and a sum, combined map-side, and
is staged; steps end once the ranks move by less than ``tolerance`` in all.  A host
without outgoing links gives its rank back to the seeds.

Defined results: null urls and urls without ``://`` have empty host and path, fit
no rule and are allowed; null html has no links; an empty table gives no rows;
repeated rows are judged alike and each counts as a page; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

DAMPING = 0.85
THRESHOLD = 1.0
TOLERANCE = 1e-3
STEPS = 100

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)\b(?:href|src)\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``; null without one.

    ``rules``: (host, path, verdict)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``(src, dst, n)`` between different hosts; ``pages`` has ``host`` and the html."""
    linked = F.array_distinct(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1)))
    found = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
    found = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> dst")
    return found.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def walks(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, steps: int = STEPS) -> DataFrame:
    """``(walk, host, rank)`` of all walks together.

    ``edges``: ``walk, src, dst, n``; ``seeds``: ``walk, host, mass``, masses of a
    walk adding up to one.  The ranks of a walk add up to one."""
    out = edges.groupBy("walk", "src").agg(F.sum("n").alias("total"))
    edges = staged(edges.join(out, ["walk", "src"]).select("walk", "src", "dst", (F.col("n") / F.col("total")).alias("share")), "url-edges")
    seeds = staged(seeds, "url-seeds")
    ranks = staged(seeds.select("walk", "host", F.col("mass").alias("rank")), "url-ranks")
    for _ in range(steps):
        sent = ranks.join(edges.withColumnRenamed("src", "host"), ["walk", "host"]).groupBy("walk", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        lost = staged(sent.groupBy("walk").agg((1 - damping * F.sum("got")).alias("back")), "url-back")  # a row for each walk
        given = seeds.join(F.broadcast(lost), "walk", "left").select("walk", "host", (F.col("mass") * F.coalesce("back", F.lit(1.0))).alias("r"))
        new = staged(
            sent.select("walk", "host", (F.col("got") * damping).alias("r")).unionByName(given).groupBy("walk", "host").agg(F.sum("r").alias("rank")), "url-ranks"
        )
        moved = (
            new.unionByName(ranks.select("walk", "host", (-F.col("rank")).alias("rank"))).groupBy("walk", "host").agg(F.sum("rank").alias("d")).agg(F.sum(F.abs("d"))).first()[0]
        )
        ranks = new
        if moved is None or moved < tolerance:
            break
    return ranks


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``."""
    base = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    rule, says = rule_columns(rules)
    edges = staged(host_edges(base), "url-links")
    judged = base.drop("html").withColumn("rule", rule).withColumn("says", says)
    hosts = staged(
        judged.where("host <> ''").groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"), F.count_if(F.col("says") == "allow").alias("allowed"), F.count_if(F.col("says") == "block").alias("blocked")
        ),
        "url-hosts",
    )
    shares = hosts.select("host", F.explode(F.array(*(F.struct(F.lit(w).alias("walk"), (F.col(c) / F.col("pages")).alias("mass")) for w, c in (("trust", "allowed"), ("distrust", "blocked"))))).alias("s"))
    shares = shares.select("host", "s.*").where("mass > 0")
    total = shares.groupBy("walk").agg(F.sum("mass").alias("total"))
    seeds = shares.join(F.broadcast(total), "walk").select("walk", "host", (F.col("mass") / F.col("total")).alias("mass"))  # a row for each walk
    both = edges.select(F.lit("trust").alias("walk"), "src", "dst", "n").unionByName(
        edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    ranks = walks(both, seeds, damping)
    scores = ranks.groupBy("host").agg(F.sum(F.when(F.col("walk") == "trust", F.col("rank"))).alias("trust"), F.sum(F.when(F.col("walk") == "distrust", F.col("rank"))).alias("distrust"))
    scores = hosts.select("host").join(scores, "host", "full").na.fill(0.0)
    mean = scores.agg((1 / F.count(F.lit(1))).alias("mean"))
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") > threshold * F.col("mean"))
    scores = scores.crossJoin(F.broadcast(mean)).select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("follows"))  # one row
    out = judged.join(scores, "host", "left")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("says", "follows", F.lit("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
