"""URL filters with link-graph propagation (DataFrame and SQL functions only).

Rules judge first: a rule (verdict, host, path) fits its host and all
subdomains where the url's path starts with the rule's; the longest host plus
path wins, of equal ones the first listed. Urls without a rule are judged by
their host's standing in the host graph.

Host edges are the absolute links in the pages' html, weighted by how many
there are, and the domain hierarchy: a host and the domain above it vouch for
each other (up to the last name with a dot). Seeds are hosts with pages that
a rule allows (trusted) or blocks (distrusted), weighted by the number of
such pages. Trust is personalised PageRank along the edges, distrust along the
reversed edges: whoever links to a blocked host is tainted. A host is blocked
when its distrust exceeds its trust by the factor ``threshold``; hosts that
neither reaches are allowed.

Rounds go on until every host's rank has settled (``rounds=None``; a number
stops there). The change is measured relative to each host's own rank and over
the rounds since the last look, so a host far from every seed, whose rank is
small or not there yet, counts like any other, and ranks that swing between
even and odd rounds don't pass for settled. Each round is one join and one
aggregation over distinct hosts and edges, in a task for every ``PIECE`` edges;
ranks go through the shared folder every few rounds, and those before them go. The rule list is part of the query's code and short.

Null urls, and those without ``://``, have empty host and path, no rule and
are allowed. Null html has no links. Rows are judged one by one, so repeated
rows, null page ids, extra columns and empty tables need no care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelkit.llm._tables import stored
from panelkit.stages import releasing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed values of the contract: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Edges that a task of a round may hold.
PIECE = 250_000
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, html_col: str = "html", hierarchy_weight: float = 1.0) -> DataFrame:
    """``src``, ``dst`` and ``weight`` of distinct host edges; ``pages`` has column ``host``."""
    links = (pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(
        F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("to"))
        .select("src", F.translate("to", UPPER, LOWER).alias("dst"), F.lit(1.0).alias("weight")))
    hosts = pages.select("host").distinct()
    # every name above a host that still has a dot, each joined to the one below it
    names = hosts.select(F.split("host", r"\.").alias("n"))
    steps = names.select("n", F.explode(F.when(F.size("n") >= 3, F.sequence(F.lit(1), F.size("n") - 2))).alias("i"))
    up = steps.select(F.array_join(F.slice("n", F.col("i"), F.size("n")), ".").alias("src"),
                      F.array_join(F.slice("n", F.col("i") + 1, F.size("n")), ".").alias("dst")).distinct()
    vouch = F.lit(hierarchy_weight).alias("weight")
    tree = up.select("src", "dst", vouch).unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"), vouch))
    return links.unionByName(tree).where("src <> dst AND dst <> ''").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = 0.85, store_every: int = 3,
              tolerance: float = 1e-9) -> DataFrame:
    """``kind``, ``host`` and ``rank``: trust along the edges and distrust
    against them, from ``seeds`` (kind, host, mass). What reaches a host
    without outgoing edges stays there for that round. Without ``rounds``, on
    until no host's rank changes by more than its share ``tolerance`` any more."""
    with releasing(edges.sparkSession) as step:
        both = (edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), "dst", "weight")
                .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("dst"), "weight")))
        out = both.groupBy("kind", "host").agg(F.sum("weight").alias("total"))
        both = stored(both.join(out, ["kind", "host"]).select("kind", "host", "dst", (F.col("weight") / F.col("total")).alias("share")), "trust-edges")
        pieces = 1 + both.count() // PIECE  # a small graph in a few tasks a round, whatever the session's shuffles have
        both = stored(both.coalesce(pieces), "trust-edges")
        home = stored(seeds.select("kind", "host", F.col("mass").cast("double").alias("rank")).coalesce(pieces), "trust-home")
        ranks, none, done = home, F.lit(0.0).alias("before"), 0
        while rounds is None or done < rounds:
            block = store_every if rounds is None else min(store_every, rounds - done)
            start = ranks.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("before"))
            for r in range(block):
                moved = (both.join(ranks, ["kind", "host"])
                         .select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"), none))
                parts = moved.unionByName(home.select("kind", "host", (F.col("rank") * (1 - damping)).alias("rank"), none))
                if r == block - 1:
                    parts = parts.unionByName(start)
                ranks = parts.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before")).coalesce(pieces)
            seen = Observation()
            unsettled = F.count_if(F.abs(F.col("rank") - F.col("before")) > F.col("rank") * tolerance).alias("unsettled")
            ranks = stored(ranks.observe(seen, unsettled), "trust-ranks")
            step.release(both, home, ranks)  # the ranks before these have no reader any more
            done += block
            if rounds is None and not seen.get["unsettled"]:
                break
        return step.keep(ranks.select("kind", "host", "rank"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES,
          rounds: int | None = None, damping: float = 0.85, threshold: float = 1.0) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every row."""
    host, path = host_and_path(F.col(url_col))
    seen = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    seen = seen.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    slim = stored(seen.drop("html"), "trust-pages")
    kind = F.when(F.col("found.verdict") == "allow", "trust").otherwise("distrust").alias("kind")
    seeds = stored(slim.where("found IS NOT NULL").groupBy(kind, "host").agg(F.count("*").alias("mass")), "trust-seeds")
    ranks = propagate(host_edges(seen), seeds, rounds, damping)

    def rank_of(which):
        return F.sum(F.when(F.col("kind") == which, F.col("rank")).otherwise(0.0)).alias(which)
    standing = ranks.groupBy("host").agg(rank_of("trust"), rank_of("distrust"))
    tainted = F.col("distrust") > F.col("trust") * threshold * (1 + 1e-9)  # equal but for rounding: allowed
    return (slim.join(standing, "host", "left")
            .select("id", "host", "path", F.col("found.rule").alias("rule"),
                    F.coalesce("found.verdict", F.when(tainted, "block").otherwise("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
