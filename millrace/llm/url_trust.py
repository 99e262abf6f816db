"""URL filter: allow and block rules, and link-graph trust where no rule speaks.

Hosts form a graph: an edge for every absolute link from one host's pages to another host,
weighted by the number of links, and edges both ways between a host and the domain it
belongs to (its name without the first label, from three labels on). Trust is a
personalised PageRank from hosts with pages that rules allow, in proportion to their number;
distrust is the same on the reversed graph from hosts with pages that rules block, so it reaches
those that link to them. Rounds go on until no host's rank changes by more than ``TOLERANCE`` of
itself, so the farthest host of a chain is reached, and small ranks in a large graph settle like
large ones in a small graph. A page without a rule is blocked when its host's distrust is more than
``MARGIN`` times its trust, else allowed; both are compared with each other only, whatever share of
all seeds they are.

All steps are DataFrame operations. Links are counted per pair of hosts before anything is
joined, so a host with a third of all pages is a few rows of the graph; its pages get their
verdict by join_per_key(), which spreads frequent keys.

Host: behind the first `://` up to `/`, `?`, `#`, A-Z lowered; path: then up to `?`, `#`. A null
url, or one without `://`, has both empty, no rule, and is allowed. Null html has no links. Repeated
rows are pages of their own. Of rules that fit, the longest counts, of equally long ones the last by host
and path. Texts of any length are searched whole; an empty table gives an empty result; columns
other than page_id, url and html are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.tables import staged
from millrace.operators.skew import join_per_key

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
DAMPING, TOLERANCE, MARGIN = 0.85, 1e-4, 1.001
# Rounds of one written step; a step ends with a look at the change.
STEP = 6
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOT_HOSTS, HOT_PAGES = 5_000, 1_000


def with_host_and_path(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.expr("if(instr(_url, '://') > 0, substring(_url, instr(_url, '://') + 3), '')")
    return (pages.withColumn("_url", url).withColumn("_rest", rest)
            .withColumn("_host", F.regexp_extract("_rest", "^[^/?#]*", 0))
            .withColumn("path", F.expr("regexp_extract(substring(_rest, length(_host) + 1), '^[^?#]*', 0)"))
            .withColumn("host", F.translate("_host", UPPER, LOWER)).drop("_url", "_rest", "_host"))


def _fits(host: str, path: str) -> Column:
    return (((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host)))
            & F.startswith(F.col("path"), F.lit(path)))


def with_rule(frame: DataFrame, rules=None) -> DataFrame:
    """Adds rule (the longest that fits, like `net/`) and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(RULES if rules is None else rules,
                                   key=lambda r: (len(r[0] + r[1]), r)):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(says)).otherwise(verdict)
    return frame.withColumns({"rule": rule, "said": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) between different hosts; ``pages`` has host and html."""
    links = (pages.filter("host <> ''")
             .select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
             .groupBy("host", F.translate("to", UPPER, LOWER).alias("dst")).agg(F.count("*").alias("n"))
             .select(F.col("host").alias("src"), "dst", "n"))
    names = pages.select("host").union(links.select("dst")).distinct()
    own = (names.filter("host like '%.%.%'")
           .select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("domain")))
    both = own.select(F.col("host").alias("src"), F.col("domain").alias("dst"), F.lit(1).alias("n")).union(
        own.select(F.col("domain").alias("src"), F.col("host").alias("dst"), F.lit(1).alias("n")))
    return (links.union(both).filter("src <> dst").groupBy("src", "dst")
            .agg(F.sum("n").alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None,
              damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, rank): personalised PageRank of every kind. ``edges`` has kind, src, dst, n,
    ``seeds`` kind, host, rank with ranks that add up to 1 per kind. So many ``rounds``, or until no
    rank changes by more than ``tolerance`` of itself; every few rounds are written."""
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    shares = staged(edges.join(out, ["kind", "src"])
                    .select("kind", F.col("src").alias("host"), "dst",
                            (F.col("n") / F.col("all")).alias("share")), "trust-edges")
    start = seeds.select("kind", "host", (F.col("rank") * (1 - damping)).alias("rank"))

    def after(rank: DataFrame) -> DataFrame:
        passed = rank.join(shares, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        return passed.union(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))

    rank, done = seeds.select("kind", "host", "rank"), 0
    while rounds is None or done < rounds:
        step = STEP if rounds is None else min(STEP, rounds - done)
        for _ in range(step):
            rank = after(rank)
        done += step
        rank = staged(rank, "trust-round")
        # One round more on the written ranks shows how much they still change.
        if rounds is None:
            both = (after(rank).withColumn("was", F.lit(0.0))
                    .union(rank.select("kind", "host", F.lit(0.0), F.col("rank")))
                    .groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("was").alias("was")))
            change = both.agg(F.max(F.abs(F.col("rank") - F.col("was")) / F.col("rank"))).first()[0]
            if change is None or change <= tolerance:
                break
    return rank


def judge(pages: DataFrame, rules=None, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    read = with_rule(with_host_and_path(
        pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("string"))), rules)
    rows = staged(read.select("page_id", "host", "path", "rule", "said"), "trust-pages")
    edges = staged(host_edges(read), "trust-links")
    both = edges.withColumn("kind", F.lit("trust")).union(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n",
                     F.lit("distrust").alias("kind"))).select("kind", "src", "dst", "n")
    kind = F.when(F.col("said") == "allow", "trust").when(F.col("said") == "block", "distrust")
    marked = rows.filter("said is not null and host <> ''").groupBy(kind.alias("kind"), "host").count()
    whole = marked.groupBy("kind").agg(F.sum("count").alias("all"))
    seeds = staged(marked.join(whole, "kind")
                   .select("kind", "host", (F.col("count") / F.col("all")).alias("rank")), "trust-seeds")
    ranks = propagate(both, seeds, tolerance=tolerance)

    def of_kind(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))

    per = ranks.groupBy("host").agg((of_kind("distrust") > MARGIN * of_kind("trust")).alias("distrusted"))
    hosts = staged(rows.groupBy("host").agg(F.count("*").alias("copies")).join(per, "host", "left"),
                   "trust-hosts")
    judged = join_per_key(rows, hosts, "host", "copies", ("page_id", "path"), HOT_HOSTS, HOT_PAGES)
    method = F.when(F.col("distrusted"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"))
