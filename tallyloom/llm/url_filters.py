"""URL rules, and trust propagated over the host graph for pages that no rule covers.

Rules name a host and a path prefix; a rule fits its host and all subdomains, and the longest
rule wins.  Hosts with allowed pages are trusted seeds, hosts with blocked pages are distrusted
seeds, each by its number of such pages.  Host edges are links to other hosts found in the
pages, counted, and one edge each way between a host and its parent domain (two labels at
least).  Personalised PageRank carries trust forwards from trusted seeds, and distrust backwards
from blocked ones; a host with more distrust than trust is blocked.

Ranks are whole numbers out of ``SCALE``, so sums do not depend on the order in which tasks
finish: a host's rank is damped and every link passes on rank * weight / links, each rounded down.  Each round
shrinks what the ranks still lack by the damping; ``ROUNDS`` is the number after which that is
below ``RESIDUAL`` of all trust, whatever the graph.  ``trust`` and ``distrust`` are
reported out of ``REPORTED``.

Defined cases: a url that is null or has no ``://`` has an empty host and path, no rule, and is
allowed; null html has no links; unknown hosts have no trust and no distrust and are allowed;
rows repeat as they come; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# (verdict, host and path).  A bounded list of rules: each becomes one branch of an expression.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)
# A rank of 24 digits times a weight of 12 stays within 38 digits.
SCALE = 10**24
REPORTED = 10**12
DAMPING_PERCENT = 85
RESIDUAL = 0.01
ROUNDS = math.ceil(math.log(RESIDUAL) / math.log(DAMPING_PERCENT / 100))

LINK = r"(?i)\bhref[\x20\x09-\x0D]*=[\x20\x09-\x0D]*[\x22\x27]?([a-z][a-z0-9+.-]*://[^\x22\x27>\x20\x09-\x0D]*|//[^\x22\x27>\x20\x09-\x0D]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    return F.coalesce(F.get(F.split(url, "://", 2), 1), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``rule_verdict``, both null where no rule fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = (F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))
        fits &= F.startswith(F.col("path"), F.lit(slash + prefix))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    placed = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return placed.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): links between hosts, and hosts with their parent domains."""
    linked = pages.select(
        host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("link")
    )
    target = F.when(F.startswith(F.col("link"), F.lit("//")), F.concat(F.lit(":"), "link")).otherwise(F.col("link"))
    linked = linked.select("src", host_of(target).alias("dst"))
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    owned = hosts.select("host", parent.alias("parent"))
    both = owned.select(F.col("host").alias("src"), F.col("parent").alias("dst")).unionByName(
        owned.select(F.col("parent").alias("src"), F.col("host").alias("dst"))
    )
    real = (F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))
    return linked.unionByName(both).where(real).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def quotient(dividend: Column, divisor: Column) -> Column:
    """Whole part of a quotient of whole decimals, exact at 38 digits; nothing is lost to rounding."""
    return ((dividend - dividend % divisor) / divisor).cast("decimal(38,0)")


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING_PERCENT) -> DataFrame:
    """(host, trust, distrust) out of ``SCALE`` from seeds (host, allowed, blocked) over ``edges``.

    Every round joins ranks with arcs and sums per target; its result is written out, so
    plans stay short and a round survives lost executors.  A hub's arcs are split at the join.
    """
    total = seeds.agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked"))
    count = lambda c: F.col(c).cast("decimal(12,0)")
    rank = lambda c: F.col(c).cast("decimal(25,0)")
    none = F.lit(0).cast("decimal(38,0)")
    parts = F.lit(100).cast("decimal(12,0)")
    share = lambda c: F.coalesce(F.lit(Decimal(SCALE // 100)).cast("decimal(25,0)") * count(c), none)
    whole = lambda t: total.select(count(t)).scalar()
    part = lambda c, t: F.when(whole(t) > 0, quotient(share(c), whole(t)) * F.lit(100).cast("decimal(3,0)")).otherwise(none)
    base = stored(
        seeds.select("host", part("allowed", "all_allowed").alias("trust"), part("blocked", "all_blocked").alias("distrust"))
    )
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    back = edges.groupBy("dst").agg(F.sum("weight").alias("back"))
    shared = edges.join(out, "src").join(back, "dst")
    nothing = F.lit(0).cast("long")
    # A link carries ``t`` of the ``of`` links that pass on trust, or ``d`` of those that pass on distrust.
    arcs = stored(
        shared.select(
            F.col("src").alias("host"), F.col("dst").alias("to"), F.col("weight").alias("t"), nothing.alias("d"), F.col("out").alias("of")
        ).unionByName(shared.select(
            F.col("dst").alias("host"), F.col("src").alias("to"), nothing.alias("t"), F.col("weight").alias("d"), F.col("back").alias("of")
        ))
    )
    percent = lambda c, p: quotient(rank(c) * F.lit(p).cast("decimal(12,0)"), parts).alias(c)
    restart = stored(base.select("host", percent("trust", 100 - damping), percent("distrust", 100 - damping)))
    damped = lambda c: percent(c, damping)
    passed = lambda c, w: quotient(rank(c) * count(w), count("of")).alias(c)
    total_of = lambda c: F.sum(c).cast("decimal(38,0)").alias(c)
    ranks = base
    for _ in range(rounds):
        ready = ranks.select("host", damped("trust"), damped("distrust"))
        moved = arcs.join(ready, "host").select(F.col("to").alias("host"), passed("trust", "t"), passed("distrust", "d"))
        ranks = stored(moved.unionByName(restart).groupBy("host").agg(total_of("trust"), total_of("distrust")))
    return ranks


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust, for every page."""
    ruled = with_rules(pages.select("page_id", "url"), rules)
    seeds = stored(
        ruled.where("host <> ''").groupBy("host").agg(
            F.count_if(F.col("rule_verdict") == "allow").alias("allowed"),
            F.count_if(F.col("rule_verdict") == "block").alias("blocked"),
        )
    )
    edges = stored(host_edges(pages.select("url", "html"), seeds))
    ranks = propagate(edges, seeds, rounds)
    none = F.lit(0).cast("decimal(38,0)")
    judged = ruled.join(ranks, "host", "left").withColumns(
        {"trust": F.coalesce("trust", none), "distrust": F.coalesce("distrust", none)}
    )
    unit = F.lit(SCALE // REPORTED).cast("decimal(13,0)")
    reported = lambda c: quotient(F.col(c), unit).cast("long").alias(c)
    verdict = F.coalesce("rule_verdict", F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), reported("trust"), reported("distrust"))
