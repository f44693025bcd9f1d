"""URL filters by link-graph propagation.

Rules on hosts and paths judge what they name. The rest is judged by its host: personalised PageRank carries trust
along links from hosts with allowed pages, reversed PageRank carries distrust from blocked hosts back to the hosts
that link to them, and a host is blocked where distrust makes up most of its score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.llm.common import discard, materialise


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rounds of the walks from one written table to the next.
STRIDE = 5
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>\\]+)"""


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(url_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url_rest(url), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...], field: str) -> Column:
    """``field`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, field))).otherwise(out)
    return out


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float, rounds: int, tolerance: float, strict: bool = False
) -> DataFrame:
    """(host, trust, distrust). edges: (src, dst, w) without loops; seeds: (host, trust, distrust), each summing to 1.

    Both walks run in one join and one aggregation a round, along rows (from, to, trust share, distrust share); the
    scores of every few rounds are a written table, and the loop ends when no score moves by more than ``tolerance``
    times itself in a round: shares shrink with the number of seeds, and what they decide is their ratio. With
    ``strict`` walks that ``rounds`` don't bring there are an error, not a result. Mass that reaches a host without a
    way on is not returned here; see ``whole``.
    """
    out_w = edges.groupBy("src").agg(F.sum("w").alias("out_w"))
    in_w = edges.groupBy("dst").agg(F.sum("w").alias("in_w"))
    forward = edges.join(out_w, "src").select(
        F.col("src").alias("a"), F.col("dst").alias("b"), (F.col("w") / F.col("out_w")).alias("t"), F.lit(0.0).alias("d")
    )
    backward = edges.join(in_w, "dst").select(
        F.col("dst").alias("a"), F.col("src").alias("b"), F.lit(0.0).alias("t"), (F.col("w") / F.col("in_w")).alias("d")
    )
    steps = materialise(forward.unionByName(backward), "url-steps")
    if steps.isEmpty():
        return seeds
    none = F.lit(0.0)
    start = seeds.select("host", ((1 - damping) * F.col("trust")).alias("t"), ((1 - damping) * F.col("distrust")).alias("d"), none.alias("t0"), none.alias("d0"))
    scores, done = seeds.select("host", "trust", "distrust"), 0
    while done < rounds:
        after = scores
        for k in range(min(STRIDE, rounds - done)):
            moved = steps.join(after, F.col("a") == F.col("host")).select(
                F.col("b").alias("host"), (damping * F.col("trust") * F.col("t")).alias("t"), (damping * F.col("distrust") * F.col("d")).alias("d"), none.alias("t0"), none.alias("d0")
            )
            then = after.select("host", none.alias("t"), none.alias("d"), F.col("trust").alias("t0"), F.col("distrust").alias("d0"))
            parts = moved.unionByName(start).unionByName(then)
            sums = [F.sum(c).alias(n) for c, n in (("t", "trust"), ("d", "distrust"), ("t0", "trust0"), ("d0", "distrust0"))]
            after = parts.groupBy("host").agg(*sums)
            done += 1
        after = materialise(after, "url-scores")
        if scores.columns != seeds.columns:
            discard(scores)
        scores = after
        moved_by = lambda now, before: F.abs(F.col(now) - F.col(before)) / F.when(F.col(now) > 0, F.col(now))
        change = scores.agg(F.max(F.greatest(moved_by("trust", "trust0"), moved_by("distrust", "distrust0")))).first()[0]
        if change is None or change <= tolerance:
            break
    else:
        if strict:
            raise RuntimeError(f"link-graph walks still move by {change} of a score after {rounds} rounds")
    discard(steps)
    return scores.select("host", "trust", "distrust")


def whole(scores: DataFrame) -> DataFrame:
    """The walks' scores as shares of 1.

    Mass that ends at hosts without a way on goes back to the seeds; since it leaves them again in the same shares,
    that multiplies all scores of a walk by the same number, and a walk that loses nothing sums to 1.
    """
    t, d = scores.agg(F.sum("trust"), F.sum("distrust")).first()
    return scores.select("host", (F.col("trust") / F.lit(t or 1.0)).alias("trust"), (F.col("distrust") / F.lit(d or 1.0)).alias("distrust"))


def filter_urls(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    damping: float = 0.85,
    rounds: int = 1000,
    tolerance: float = 1e-6,
    most_distrust: float = 0.5,
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): host, path, rule, verdict, trust, distrust.

    Host and path follow the first ``://``; a null url or one without it has both empty and no rule. Trust starts at
    hosts with pages that an allow rule fits, by their number; distrust at hosts with pages that a block rule on the
    whole host (path ``/``) fits: a rule on one path says nothing of a host's other pages. A page without a rule is
    blocked if distrust / (trust + distrust) of its host is above ``most_distrust``; without any score it is allowed.
    Walks go on until no score moves by more than ``tolerance`` of itself a round; beyond ``rounds`` that is an error.
    Null html has no links; links within a host don't count; several links from one page to a host count once;
    repeated rows are pages of their own; an empty table gives an empty result.

    DataFrame functions only. Pages are read once; what follows works on (page_id, host, path, linked hosts) and on
    host edges, summed with map-side combining. Host scores come back in a join of two scans, which adaptive
    execution may broadcast by measured size or split where one host holds many pages.
    """
    url = F.col("url").cast("string")
    linked = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    judged = materialise(
        pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), linked.alias("_l")).select(
            "page_id",
            "host",
            "path",
            fitting_rule(F.col("host"), F.col("path"), rules, "name").alias("rule"),
            fitting_rule(F.col("host"), F.col("path"), rules, "verdict").alias("ruled"),
            F.array_distinct(F.transform("_l", lambda x: F.translate(x, UPPER, LOWER))).alias("links"),
        ),
        "url-pages",
    )
    wide = [r.name for r in rules if r.verdict == "block" and r.path == "/"]
    marked = judged.groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").cast("double").alias("good"),
        F.count_if(F.col("rule").isin(wide)).cast("double").alias("bad"),
    )
    sums = marked.agg(F.sum("good").alias("all_good"), F.sum("bad").alias("all_bad"))
    good, bad = sums.first()
    share = lambda n, of: F.col(n) / F.lit(max(of or 0.0, 1.0))
    seeds = materialise(
        marked.filter("good > 0 or bad > 0").select(
            "host", share("good", good).alias("trust"), share("bad", bad).alias("distrust")
        ),
        "url-seeds",
    )
    edges = (
        judged.select(F.col("host").alias("src"), F.explode("links").alias("dst"))
        .filter("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("w"))
    )
    links = materialise(edges, "url-edges")
    scores = whole(propagate(links, seeds, damping, rounds, tolerance, strict=True))
    discard(links)
    scored = judged.join(scores, "host", "left")
    doubt = F.col("distrust") > most_distrust * (F.col("trust") + F.col("distrust"))
    own = F.when(doubt, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(F.col("ruled"), own)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), zero("trust"), zero("distrust"))
