"""URL filters: rules on host and path, and trust that spreads over the links between hosts.

Pages covered by a rule get its verdict. For the others two personalised PageRanks run over the host
graph of all pages: trust starts at the hosts of allowed pages and follows links; distrust starts at the
hosts of blocked pages and goes against links, to whoever links there. Both are compared with the share
of pages a host has, and a threshold per host gives the verdict.

Every step is one join of the host edges, summed per pair of hosts beforehand, with the scores and one
grouping; scores are written to a table each time, so the lineage stays short.

Defined cases: a url that is null or has no ``://`` has an empty host and path, fits no rule and, having
no host, is allowed; a null html has no links; repeated pages count as often as they are there; a null
page_id passes through; without seeds nothing is distrusted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import LOWER, UPPER, only
from lakemart.session import stored

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85  # share of a score that moves along links
SETTLED = 0.01  # of the share of a single page: what all scores together may still move when the steps end
MOST_ROUNDS = 1000  # steps after which an error is raised; each leaves at most DAMPING of the distance
DISTRUST = 1.0  # distrust over page share from which a host is blocked, if it is not trusted more

LINK = r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and the rule's verdict of every page."""
    parts = only(pages, "page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parts.withColumns({"rule": rule, "rule_verdict": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """source, target and n: the links between hosts. Links without a host stay at their page's."""
    read = only(pages, "url", "html").select(
        host_of(F.col("url")).alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link")
    )
    link = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    absolute = link.rlike("(?i)^https?://")
    foreign = ~absolute & link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")  # mailto: and the like
    target = F.when(absolute, host_of(link)).when(~foreign, F.col("source"))
    edges = read.select("source", target.alias("target")).where("source != '' AND target != ''")
    return edges.groupBy("source", "target").agg(F.count("*").alias("n"))


def _moves(edges: DataFrame) -> DataFrame:
    """start, end and the share of trust and of distrust that goes there."""
    out = edges.groupBy(F.col("source").alias("of")).agg(F.sum("n").alias("all"))
    into = edges.groupBy(F.col("target").alias("of")).agg(F.sum("n").alias("all"))
    forward = edges.join(out, F.col("source") == F.col("of")).select(
        F.col("source").alias("start"), F.col("target").alias("end"), (F.col("n") / F.col("all")).alias("t"), F.lit(0.0).alias("d")
    )
    backward = edges.join(into, F.col("target") == F.col("of")).select(
        F.col("target").alias("start"), F.col("source").alias("end"), F.lit(0.0).alias("t"), (F.col("n") / F.col("all")).alias("d")
    )
    return forward.unionByName(backward)


def host_scores(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """host, its share of pages, trust and distrust (each adds up to one over all hosts, or is zero)."""
    seeds = judged.where("host != ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.sum((F.col("rule_verdict") == "allow").cast("long")).alias("allowed"),
        F.sum((F.col("rule_verdict") == "block").cast("long")).alias("blocked"),
    )
    seeds = stored(seeds.na.fill(0), "host_seeds")
    whole = seeds.agg(F.sum("pages").alias("pages"), F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()

    def share(name: str) -> Column:
        return (F.col(name) / float(whole[name])) if whole[name] else F.lit(0.0)

    edges = stored(host_edges(pages), "host_edges")
    moves = stored(_moves(edges), "host_moves")
    linked = edges.select(F.col("target").alias("host")).unionByName(edges.select(F.col("source").alias("host"))).distinct()
    start = linked.join(seeds, "host", "full").na.fill(0, ["pages", "allowed", "blocked"]).select(
        "host", share("pages").alias("share"), share("allowed").alias("t0"), share("blocked").alias("d0")
    )
    scores = stored(start.withColumns({"trust": F.col("t0"), "distrust": F.col("d0")}), "host_scores")
    seeded = (bool(whole["allowed"]), bool(whole["blocked"]))
    near = SETTLED / (whole["pages"] or 1)  # no host with pages has a smaller share than one page
    for _ in range(MOST_ROUNDS):
        sent = moves.join(scores.select("host", "trust", "distrust"), F.col("start") == F.col("host")).groupBy(F.col("end").alias("at")).agg(
            F.sum(F.col("t") * F.col("trust")).alias("t"), F.sum(F.col("d") * F.col("distrust")).alias("d")
        )
        got = scores.join(sent, F.col("host") == F.col("at"), "left").na.fill(0.0, ["t", "d"])
        # What hosts without links hold goes back to the seeds.
        moved = stored(got.select("host", "share", "t0", "d0", F.col("trust").alias("t1"), F.col("distrust").alias("d1"), "t", "d"), "host_moved")
        sums = moved.agg(F.sum("t").alias("t"), F.sum("d").alias("d")).first()
        lost_t = 1 - DAMPING * (sums["t"] or 0.0) if seeded[0] else 0.0
        lost_d = 1 - DAMPING * (sums["d"] or 0.0) if seeded[1] else 0.0
        after = moved.select(
            "host",
            "share",
            "t0",
            "d0",
            (DAMPING * F.col("t") + lost_t * F.col("t0")).alias("trust"),
            (DAMPING * F.col("d") + lost_d * F.col("d0")).alias("distrust"),
            F.col("t1"),
            F.col("d1"),
        )
        change = after.agg(F.sum(F.abs(F.col("trust") - F.col("t1")) + F.abs(F.col("distrust") - F.col("d1")))).first()[0]
        scores = after.drop("t1", "d1")
        # The steps to come move DAMPING, DAMPING^2, ... of this one's change at most.
        if (change or 0.0) * DAMPING / (1 - DAMPING) <= near:
            break
        scores = stored(scores, "host_scores")
    else:
        raise RuntimeError(f"the scores did not settle in {MOST_ROUNDS} steps: the last one moved {change}")
    return scores.select("host", "share", "trust", "distrust")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    judged = stored(judged_by_rules(pages, rules), "pages_by_rules")
    scores = host_scores(pages, judged)
    blocked = (F.col("distrust") >= DISTRUST * F.col("share")) & (F.col("distrust") > F.col("trust")) & (F.col("distrust") > 0)
    verdicts = scores.select(
        F.col("host").alias("of"), "trust", "distrust", F.when(blocked, "block").otherwise("allow").alias("host_verdict")
    )
    return judged.join(verdicts, F.col("host") == F.col("of"), "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
