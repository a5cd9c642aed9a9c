"""URL verdicts: explicit rules first, then trust and distrust spread over the link graph of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from sitegrade.llm.common import scratch, stored

DAMPING = 0.85
TOLERANCE = 1e-4
MOST_ROUNDS = 400  # scores of a web of 10^20 hosts have settled by then
THRESHOLD = 0.5
CREDIT = 0.3

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LINK = r"""(?i)<a\s[^<>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""  # a tag ends at the next one, so tags that are never closed are each read once


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty if there is none."""
    return F.translate(_part(url, r"(?s)^.*?://([^/?#]*)"), *_LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return _part(url, r"(?s)^.*?://[^/?#]*([^?#]*)")


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name and verdict of the longest rule that fits the host or a domain above it and starts the path; null if none fits."""
    longest_first = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = F.lit(None).cast("struct<rule string, verdict string>")
    for rule in reversed(longest_first):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        found = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fits = F.when(inside & path.startswith(rule.path), found).otherwise(fits)
    return fits


def host_edges(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``src, dst, links``: how many links of pages on one host lead to another, or to itself.

    Links without a host belong to the page's own host; links of other schemes
    (``mailto:`` and the like) and pages without a host have no edge.  Partial
    sums leave one row for each edge and map task before the shuffle, so a hub
    that holds a third of all links does not gather them in one task.
    """
    host = url_host(F.col(url))
    link = F.explode(F.regexp_extract_all(F.col(html), F.lit(_LINK), F.lit(1)))
    links = pages.select(host.alias("src"), link.alias("link")).where(F.col("src") != "")
    relative = ~F.col("link").rlike(r"^([a-zA-Z][a-zA-Z0-9+.-]*:|//)")
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    dst = F.when(relative, F.col("src")).otherwise(url_host(absolute))
    return links.select("src", dst.alias("dst")).where(F.col("dst") != "").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def propagate(
    edges: DataFrame, seeds: DataFrame, folder: str, damping: float = DAMPING, tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS, keep: float | None = None
) -> DataFrame:
    """Personalised PageRank ``host, score`` of ``seeds`` (``host, seed``) along ``edges`` (``src, dst, weight``; weights of a source sum to one at most).

    A host keeps ``1 - damping`` of its seed (or ``keep`` of it) and receives
    ``damping`` of what the hosts linking to it pass on.  The scores are not
    scaled to sum to one, so a host's score is comparable to its seed on a web
    of any size.  ``seeds`` may have a second seed, ``base``, which spreads in
    the same rounds and is returned beside the score.

    Each round is written to the shared folder, which cuts the lineage.  The
    rounds end when nothing moves by more than ``tolerance``, of scores over one
    by more than that share of them; not to get there raises an error.
    """
    keep = 1 - damping if keep is None else keep
    names = {"score": "seed"} | ({"base_score": "base"} if "base" in seeds.columns else {})
    scores = seeds.select("host", *[F.col(seed).alias(score) for score, seed in names.items()], *names.values())
    for k in range(most_rounds):
        passed = edges.join(scores.select(F.col("host").alias("src"), *names).where(" or ".join(f"{score} > 0" for score in names)), "src")
        received = passed.groupBy(F.col("dst").alias("host")).agg(*[F.sum(F.col("weight") * F.col(score)).alias(f"received_{score}") for score in names])
        joined = scores.join(received, "host", "full_outer")
        known = lambda c: F.coalesce(c, F.lit(0.0))
        after = {score: keep * known(seed) + damping * known(f"received_{score}") for score, seed in names.items()}
        moved = [F.abs(new - known(score)) / F.greatest(F.lit(1.0), new) for score, new in after.items()]
        rounds = joined.select(
            "host", *[new.alias(score) for score, new in after.items()], *[known(seed).alias(seed) for seed in names.values()],
            F.greatest(*moved, F.lit(0.0)).alias("moved"),
        )
        scores = stored(rounds, folder, f"round-{k}")
        if (scores.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            return scores.select("host", *names)
    raise RuntimeError(f"scores still move by more than {tolerance} after {most_rounds} rounds")


def judge(pages: DataFrame, rules: Sequence[Rule], threshold: float = THRESHOLD, credit: float = CREDIT, folder: str | None = None) -> DataFrame:
    """One row for each row of ``pages``: ``page_id, host, path, rule, verdict, trust, distrust``.

    Where a rule fits, its verdict holds.  The pages that rules judge also seed
    the link graph: a host is trusted by the share of its pages that rules
    allow and blocked by the share that rules block.  Trust spreads along the
    links between hosts (what a trusted host links to), distrust against them
    (what links to a blocked host).  Both are shares: ``trust`` is the part of a
    host's PageRank that stems from trusted hosts, ``distrust`` the blocked part
    of a host plus the damped share of its links that lead to distrusted ones.

    A page without a rule is blocked if its host's distrust is over
    ``threshold``, raised by ``credit`` times its trust.  Anyone may be linked
    to, so trust cannot outweigh a host whose every link leads to blocked ones.

    Links within a host count for neither.  Hosts without links keep their
    seeds.  Pages without a url or a ``://`` have an empty host and path, and are
    allowed unless a rule says otherwise; repeated and null ids stay, a null
    html has no links, an empty table gives no rows, and only ``page_id, url,
    html`` are read.
    """
    folder = folder or scratch(pages.sparkSession)
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("found", matched_rule(F.col("host"), F.col("path"), rules))
    counted = judged.where(F.col("host") != "").groupBy("host").agg(
        F.avg(F.when(F.col("found.verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("found.verdict") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    hosts = stored(counted, folder, "hosts")
    outer = stored(host_edges(pages).where("src <> dst").withColumnRenamed("src", "host"), folder, "edges")

    # Each host's links to others shared out: forward whole, backward for the part of the linker that rules do not block.
    linkers = outer.groupBy("host").agg(F.sum("links").alias("total")).join(hosts, "host").select("host", (1 / F.col("total")).alias("each"), (1 - F.col("blocked")).alias("open"))
    shared = outer.join(stored(linkers, folder, "linkers"), "host").withColumn("weight", F.col("links") * F.col("each"))
    shared = stored(shared.select(F.col("host").alias("src"), "dst", "weight", "open"), folder, "shared")
    linked = shared.select(F.col("dst").alias("host")).distinct()
    nodes = hosts.join(linked, "host", "full_outer").select("host", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("allowed", "blocked")])
    nodes = stored(nodes, folder, "nodes")
    trust = propagate(shared, nodes.select("host", F.col("allowed").alias("seed"), F.lit(1.0).alias("base")), f"{folder}/trust")
    backward = shared.select(F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("weight") * F.col("open")).alias("weight"))
    distrust = propagate(backward, nodes.select("host", F.col("blocked").alias("seed")), f"{folder}/distrust", keep=1.0)

    # What a host has of its own, and rules do not allow, is no evidence for or against it.
    evidence = F.col("base_score") - (1 - DAMPING) * (1 - F.col("allowed"))
    share = F.when(evidence > TOLERANCE, F.least(F.lit(1.0), F.col("score") / evidence)).otherwise(0.0)
    trusted = nodes.join(trust, "host").select("host", share.alias("trust"))
    scored = stored(trusted.join(distrust.withColumnRenamed("score", "distrust"), "host"), folder, "scored")
    known = {c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")}
    suspect = known["distrust"] > threshold + credit * known["trust"]
    return judged.join(scored, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(suspect, "block").otherwise("allow")).alias("verdict"),
        known["trust"].alias("trust"), known["distrust"].alias("distrust"),
    )
