"""URL filter: rules, and trust and distrust propagated over host links.

Hosts of allowed pages are seeds of trust, which follows links (personalised
PageRank); hosts of blocked pages are seeds of distrust, which follows links
backwards. Each ruled page gives its host the same rank however many there are,
and only the share of distrust in a host's ranks counts, so a neighbourhood is
judged alike in corpora of any size. Ranks are whole numbers, so results do not
depend on the order of sums; they grow from nothing until they stand. All steps are joins and sums over edges between hosts.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: The share of a rank that follows links, and the rank that one ruled page gives
#: out in all. Sums stay below 2^63 up to 9e9 ruled pages.
DAMPING, PAGE_RANK = 0.85, 10**9
#: Steps end when no rank changes by more than this.
TOLERANCE = PAGE_RANK // 10**6
#: A host is blocked when distrust is at least this share of its ranks.
SHARE = 0.5
#: Absolute links in a page.
LINK = r"""(?i)href\s*=\s*["']?\s*(https?://[^"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    lower = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, the longest rule that fits (of equal ones the first
    listed) and its verdict; null where none fits. For short lists of rules."""
    host, path = url_parts(F.col("url"))
    found = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(r.text))):
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return found.withColumn("rule", rule).withColumn("verdict", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts."""
    host, _ = url_parts(F.col("url"))
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))
    linked = pages.select(host.alias("src"), F.explode(links).alias("url"))
    linked = linked.select("src", url_parts(F.col("url"))[0].alias("dst"))
    return linked.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagated(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """host, trust, distrust from ``seeds`` (kind, host, n), after as many steps as
    it takes until no rank changes by more than TOLERANCE. Changes shrink by
    DAMPING in each step, so that they end.

    Rank that reaches a host without further links ends there.
    """
    both = links.select(F.lit("allow").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    back = links.select(F.lit("block").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    both = both.unionByName(back)
    totals = both.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    edges = both.join(totals, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("total")).alias("part"))
    edges = saved(edges, "edges")
    own = F.col("n") * round(PAGE_RANK * (1 - DAMPING))
    given = saved(seeds.select("kind", "host", own.cast("long").alias("rank"), F.lit(0).cast("long").alias("was")), "seeds")
    ranks, change = given, TOLERANCE + 1
    while change > TOLERANCE:
        moved = edges.join(ranks, ["kind", "host"]).select(
            "kind",
            F.col("to").alias("host"),
            F.floor(F.col("rank") * DAMPING * F.col("part")).cast("long").alias("rank"),
            F.lit(0).cast("long").alias("was"),
        )
        before = ranks.select("kind", "host", F.lit(0).cast("long").alias("rank"), F.col("rank").alias("was"))
        sums = moved.unionByName(given).unionByName(before).groupBy("kind", "host")
        ranks = saved(sums.agg(F.sum("rank").alias("rank"), F.sum("was").alias("was")), "ranks")
        change = ranks.agg(F.max(F.abs(F.col("rank") - F.col("was")))).first()[0] or 0
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0))
    return ranks.groupBy("host").agg(of("allow").alias("trust"), of("block").alias("distrust"))


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path,
    rule, verdict, trust, distrust.

    The verdict is the longest fitting rule's, else block where distrust
    prevails for the host, else allow. Null or malformed urls have an empty
    host and path and are allowed; null html has no links; page_id may be null
    or repeat; other columns are ignored.
    """
    found = saved(ruled(pages, rules), "ruled")
    seeds = found.where("verdict IS NOT NULL").groupBy(F.col("verdict").alias("kind"), "host")
    ranks = propagated(saved(host_links(pages), "links"), seeds.agg(F.count(F.lit(1)).alias("n")))
    trust, distrust = (F.coalesce(c, F.lit(0)) for c in ("trust", "distrust"))
    blocked = (distrust > 0) & (distrust >= SHARE * (trust + distrust))
    return found.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
