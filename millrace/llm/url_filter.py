"""URL filter: host rules first, link-graph propagation for hosts without a rule.

Pages whose url a rule allows make their hosts trusted seeds, pages that a rule blocks make theirs
blocked seeds, both by number of pages. Personalised PageRank carries trust along links; distrust
goes against them, to hosts that link to blocked ones. Both run in the same Spark iterations over
host edges (links counted per pair of hosts), each step stored, until the scores settle. A host
is blocked when its distrust is above `ratio` times its trust.

Cases: null urls and urls without `://` have empty host and path and, without a fitting rule, are
allowed, as is a host that neither trust nor distrust reaches; equal pages count once each and get
equal verdicts; links without a host part stay on their host and carry nothing elsewhere; hosts
are scored by their names without user and port, while rules and results have them as written; hosts
that link nowhere give their share back to the seeds; without any links the seeds' own shares decide;
an empty table gives an empty result; other columns of the input are not read; a page of any length
is searched whole for links.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.runtime import checkpointed, lookup_join, materialized

DAMPING = 0.85
#: Iterations end when no kind of score moves by more than this in sum, or after so many steps.
TOLERANCE = 1e-6
MAX_STEPS = 100
#: Distrust over trust above which a host is blocked.
RATIO = 1.0

HOST_PATTERN = r"://([^/?#]*)"
PATH_PATTERN = r"://[^/?#]*([^?#]*)"
LINK_PATTERN = r"""(?i)\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    UrlRule(ALLOW, "org", "/"),
    UrlRule(BLOCK, "example.org", "/es/"),
    UrlRule(BLOCK, "example.org", "/en/1"),
    UrlRule(ALLOW, "com", "/fr/"),
    UrlRule(BLOCK, "com", "/de/"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, HOST_PATTERN, 1)), F.lit(""))


def site_of(host: Column) -> Column:
    """The host's name: a user or a port is no part of it."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH_PATTERN, 1), F.lit(""))


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    on_host = (host == rule.host) | host.endswith("." + rule.host)
    return on_host & path.startswith(rule.path)


def ruling(rules: Sequence[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (of equally long ones a blocking one)."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))
    whens = [(fits(r, host, path), r) for r in ordered]
    none = F.lit(None).cast("string")
    if not whens:
        return none, none
    return tuple(
        reduce(lambda c, w: c.when(w[0], value(w[1])), whens[1:], F.when(whens[0][0], value(whens[0][1])))
        for value in (lambda r: F.lit(r.text), lambda r: F.lit(r.verdict))
    )


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between different hosts as (src, dst, links)."""
    links = pages.select(
        site_of(url_host(F.col(f"`{url}`"))).alias("src"),
        F.explode(
            F.array_distinct(
                F.transform(
                    F.regexp_extract_all(F.col(f"`{html}`"), F.lit(LINK_PATTERN), F.lit(1)),
                    lower_ascii,
                )
            )
        ).alias("dst"),
    )
    named = links.select("src", site_of(F.col("dst")).alias("dst"))
    return (
        named.filter("src != '' AND dst != '' AND src != dst")
        .groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def propagate(
    edges: DataFrame,
    seeds: DataFrame,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    max_steps: int = MAX_STEPS,
) -> DataFrame:
    """Scores per (kind, host) by personalised PageRank from `seeds` (kind, host, weight).

    `edges` has (kind, from, to, links): each kind walks its own edges. Scores of a kind sum to 1.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    seeds = materialized(
        seeds.join(F.broadcast(total), "kind")  # a row per kind
        .groupBy("kind", "host").agg((F.sum(F.col("weight") / F.col("total"))).alias("seed"))
        .filter("seed > 0"),
        "url-seeds",
    )
    out = edges.groupBy("kind", "from").agg(F.sum("links").alias("out"))
    walks = materialized(
        edges.join(out, ["kind", "from"]).select(
            "kind", F.col("from").alias("host"), "to", (F.col("links") / F.col("out")).alias("part")
        ),
        "url-walks",
    )
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    if walks.isEmpty():
        return scores
    for _ in range(max_steps):
        carried = checkpointed(
            scores.join(walks, ["kind", "host"])
            .groupBy("kind", "to").agg(F.sum(F.col("score") * F.col("part")).alias("got"))
            .select("kind", F.col("to").alias("host"), "got")
        )
        # What hosts without links hold, and hence did not pass on, goes back to the seeds.
        passed = {r["kind"]: r["got"] for r in carried.groupBy("kind").agg(F.sum("got").alias("got")).collect()}
        lost = F.lit(1.0)
        for kind, got in passed.items():  # a row per kind
            lost = F.when(F.col("kind") == kind, F.lit(1.0 - got)).otherwise(lost)
        fresh = checkpointed(
            seeds.join(carried, ["kind", "host"], "full").select(
                "kind", "host",
                (
                    F.coalesce("seed", F.lit(0.0)) * (1 - damping + damping * lost)
                    + damping * F.coalesce("got", F.lit(0.0))
                ).alias("score"),
            )
        )
        moved = (
            fresh.join(scores.withColumnRenamed("score", "before"), ["kind", "host"], "full")
            .groupBy("kind")
            .agg(F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))).alias("d"))
            .agg(F.max("d")).first()[0]
        )
        scores = fresh
        if (moved or 0.0) <= tolerance:
            break
    return scores


def host_scores(ruled: DataFrame, edges: DataFrame, **walk) -> DataFrame:
    """Trust and distrust per host's name; `ruled` has host and the rule's verdict of every page."""
    seeds = (
        ruled.withColumn("host", site_of(F.col("host")))
        .filter("host != '' AND ruled IS NOT NULL")
        .groupBy(F.when(F.col("ruled") == ALLOW, "trust").otherwise("distrust").alias("kind"), "host")
        .agg(F.count("*").alias("weight"))
    )
    both = edges.select(
        F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "links"
    ).unionByName(
        edges.select(
            F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"),
            "links",
        )
    )
    scores = propagate(both, seeds, **walk)
    score = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))
    return scores.groupBy("host").agg(
        score("trust").alias("trust"), score("distrust").alias("distrust")
    )


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    rules: Sequence[UrlRule] = RULES,
    ratio: float = RATIO,
    **walk,
) -> DataFrame:
    """`key`, host, path, rule, verdict, and the host's trust and distrust (0 where none came)."""
    host, path = url_host(F.col(f"`{url}`")), url_path(F.col(f"`{url}`"))
    text, verdict = ruling(rules, F.col("host"), F.col("path"))
    ruled = (
        pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"))
        .withColumns({"rule": text, "ruled": verdict})
    )
    edges = materialized(host_edges(pages, url, html), "url-edges")
    scores = materialized(host_scores(ruled, edges, **walk), "url-scores")
    judged = lookup_join(
        ruled.withColumn("site", site_of(F.col("host"))),
        scores.withColumnRenamed("host", "site"), ["site"], "left",
    )
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    by_links = F.when(distrust > ratio * trust, BLOCK).otherwise(ALLOW)
    return judged.select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("ruled", by_links).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
