"""URL filter: rules first, then trust and distrust spread over the host graph.

A rule names a host and the beginning of a path; the longest that fits decides. Pages no
rule decides are judged by their host. Hosts with allowed pages are trusted seeds, those
with blocked pages distrusted seeds, each by its share of such pages. Personalised
PageRank carries trust along the links and distrust against them: whoever links to a bad
host is doubted. A host is blocked where distrust reaches ``RATIO`` times its trust.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import prepare, stored

DAMPING = 0.85
RATIO = 4.0
TOLERANCE = 1e-6  # of a host's own rank
ROUNDS_PER_WRITE = 5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Inside one tag: a search never runs beyond the next one, so it takes time in proportion.
_HREF = r"""(?i)<a\s[^<>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]*)"""


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    host = F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    path = F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct(text, verdict); null if none does."""
    kind = "struct<text:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        told = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, told.cast(kind)).otherwise(out)
    return out


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, weighed by their number."""
    link = F.explode(F.regexp_extract_all(F.col("html"), F.lit(_HREF), F.lit(1)))
    whole = F.regexp_replace("link", r"\A[^/]*//", "x://")  # also links without a scheme
    return (
        pages.select(F.col("host").alias("src"), link.alias("link"))
        .select("src", host_of(whole).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def propagate(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Personalised PageRank: (host, rank), from seeds (host, seed).

    rank = (1 - d) seed + d (what came along the links); what a host without links holds
    leaves the graph. Ranks are written every few rounds, so lineage stays short; it ends
    when between two writes no host moves by the tolerance of its own rank, so however small
    the seeds, a host far along a chain is reached. The rounds grow with the longest way.
    """
    out = links.groupBy("src").agg(F.sum("weight").alias("total"))
    steps = stored(
        links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p")),
        "steps",
    )
    own = F.col("seed") * (1 - DAMPING)
    ranks = seeds.select("host", own.alias("rank"))
    while True:
        now = ranks
        for _ in range(ROUNDS_PER_WRITE):
            came = (
                steps.join(now.select(F.col("host").alias("src"), "rank"), "src")
                .groupBy(F.col("dst").alias("host"))
                .agg(F.sum(F.col("p") * F.col("rank")).alias("came"))
            )
            now = seeds.join(came, "host", "left").select(
                "host", (own + DAMPING * F.coalesce("came", F.lit(0.0))).alias("rank")
            )
        before, ranks = ranks.withColumnRenamed("rank", "old"), stored(now, "ranks")
        change = F.abs(F.col("rank") - F.col("old")) / F.col("rank")
        moved = ranks.join(before, "host").agg(F.max(F.when(F.col("rank") > 0, change)))
        if (moved.first()[0] or 0.0) < TOLERANCE:
            break
    return ranks


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """Every row's page_id, host, path, rule, verdict, trust and distrust.

    Null urls, and urls without ``://``, have empty host and path, fit no rule and are
    allowed. Null html has no links. A host no seed reaches has neither trust nor
    distrust and is allowed. Repeated rows count as often as they are there. Without
    pages there is no row. Other columns are ignored.
    """
    prepare(pages.sparkSession)
    url = F.col("url")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "html")
    ruled = placed.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    slim = ruled.select(
        "page_id", "host", "path", F.col("best.text").alias("rule"), F.col("best.verdict").alias("v")
    )
    links = stored(host_links(placed), "links")
    counts = slim.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("v") == "allow").cast("double").alias("good"),
        F.count_if(F.col("v") == "block").cast("double").alias("bad"),
    )
    ends = links.select(F.col("src").alias("host")).unionAll(links.select("dst")).distinct()
    hosts = ends.join(counts, "host", "full").na.fill(0.0, ["good", "bad"])
    whole = counts.agg(F.sum("good").alias("goods"), F.sum("bad").alias("bads"))
    seeds = stored(
        hosts.crossJoin(F.broadcast(whole)).select(  # one row
            "host",
            F.when(F.col("goods") > 0, F.col("good") / F.col("goods")).otherwise(0.0).alias("good"),
            F.when(F.col("bads") > 0, F.col("bad") / F.col("bads")).otherwise(0.0).alias("bad"),
        ),
        "seeds",
    )
    trust = propagate(links, seeds.select("host", F.col("good").alias("seed")))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(back, seeds.select("host", F.col("bad").alias("seed")))
    # Written first: the join below can split a hot host only against a plain table.
    ranks = stored(
        trust.withColumnRenamed("rank", "trust").join(
            distrust.withColumnRenamed("rank", "distrust"), "host"
        ),
        "both",
    )
    known = slim.join(ranks, "host", "left").na.fill(0.0, ["trust", "distrust"])
    doubted = (F.col("distrust") > 0) & (F.col("distrust") >= RATIO * F.col("trust"))
    return known.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("v", F.when(doubted, "block").otherwise("allow")).alias("verdict"),
        "trust",
        "distrust",
    )
