"""Mixing sources to target weights by hierarchical budgets.

A tree of domain, language and source carries integer weights. The token budget flows
down from the root: a node splits its budget among its children by weight, a child that
cannot use its share (its documents, read at most ``epochs`` times, hold fewer tokens)
takes what it can, and the rest goes to its siblings by weight. Because a child's
capacity is that of its whole subtree, a shortage is made good among siblings before any
of it reaches the parent's siblings. Each leaf then reads its documents in seeded order,
epoch by epoch, up to the prefix that its budget buys.

All sums are integers. The tree is small (a row per leaf); documents are only ever
grouped by leaf with partial sums. The prefix needs no sort of a leaf: documents are
counted by ranges of the order first, and only the one range that the budget ends in is
sorted.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import WORD, numbered, prepare, stored, table

LEVELS = ("domain", "lang", "source")
RANGE_ROWS = 2000  # documents of the range that is sorted, about


@dataclass(frozen=True)
class Plan:
    """Weights by node; what is not named weighs ``other``. ``share`` is the budget per
    thousand of the tokens there are."""

    domains: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "web": tuple(f"src{i}" for i in range(8)),
            "books": tuple(f"src{i}" for i in range(8, 14)),
            "forums": tuple(f"src{i}" for i in range(14, 20)),
        }
    )
    domain_weights: dict[str, int] = field(
        default_factory=lambda: {"web": 50, "books": 30, "forums": 20}
    )
    lang_weights: dict[str, int] = field(
        default_factory=lambda: {"en": 55, "de": 15, "fr": 15, "es": 15}
    )
    source_weights: dict[str, int] = field(default_factory=lambda: {"src0": 3, "src9": 2})
    other: int = 1
    other_domain: str = "other"
    share: int = 700
    epochs: int = 2
    seed: int = 17


PLAN = Plan()


def _lookup(column, values: dict, other):
    out = F.lit(other)
    for key, value in values.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def _order(plan: Plan, epoch, doc_id, text):
    """A 60-bit place in the epoch's order, the same in any engine that has MD5."""
    told = F.concat_ws(
        ":", F.lit(str(plan.seed)), epoch, F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text)
    )
    return F.conv(F.substring(F.md5(told), 1, 15), 16, 10).cast("bigint")


def _leaves(docs: DataFrame, plan: Plan, lang: str, source: str, text: str) -> DataFrame:
    sources = {s: d for d, group in plan.domains.items() for s in group}
    text = F.coalesce(text, F.lit(""))
    return docs.select(
        "*",
        _lookup(F.col(source), sources, plan.other_domain).alias("__domain"),
        F.coalesce(lang, F.lit("")).alias("__lang"),
        F.coalesce(source, F.lit("")).alias("__source"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("bigint").alias("__n"),
    )


def _filled(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Children with ``cap``, ``weight`` and their parent's ``budget``: each one's ``got``.

    Children that cannot use their share are those first in order of cap / weight: child
    i is full if its cap is at most its share of what the fuller ones before it left.
    """
    key = [F.col(c) for c in parent] or [F.lit(1)]
    by_fill = Window.partitionBy(*key).orderBy(
        F.col("cap") / F.col("weight"), *[F.col(c) for c in LEVELS if c in nodes.columns]
    )
    whole = Window.partitionBy(*key)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    left = nodes.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (
            F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
        ).alias("rest"),
    )
    # cap <= left * weight / rest, in integers.
    ratio = left.withColumn(
        "full",
        F.col("cap").cast("decimal(38,0)") * F.col("rest")
        <= F.col("left").cast("decimal(38,0)") * F.col("weight"),
    )
    # Full ones come first; the others share what the full ones left.
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(whole)
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    share = F.floor(
        (F.col("budget") - spent).cast("decimal(38,0)") * F.col("weight") / open_weight
    ).cast("bigint")
    return ratio.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop(
        "left", "rest", "full", "budget"
    )


def budgets(docs: DataFrame, plan: Plan = PLAN) -> DataFrame:
    """One row per leaf: its tokens, documents, cap and the tokens it gets.

    ``docs`` has lang, source and text. Null languages and sources are the leaf of the
    empty name; sources that no domain names are in ``other_domain``. Null texts have no
    tokens. No documents, no rows.
    """
    slim = docs.select("lang", "source", "text")
    return _budgets(_leaves(slim, plan, *slim.columns), plan)


def _budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    level = (
        leaves.groupBy(
            F.col("__domain").alias("domain"),
            F.col("__lang").alias("lang"),
            F.col("__source").alias("source"),
        )
        .agg(F.sum("__n").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("cap", F.col("n_tokens") * plan.epochs)
    )
    weights = {
        "domain": _lookup(F.col("domain"), plan.domain_weights, plan.other),
        "lang": _lookup(F.col("lang"), plan.lang_weights, plan.other),
        "source": _lookup(F.col("source"), plan.source_weights, plan.other),
    }
    whole = level.agg(F.floor(F.sum("n_tokens") * plan.share / 1000).cast("bigint").alias("budget"))
    domains = level.groupBy("domain").agg(F.sum("cap").cast("bigint").alias("cap"))
    got = _filled(
        domains.crossJoin(whole).withColumn("weight", weights["domain"]), []  # one row
    ).select("domain", F.col("got").alias("budget"))
    langs = level.groupBy("domain", "lang").agg(F.sum("cap").cast("bigint").alias("cap"))
    got = _filled(
        langs.join(got, "domain").withColumn("weight", weights["lang"]), ["domain"]
    ).select("domain", "lang", F.col("got").alias("budget"))
    return _filled(
        level.join(got, ["domain", "lang"]).withColumn("weight", weights["source"]),
        ["domain", "lang"],
    ).select(
        "domain", "lang", "source", "n_docs", "n_tokens", "cap", F.col("got").alias("n_budget")
    )


def mixed(docs: DataFrame, plan: Plan = PLAN, epoch: str = "epoch", tokens: str = "n_tokens"):
    """The rows the budgets buy, once per epoch they are read in, with epoch and tokens.

    A document is read in an epoch if the documents before it in that epoch's order leave
    some of the leaf's budget, so the last one may overrun it. Documents without a token
    come with the prefix they stand in. Rows that agree in id and text stand at one place
    of the order and are read together. Other columns come through unchanged, whatever
    their names; given columns called ``epoch`` or ``tokens`` give way to the results.
    """
    prepare(docs.sparkSession)
    given, name = numbered(docs)
    leaves = _leaves(given, plan, *[name(c) for c in ("lang", "source", "text")])
    level = ["__domain", "__lang", "__source"]
    counted = stored(_budgets(leaves, plan), "budgets")
    # Whole epochs need no order; the epoch that the budget ends in needs a prefix.
    parts = counted.where("n_budget > 0").select(
        *[F.col(c).alias(f"__{c}") for c in LEVELS],
        F.floor(F.col("n_budget") / F.col("n_tokens")).cast("int").alias("__whole"),
        (F.col("n_budget") % F.col("n_tokens")).alias("__rest"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / RANGE_ROWS)).cast("bigint").alias("__ranges"),
    )
    whole, text = F.col("__whole").cast("string"), F.coalesce(name("text"), F.lit(""))
    at = _order(plan, whole, F.col(name("doc_id")), text)
    # The joined tables have a row per leaf and are stored, so Spark knows their size: they
    # are broadcast while they are small, else a hot leaf is split.
    placed = (
        leaves.join(parts, level)
        .withColumn("__at", at)
        .withColumn("__range", F.floor(F.col("__at") / F.lit(1 << 60) * F.col("__ranges")))
    )
    ranges = placed.groupBy(*level, "__range").agg(
        F.sum("__n").alias("__sum"), F.first("__rest").alias("__rest")
    )
    before = Window.partitionBy(*level).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    opened = stored(
        ranges.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .where("__before < __rest")
        .select(*level, "__range", "__sum", "__before", "__rest"),
        "ranges",
    )
    # The place in its range that the budget ends at, from ids and counts alone.
    last = opened.where("__before + __sum >= __rest").drop("__sum")
    inside = (
        placed.select(*level, "__range", "__at", "__n")
        .join(last, [*level, "__range"])
        .groupBy(*level, "__at", "__before", "__rest")
        .agg(F.sum("__n").alias("__n"))
    )
    upto = Window.partitionBy(*level).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        inside.withColumn("__upto", F.col("__before") + F.coalesce(F.sum("__n").over(upto), F.lit(0)))
        .where("__upto < __rest")
        .groupBy(*level)
        .agg(F.max("__at").alias("__end"))
    )
    ends = stored(ends, "ends")
    marked = placed.join(ends, level, "left")
    reads = F.when(
        (F.col("__rest") > 0) & (F.col("__at") <= F.col("__end")), F.col("__whole") + 1
    ).otherwise(F.col("__whole"))
    each = F.explode(F.sequence(F.lit(0), reads - 1))
    return (
        marked.where(reads > 0)
        .withColumn("__epoch", each)
        .select(
            *[F.col(name(c)).alias(c) for c in docs.columns if c not in (epoch, tokens)],
            F.col("__epoch").alias(epoch),
            F.col("__n").alias(tokens),
        )
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select("doc_id", "lang", "source", "epoch", "n_tokens")


def _case(column: str, values: dict, other) -> str:
    told = lambda v: str(v) if isinstance(v, int) else f"'{v}'"
    return (
        f"CASE {column} "
        + " ".join(f"WHEN '{k}' THEN {told(v)}" for k, v in values.items())
        + f" ELSE {told(other)} END"
    )


def _sql_level(name: str, nodes: str, parent: str, columns: str) -> str:
    """One level of the tree: children of ``nodes`` (with cap, weight, budget) and their got."""
    part = f"PARTITION BY {parent}" if parent else ""
    tie = columns
    return f"""
{name}_left AS (
  SELECT *, budget - coalesce(sum(cap) OVER ({part} ORDER BY cap / weight, {tie}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(weight) OVER ({part}) - coalesce(sum(weight) OVER ({part} ORDER BY cap / weight, {tie}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rst
  FROM ({nodes})),
{name}_full AS (SELECT *, cap::HUGEINT * rst <= lft::HUGEINT * weight AS is_full FROM {name}_left),
{name} AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE
      ((budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part}))::HUGEINT * weight
       // sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}))::BIGINT END AS got
  FROM {name}_full)"""


def sql(plan: Plan = PLAN) -> str:
    sources = {s: d for d, group in plan.domains.items() for s in group}
    order = (
        "('0x' || substr(md5(concat_ws(':', '{seed}', w.whole::VARCHAR, "
        "coalesce(l.doc_id::VARCHAR, ''), md5(coalesce(l.text, '')))), 1, 15))::BIGINT"
    ).format(seed=plan.seed)
    return f"""
WITH leaves AS (
  SELECT doc_id, text, lang AS own_lang, source AS own_source,
    {_case("source", sources, plan.other_domain)} AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n
  FROM documents),
lvl AS (
  SELECT domain, lang, source, sum(n)::BIGINT AS n_tokens,
    (sum(n) * {plan.epochs})::BIGINT AS cap
  FROM leaves GROUP BY ALL),
whole AS (SELECT floor(sum(n_tokens) * {plan.share} / 1000)::BIGINT AS budget FROM lvl),
{_sql_level("d", f'''SELECT domain, sum(cap)::BIGINT AS cap, (SELECT budget FROM whole) AS budget,
    {_case("domain", plan.domain_weights, plan.other)} AS weight FROM lvl GROUP BY domain''', "", "domain")},
{_sql_level("g", f'''SELECT lvl.domain, lang, sum(lvl.cap)::BIGINT AS cap, max(d.got) AS budget,
    {_case("lang", plan.lang_weights, plan.other)} AS weight
    FROM lvl JOIN d USING (domain) GROUP BY lvl.domain, lang''', "domain", "domain, lang")},
{_sql_level("s", f'''SELECT lvl.domain, lvl.lang, source, n_tokens, lvl.cap, g.got AS budget,
    {_case("source", plan.source_weights, plan.other)} AS weight
    FROM lvl JOIN g ON g.domain = lvl.domain AND g.lang = lvl.lang''', "domain, lang", "domain, lang, source")},
w AS (
  SELECT domain, lang, source, got // n_tokens AS whole, got % n_tokens AS rest
  FROM s WHERE got > 0),
placed AS (
  SELECT l.*, w.whole, w.rest, {order} AS place
  FROM leaves l JOIN w USING (domain, lang, source)),
run AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY domain, lang, source ORDER BY place
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM placed),
reads AS (
  SELECT *, whole + CASE WHEN rest > 0 AND before < rest THEN 1 ELSE 0 END AS n_reads FROM run)
SELECT doc_id, own_lang AS lang, own_source AS source, e.epoch::INT AS epoch, n AS n_tokens
FROM reads, LATERAL (SELECT unnest(generate_series(0, n_reads - 1)) AS epoch) e
WHERE n_reads > 0"""
