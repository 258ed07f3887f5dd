"""Connected components by alternating large-star and small-star steps.

Every step reads a written edge table, so a lost executor repeats one step only. A
node's neighbours are never gathered: its smallest one comes from an aggregate that is
combined before the shuffle, and the join that hands it out may be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import stored


def _step(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b <= a")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    near = F.least("a", "m")
    out = both.join(least, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), near.alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), near.alias("b")).unionAll(
            least.select("a", near.alias("b"))
        )
    return out.where("a <> b").distinct()


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (node, root): the smallest node reachable, for every linked node.

    Links may repeat, run either way or join a node to itself. No links, no rows.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    sign = _sign(edges)
    while sign[0]:
        edges = stored(_step(_step(edges, large=True), large=False), "links")
        after = _sign(edges)
        if after == sign:
            break
        sign = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
