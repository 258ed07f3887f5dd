"""Exact k-means over whole numbers, with a table of distances to fixed pivots.

The pivot table (LAESA) is made once: each vector with its distances to a few fixed
pivots. In every round the centroids' distances to the same pivots are known to each
task, and by the triangle inequality the largest difference between the two rows of
distances is a lower bound of the distance itself. The centroid of the smallest bound is
measured exactly; only centroids whose bound does not exceed that are measured too, in
whole numbers, so the result is that of comparing all.

A task sends one row per cluster: a count and the sums of the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import prepare, stored

SIZE = 64  # components
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
PIVOTS = 12
LARGEST = 1 << 27  # of a component, so that a squared distance fits a long
_SLACK = 1e-9  # relative; far above the rounding of square roots


def integers(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the whole numbers of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(batch.column("embedding")), size), False)
            batch = batch.filter(right)
            values = batch.column("embedding").flatten().cast(pa.float64())
            x = values.to_numpy(zero_copy_only=False).reshape(-1, size)  # a null becomes nan
            whole = np.floor(scale * x)
            good = (np.isfinite(x) & (np.abs(whole) < LARGEST)).all(axis=1)
            whole = whole[good].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(good)), lists(whole)], names=["vec_id", "v"]
            )

    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, "vec_id bigint, v array<bigint>")


def lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def roots(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Distances of every row of ``x`` to every row of ``to``."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in to], axis=1).astype(np.float64))


def far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the rows, each the farthest from those before it."""
    chosen = [0]
    near = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(rows)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def nearest(
    x: np.ndarray, table: np.ndarray, centroids: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its squared distance, and how many were measured.

    ``table`` holds the rows' distances to the pivots, ``ends`` those of the centroids.
    """
    n = len(x)
    bound = np.zeros((n, len(centroids)))
    for p in range(table.shape[1]):
        a, b = table[:, p, None], ends[None, :, p]
        np.maximum(bound, np.abs(a - b) - _SLACK * (a + b), out=bound)
    first = bound.argmin(axis=1)
    limit = ((x - centroids[first]) ** 2).sum(axis=1)
    left = bound * bound * (1 - _SLACK) <= limit[:, None]
    row, which = np.nonzero(left)
    found = np.full((n, len(centroids)), np.iinfo(np.int64).max)
    for s in range(0, len(row), 1 << 14):
        r, c = row[s : s + (1 << 14)], which[s : s + (1 << 14)]
        found[r, c] = ((x[r] - centroids[c]) ** 2).sum(axis=1)
    own = found.argmin(axis=1)  # the first of equal ones, so the smaller number
    return own, found[np.arange(n), own], len(row) + n


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector.

    Vectors that are null, of another length or hold null or non-finite components take no
    part, nor do those with a component of 2**27 or more after scaling, whose squared
    distance would leave a long. Rows that repeat an id are vectors of their own; as starts
    they come in the order of their components. A null id is hashed as an empty text. With
    fewer vectors than clusters all are starts; equal starts stay, the smaller number wins
    every tie and the other keeps its place. No vector gives no row. Further columns are not
    read.
    """
    spark = prepare(vectors.sparkSession)
    whole = integers(vectors, size, scale)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    starts = whole.orderBy(F.sha2(key, 256), "v").limit(clusters).collect()  # bounded by clusters
    if not starts:
        return spark.createDataFrame(
            [],
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string",
        )
    centroids = np.array([r["v"] for r in starts], np.int64)
    fixed = far_apart(centroids, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = lists(roots(matrix(batch.column("v"), size), fixed))
            yield pa.RecordBatch.from_arrays([*batch.columns, far], names=["vec_id", "v", "far"])

    points = stored(
        whole.mapInArrow(measure, "vec_id bigint, v array<bigint>, far array<double>"), "pivots"
    )
    for _ in range(rounds):
        centroids = moved(points, centroids, fixed)
    ends = roots(centroids, fixed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, table = matrix(batch.column("v"), size), matrix(batch.column("far"), len(fixed))
            own, distance, _ = nearest(x, table, centroids, ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(own.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    placed = stored(
        points.mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"), "placed"
    )
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(exact.alias("s")).collect()}
    total = sum(sums.values())
    about = spark.createDataFrame(  # a row per cluster
        [
            (c, s, total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c, s in sums.items()
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(about, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def moved(points: DataFrame, centroids: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; an empty one stays."""
    ends, size = roots(centroids, fixed), centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), size), np.int64)
        for batch in batches:
            x, table = matrix(batch.column("v"), size), matrix(batch.column("far"), len(fixed))
            own, _, _ = nearest(x, table, centroids, ends)
            n += np.bincount(own, minlength=len(n))
            np.add.at(sums, own, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(n[some]), lists(sums[some])],
            names=["cluster", "n", "sums"],
        )

    parts = points.select("v", "far").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    whole = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(size)]).alias("sums"),
    )
    out = centroids.copy()
    for row in whole.collect():  # a row per cluster
        out[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    return out


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE) -> str:
    """The same by comparing every vector with every centroid, for DuckDB."""
    square = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.v, c.v)])"

    def assigned(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT p.rid, p.vec_id, p.v, min({{'d': CAST({square} AS BIGINT), 'c': c.c}}) AS best
  FROM points p CROSS JOIN c{n} c GROUP BY ALL)"""

    def next_centroids(n: int) -> str:
        return f"""
m{n} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, unnest(range({size})) AS i FROM a{n}) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(x.v, o.v) AS v FROM c{n} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM m{n} GROUP BY c) x ON x.c = o.c)"""

    steps = [
        f"""
points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
    [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {size}
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)
      AND abs(floor({scale} * CAST(x AS DOUBLE))) < {LARGEST}]) = {size}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM points)
  QUALIFY c < {clusters})"""
    ]
    for n in range(rounds):
        steps += [assigned(n), next_centroids(n)]
    steps.append(assigned(rounds))
    return f"""WITH {",".join(steps)}
SELECT a.vec_id, CAST(a.best.c AS INTEGER) AS cluster, a.best.d AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.best.c"""
