"""Approximate nearest neighbours over learned partitions.

On a bounded sample the exact neighbour graph is built and cut into parts of equal size
by passes of label propagation with a capacity, so that neighbours share a part. A small
network learns which parts hold a vector's neighbours. It places every row in its most
probable part and routes a query to as many of its most probable parts as the sample
needs for its recall. There every vector is compared exactly, in double precision.

Only the sample is bounded; every row is indexed. The number of parts grows with the table
as far as the sample can tell them apart. Parts are split into shards of a few thousand
rows, to which a query is sent alike, and a part's queries into blocks of a few thousand, so
a task holds one block and one shard however hot the part is. A query that finds too few
rows in its parts is sent on to all others. Vectors are compared with those of their own
length: each of the most frequent lengths has a router, any other length is one part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import prepare, stored

NEIGHBOURS = 20
SAMPLE = 8000  # vectors the graph is built on, at most
PARTS = 16  # at least; one more for every PART_ROWS rows, as long as the sample suffices
PART_ROWS = 800
ROUTERS = 16  # lengths with a router of their own
HIDDEN = 64
RECALL = 0.97  # of the held-out sample queries, aimed at when routing
SHARD_ROWS = 4000
BLOCK_QUERIES = 4000


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products in double precision, added up in the order of the components."""
    out = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        out += a[:, k, None] * b[None, :, k]
    return out


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out."""
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 512):
        score = x[s : s + 512] @ x.T
        score[np.arange(len(score)), np.arange(s, s + len(score))] = -np.inf
        out[s : s + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    Starts from balanced assignment to seeded centres; then vertices move to the part
    most of their neighbours are in, best gains first, while that part has room.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    room = -(-n // parts)
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(8):
        score = x @ centres.T
        part = _fill(score, room)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, x)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cap = int(np.ceil(1.05 * room))
    for _ in range(12):
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        # Edges count both ways.
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if sizes[best[i]] < cap and rng.random() < 0.7:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 200:
            break
    return part


def _fill(score: np.ndarray, room: int) -> np.ndarray:
    """Each row to its best column with room, rows with the most to lose first."""
    order = np.argsort(-score, axis=1)
    first = np.take_along_axis(score, order[:, :1], 1) - np.take_along_axis(score, order[:, -1:], 1)
    left = np.full(score.shape[1], room)
    out = np.empty(len(score), np.int64)
    for i in np.argsort(-first[:, 0], kind="stable").tolist():
        for c in order[i].tolist():
            if left[c]:
                left[c] -= 1
                out[i] = c
                break
    return out


@dataclass
class Router:
    """A network with one hidden layer, and the number of parts a query is sent to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def parts(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def _train(x: np.ndarray, target: np.ndarray, seed: int = 3) -> Router:
    """Cross entropy against the share of neighbours in each part, by Adam."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    w = [
        rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for epoch in range(40):
        rate = 0.01 if epoch < 25 else 0.002
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            step += 1
            a, y = x[rows], target[rows]
            h = np.maximum(a @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - y) / len(rows)
            dh = (dz @ w[2].T) * (h > 0)
            for k, g in enumerate((a.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8
                )
    return Router(*w, probes=parts)


def learn(x: np.ndarray, parts: int = PARTS, k: int = NEIGHBOURS) -> Router | None:
    """A router from sample vectors; None if they are too few to part (100 for each)."""
    parts = min(parts, len(x) // 100)
    if parts < 2:
        return None
    graph = neighbour_graph(x, k)
    part = balanced_parts(x, graph, parts)
    share = np.zeros((len(x), parts))
    np.add.at(share, (np.repeat(np.arange(len(x)), k), part[graph].ravel()), 1 / k)
    share = 0.8 * share
    share[np.arange(len(x)), part] += 0.2  # a row belongs where its own part is
    # A tenth is held out: does routing find the parts its neighbours are placed in?
    held = np.arange(len(x)) % 10 == 0
    router = _train(x[~held], share[~held])
    placed = router.parts(x)
    home = placed[:, 0]
    rank = np.argsort(placed[held], axis=1)  # rank of each part for each query
    reached = np.take_along_axis(rank, home[graph[held]], axis=1)
    recall = [(reached < probes).mean() for probes in range(1, parts + 1)]
    router.probes = next((i + 1 for i, r in enumerate(recall) if r >= RECALL), parts)
    return router


def usable(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """Rows with an id and a vector of finite components that are not all zero."""
    good = F.coalesce(
        F.forall(
            name,
            lambda v: F.coalesce(
                ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))) & v.isNotNull(), F.lit(False)
            ),
        )
        & F.exists(name, lambda v: v != 0),
        F.lit(False),
    )
    return vectors.where(good & F.col("vec_id").isNotNull())


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def search(vectors: DataFrame, k: int = NEIGHBOURS, every: int = 20) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``; candidates of a query are
    all rows but itself whose vectors have its length. Ties go to the smaller vec_id. Rows
    with a null id, and vectors that are null, zero or hold null or non-finite components,
    take no part. Rows that repeat an id are rows of their own: each is a candidate, of the
    others of its id too, and each asks, so such an id has as many answers of ``k`` rows. Fewer
    than ``k`` candidates give as many rows; an empty table gives none. With too few vectors
    to part, all are compared.
    """
    spark = prepare(vectors.sparkSession)
    good = usable(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"))
    good = stored(
        good.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "embedding",
            F.size("embedding").alias("d"),
        ),
        "vectors",
    )
    lengths = stored(good.groupBy("d").agg(F.count(F.lit(1)).alias("n")), "lengths")
    routers: dict[int, Router] = {}
    for d, n in lengths.orderBy(F.desc("n"), "d").limit(ROUTERS).collect():
        same = good.where(F.col("d") == d).orderBy(F.xxhash64("vec_id", "row"), "row")
        some = same.select("embedding").limit(SAMPLE).toPandas()  # bounded
        sample = np.array(some["embedding"].tolist(), np.float64)
        near = min(k, max(1, len(sample) - 1))
        router = learn(sample, max(PARTS, n // PART_ROWS), near)
        if router is not None:
            routers[d] = router
    shared = spark.sparkContext.broadcast(routers)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            sizes, ids = batch.column("d").to_numpy(), batch.column("vec_id").to_numpy()
            # A length's parts are numbered from a base of its own.
            base = sizes.astype(np.int64) << 20
            routes = list(base[:, None])
            probes = np.ones(batch.num_rows, np.int32)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                router = own.get(d)
                if router is None:
                    continue
                order = router.parts(_matrix(batch.column("embedding").take(pa.array(at))))
                probes[at] = router.probes
                for i, parts in zip(at.tolist(), order.astype(np.int64)):
                    # A query knows all parts in their order, another row only its own.
                    routes[i] = base[i] + (parts if ids[i] % every == 0 else parts[:1])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in routes])]).astype(np.int32)
            flat = np.concatenate(routes) if routes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(probes)],
                names=["row", "vec_id", "embedding", "d", "routes", "probes"],
            )

    kind = good.schema["embedding"].dataType.simpleString()
    routed = stored(
        good.mapInArrow(
            route,
            f"row bigint, vec_id bigint, embedding {kind}, d int, routes array<bigint>, probes int",
        ),
        "routed",
    )
    asked = routed.where(F.col("vec_id") % every == 0)
    # First the most probable part alone. Its k-th score is a floor for the others: what lies
    # below it cannot be among the k, so of most parts only a few rows are sent.
    no_floor = F.lit(float("-inf"))
    head = asked.withColumns({"go": F.slice("routes", 1, 1), "floor": no_floor})
    near = stored(_best(_compared(routed, head, k), k), "near")
    floors = near.groupBy("query").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).alias("floor")
    )
    tail = (
        asked.join(floors, F.col("row") == F.col("query"), "left")
        .withColumn("go", F.slice("routes", F.lit(2), F.col("probes") - 1))
        .select(*asked.columns, "go", F.coalesce("floor", no_floor).alias("floor"))
    )
    farther = _compared(routed, tail, k)
    found = stored(_best(near.drop("rank").unionByName(farther), k), "found")
    # Queries that found fewer than there are go to their remaining parts too.
    counts = found.groupBy("query").agg(F.count(F.lit(1)).alias("has"))
    short = (
        asked.where(F.size("routes") > F.col("probes"))
        .join(lengths, "d")
        .join(counts, F.col("row") == F.col("query"), "left")
        .where(F.coalesce("has", F.lit(0)) < F.least(F.lit(k), F.col("n") - 1))
        .select(*asked.columns)
    )
    if short.take(1):
        rest = F.slice("routes", F.col("probes") + 1, F.size("routes"))
        more = _compared(routed, short.withColumns({"go": rest, "floor": no_floor}), k)
        found = _best(found.drop("rank").unionByName(more), k)
    return found.select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _compared(routed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every part a query goes to: query, query_id, row, vec_id, score.

    ``asked`` has the parts in ``go`` and in ``floor`` the score below which none counts.
    Parts of different lengths are different parts.
    """
    home = F.col("routes")[0].alias("part")
    sizes = routed.groupBy(home).agg(F.count(F.lit(1)).alias("n"))
    sent = asked.select(F.explode("go").alias("part")).groupBy("part")
    loads = sent.agg(F.count(F.lit(1)).alias("q"))
    # One row per part. A part without rows answers nothing.
    cuts = stored(
        sizes.join(loads, "part").select(
            "part",
            F.ceil(F.col("n") / SHARD_ROWS).alias("shards"),
            F.ceil(F.col("q") / BLOCK_QUERIES).alias("blocks"),
        ),
        "cuts",
    )

    def numbers(count: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    members = (
        routed.select("row", "vec_id", "embedding", home)
        .join(cuts, "part")
        .withColumn("shard", F.pmod(F.xxhash64("row"), "shards"))
        .select("row", "vec_id", "embedding", "part", "shard", numbers("blocks").alias("block"))
    )
    queries = (
        asked.select(
            F.col("row").alias("query"), F.col("vec_id").alias("query_id"),
            F.col("embedding").alias("vector"), "floor", F.explode("go").alias("part"),
        )
        .join(cuts, "part")
        .withColumn("block", F.pmod(F.xxhash64("query"), "blocks"))
        .select(
            "query", "query_id", "vector", "floor", "part", numbers("shards").alias("shard"), "block"
        )
    )

    def compare(asked: pa.Table, own: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "row": [], "vec_id": [], "score": []}
        if asked.num_rows and own.num_rows:
            own = own.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()
            rows, ids = own.column("row").to_numpy(), own.column("vec_id").to_numpy()
            have = _matrix(own.column("embedding").combine_chunks())
            for s in range(0, asked.num_rows, 256):
                some = asked.slice(s, 256).combine_chunks()
                query, query_id = some.column("query").to_numpy(), some.column("query_id").to_numpy()
                score = inner(_matrix(some.column("vector").combine_chunks()), have)
                score[query[:, None] == rows[None, :]] = -np.inf  # itself
                # Stable: equal scores stay in the order of their ids.
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                value = np.take_along_axis(score, best, 1)
                real = query[:, None] != rows[best]
                real &= value >= some.column("floor").to_numpy()[:, None]
                each = real.sum(axis=1)
                out["query"].append(np.repeat(query, each))
                out["query_id"].append(np.repeat(query_id, each))
                out["row"].append(rows[best[real]])
                out["vec_id"].append(ids[best[real]])
                out["score"].append(value[real])
        return pa.table(
            {
                c: pa.array(
                    np.concatenate(v) if v else [], pa.float64() if c == "score" else pa.int64()
                )
                for c, v in out.items()
            }
        )

    key = ["part", "shard", "block"]
    return (
        queries.groupBy(*key)
        .cogroup(members.groupBy(*key))
        .applyInArrow(
            compare, "query bigint, query_id bigint, row bigint, vec_id bigint, score double"
        )
    )
