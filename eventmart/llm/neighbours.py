"""Approximate nearest neighbours by largest inner product.

One more component makes all vectors equally long, so that the largest inner product is the
least Euclidean distance. A few Gaussian (2-stable) projections of a vector at distance d lie
at a squared projected distance of d² times a chi-square variable. A kd-tree of the projections
gives a query's neighbours in growing projected distance; each is verified with its
original vector. The search stops once the chi-square distribution makes it unlikely enough
that anything nearer than the k-th best so far lies farther out.

The top of the tree, fitted on a bounded sample, deals all vectors into cells, and a cell of
many (or equal) vectors into shards by row. A task holds one shard, its own lower tree, and a
block of the queries that reach its cell; nothing grows with the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import field, runs_on_executors, written
from eventmart.session import small_frame

runs_on_executors(__name__)

NEIGHBOURS = 20
PROJECTIONS = 8
CERTAINTY = 0.97
SHARD_ROWS = 1024
QUERY_ROWS = 1024
SAMPLE_ROWS = 8192
MOST_CELLS = 1024
LEAF_ROWS = 64
#: Lists of results that are merged in one row.
MERGED = 64
SEED = 11
#: Share of the squared length that rounding may add to a squared distance.
SLACK = 1e-9


def chi_square(certainty: float, degrees: int) -> float:
    """The quantile of the chi-square distribution, for an even number of degrees."""

    def below(x):
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(80):
        low, high = ((low + high) / 2, high) if below((low + high) / 2) < certainty else (low, (low + high) / 2)
    return high


def directions(size: int, count: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size + 1, count))


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes them as long as the longest."""
    return np.column_stack((x, np.sqrt(np.maximum(0, longest**2 - (x * x).sum(1)))))


def split(points: np.ndarray, rows: int, most: int = 1 << 30) -> list[np.ndarray]:
    """A kd-tree's leaves as arrays of row numbers: halves along the widest direction."""
    leaves, left = [], [np.arange(len(points))]
    while left:
        own = left.pop()
        if len(own) > rows and len(leaves) + len(left) + 2 <= most:
            values = points[own]
            widest = np.ptp(values, axis=0).argmax()
            order = own[np.argsort(values[:, widest], kind="stable")]
            left += [order[: len(own) // 2], order[len(own) // 2 :]]
        else:
            leaves.append(own)
    return leaves


def top_tree(sample: np.ndarray, rows: float, most: int) -> list[tuple[int, float, int, int]]:
    """Nodes (direction, border, below, above) of the upper tree; -1 - n stands for cell n."""
    nodes: list[tuple[int, float, int, int]] = []
    cells = 0

    def grow(own: np.ndarray, allowed: int) -> int:
        nonlocal cells
        if allowed > 1 and len(own) > rows:
            for widest in np.ptp(own, axis=0).argsort()[::-1]:
                border = float(np.median(own[:, widest]))
                under = own[:, widest] < border
                if under.any() and not under.all():
                    at = len(nodes)
                    nodes.append((0, 0.0, 0, 0))
                    below = grow(own[under], allowed // 2)
                    nodes[at] = (int(widest), border, below, grow(own[~under], allowed - allowed // 2))
                    return at
        cells += 1
        return -cells

    grow(sample, most)
    return nodes


def cell_of(points: np.ndarray, nodes: list) -> np.ndarray:
    """The cell of each point."""
    cell = np.zeros(len(points), np.int64)
    left = [(0, np.arange(len(points)))] if nodes else []
    while left:
        node, own = left.pop()
        if node < 0:
            cell[own] = -1 - node
        else:
            direction, border, below, above = nodes[node]
            under = points[own, direction] < border
            left += [(below, own[under]), (above, own[~under])]
    return cell


def squared_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """From each point to each box: (points x boxes)."""
    out = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        own = points[:, k : k + 1]
        out += np.maximum(0, np.maximum(low[:, k] - own, own - high[:, k])) ** 2
    return out


def search(x, ids, projected, queries, query_ids, query_projected, worst, longest, limit, k):
    """Best (ids, scores) of each query among the rows of one shard.

    ``worst`` holds the squared distance that a neighbour must not exceed, as far as known; what
    exceeds it is left out.
    """
    leaves = split(projected, LEAF_ROWS)
    low = np.stack([projected[own].min(0) for own in leaves])
    high = np.stack([projected[own].max(0) for own in leaves])
    away = squared_distance(query_projected, low, high)
    order = away.argsort(1, kind="stable")
    worst = worst.copy()
    found_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    found = np.full((len(queries), k), -np.inf)
    base = (queries * queries).sum(1) + longest**2
    going = np.arange(len(queries))
    slack = SLACK * longest**2
    for step in range(len(leaves)):
        going = going[away[going, order[going, step]] <= limit * worst[going] + slack]  # the stopping test
        if not len(going):
            break
        next_leaf = order[going, step]
        for leaf in np.unique(next_leaf):
            who, own = going[next_leaf == leaf], leaves[leaf]
            # a matrix product tells which pairs can be among the k best so far, only these are scored
            near = queries[who] @ x[own].T >= ((base[who] - worst[who]) / 2 - slack)[:, None]
            near &= ids[own][None, :] != query_ids[who][:, None]
            who, near = who[near.any(1)], near[near.any(1)]
            if not len(who):
                continue
            one, other = np.nonzero(near)
            scores = np.full(near.shape, -np.inf)
            scores[one, other] = (queries[who[one]] * x[own[other]]).sum(1)
            all_scores = np.concatenate((found[who], scores), 1)
            all_ids = np.concatenate((found_ids[who], np.broadcast_to(ids[own], scores.shape)), 1)
            best = np.lexsort((all_ids, -all_scores))[:, :k]
            found[who] = np.take_along_axis(all_scores, best, 1)
            found_ids[who] = np.take_along_axis(all_ids, best, 1)
            last = found[who, -1]
            worst[who] = np.minimum(worst[who], np.where(np.isfinite(last), np.maximum(0, base[who] - 2 * last), np.inf))
    return found_ids, found


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = NEIGHBOURS,
    projections: int = PROJECTIONS,
    certainty: float = CERTAINTY,
    shard_rows: int = SHARD_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found of every query row.

    Candidates are all rows but those of the query's own id. Scores are inner products of the
    original vectors in double precision; ties go to the smaller id. Vectors that are null, empty, zero
    or hold null or non-finite components, rows with a null id, and vectors of another length
    than the commonest (the longer of two equally common) take no part. A row repeated among
    the candidates is found as often; queries repeated with one id are asked once, with the
    smallest of their vectors. A table without usable rows gives an empty result. The tree's
    top is fitted on at most ``sample_rows`` rows; all rows are indexed.
    """
    if projections % 2:
        raise ValueError("projections must be even")
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    asked = is_query.alias("asked")
    usable = vectors.select(field(vec_id).cast("long").alias("id"), field(embedding).cast("array<double>").alias("x"), asked)
    usable = usable.where(_usable(F.col("x")) & F.col("id").isNotNull())
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    sizes = usable.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if top is None:
        return small_frame(spark, [], "query_id long, vec_id long").select(
            "query_id", F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    size, n, longest = top["size"], top["n"], math.sqrt(top["square"]) * (1 + 1e-12)
    limit = chi_square(certainty, projections)
    usable = usable.where(F.size("x") == size)

    @F.arrow_udf("array<double>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        basis = directions(size, projections)
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield pa.array(list(lengthened(x, longest) @ basis), pa.list_(pa.float64()))

    sample = usable.orderBy(F.xxhash64("id"), "id", "x").limit(sample_rows).select("x")
    points = np.array([r["x"] for r in sample.collect()])
    points = lengthened(points, longest) @ directions(size, projections)
    wanted = max(1, min(MOST_CELLS, round(n / shard_rows)))
    nodes = top_tree(points, max(len(points) / wanted, 4), wanted)

    @F.arrow_udf("long")
    def cell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(cell_of(batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, projections), nodes))

    indexed = usable.select("id", "x", "asked", project("x").alias("p")).withColumn("cell", cell("p"))
    indexed = written(indexed.withColumn("row", F.monotonically_increasing_id()), "vectors")
    borders = [f(F.get("p", F.lit(i))).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(projections)]
    cells = sorted(indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *borders).collect())
    low = np.array([[c[f"min{i}"] for i in range(projections)] for c in cells])
    high = np.array([[c[f"max{i}"] for i in range(projections)] for c in cells])
    numbers = np.array([c["cell"] for c in cells])
    shards = {c["cell"]: -(-c["n"] // shard_rows) for c in cells}

    @F.arrow_udf("array<double>")
    def project_query(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        basis = directions(size, projections)[:-1]
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            yield pa.array(list(x @ basis), pa.list_(pa.float64()))

    @F.arrow_udf("array<long>")
    def reached(p: pa.Array, worst: pa.Array) -> pa.Array:
        at = p.flatten().to_numpy(zero_copy_only=False).reshape(-1, projections)
        away = squared_distance(at, low, high)
        own = worst.to_numpy(zero_copy_only=False)
        # nothing known yet: the nearest cell only
        near = np.where(np.isnan(own)[:, None], away == away.min(1, keepdims=True), away <= limit * own[:, None] + SLACK * longest**2)
        return pa.array([numbers[r] for r in near], pa.list_(pa.int64()))

    queries = usable.where("asked").groupBy("id").agg(F.min("x").alias("x")).select(F.col("id").alias("query_id"), F.col("x").alias("q"))
    queries = written(queries.withColumn("qp", project_query("q")), "queries")
    starts = np.cumsum([0, *shards.values()]).tolist()
    # MOST_CELLS rows at most
    deal = small_frame(spark, [(c, s, at) for (c, s), at in zip(shards.items(), starts, strict=False)], "cell long, shards long, start long")

    def visit(asking: DataFrame, first_only: bool) -> DataFrame:
        """(query_id, part, best): each query's best of every shard it reaches."""
        wide = asking.withColumn("cell", F.explode(reached("qp", "worst"))).join(F.broadcast(deal), "cell")
        busy = [(r["cell"], -(-r["n"] // QUERY_ROWS)) for r in wide.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()]
        blocks = small_frame(spark, busy, "cell long, blocks long")
        last = F.lit(0).cast("long") if first_only else F.col("shards") - 1
        wide = wide.join(F.broadcast(blocks), "cell").select(
            "query_id", "q", "qp", "worst", "cell",
            F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("shard"),
            F.pmod(F.xxhash64("query_id"), "blocks").alias("block"), "start",
        ).withColumn("part", F.col("start") + F.col("shard"))
        shard = F.pmod(F.xxhash64("row"), "shards").alias("shard")
        held = indexed.join(F.broadcast(deal), "cell").join(F.broadcast(blocks), "cell").select(
            "id", "x", "p", "cell", shard, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        )
        if first_only:
            held = held.where("shard = 0")

        def best(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
            if not len(rows) or not len(asks):
                return pd.DataFrame({"query_id": [], "part": [], "best": []})
            worst = asks["worst"].to_numpy(float)
            ids, scores = search(
                np.stack(rows["x"]), rows["id"].to_numpy(), np.stack(rows["p"]), np.stack(asks["q"]), asks["query_id"].to_numpy(),
                np.stack(asks["qp"]), np.where(np.isnan(worst), np.inf, worst), longest, limit, k,
            )
            lists = [[{"away": -s, "id": i} for s, i in zip(a, b, strict=True) if s > -np.inf] for a, b in zip(scores, ids, strict=True)]
            return pd.DataFrame({"query_id": asks["query_id"], "part": asks["part"], "best": lists})

        keys = ["cell", "shard", "block"]
        return held.groupBy(*keys).cogroup(wide.groupBy(*keys)).applyInPandas(best, "query_id long, part long, best array<struct<away: double, id: long>>")

    def merged(found: DataFrame) -> DataFrame:
        """(query_id, best): the k best of all parts; no row ever holds the lists of more than ``MERGED`` parts."""
        left = sum(shards.values())
        while True:
            best = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
            found = found.groupBy("query_id", F.floor(F.col("part") / MERGED).alias("part")).agg(best)
            left = -(-left // MERGED)
            if left <= 1:
                return found.select("query_id", "best")

    base = F.aggregate("q", F.lit(longest**2), lambda a, v: a + v * v)
    first = visit(queries.withColumn("worst", F.lit(None).cast("double")), True)
    kth = -F.get("best", F.lit(k - 1))["away"]
    known = written(first.groupBy("query_id").agg(F.max(F.when(F.size("best") >= k, kth)).alias("kth")), "bounds")
    bounded = queries.join(known, "query_id", "left").withColumn(
        "worst", F.when(F.col("kth").isNull(), float("inf")).otherwise(F.greatest(F.lit(0.0), base - 2 * F.col("kth")))
    )
    ranked = merged(visit(bounded, False)).select("query_id", F.posexplode("best").alias("place", "hit"))
    return ranked.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.away")).alias("score")
    ).to(T.StructType.fromDDL(schema))
