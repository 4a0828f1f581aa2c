"""Exact top-k search by integer inner product with an M-tree.

One more component, the square root of what a vector's squared length lacks to the longest one's,
makes the largest inner product the least Euclidean distance: d² = L² + |q|² - 2 q·v. So the
triangle inequality holds. The tree is a table of pages. A page has a routing vector, a
covering radius (the farthest vector below it) and its distance to the routing vector of its
parent; a leaf keeps its vectors with their distances to its routing vector.

The root's entries, routing vectors from a bounded sample, deal all vectors into cells, and a cell of
many (or equal) vectors into shards; each shard's pages are built in one task and written. A
search visits the pages in growing lower bound d(q, routing) - radius and ends where that
exceeds the k-th best distance. A child or a vector is skipped without a distance computation
if |d(q, routing) - its parent distance| shows already that it is too far. Bounds only decide
what is looked at, with some slack for rounding; scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import field, runs_on_executors, written
from eventmart.session import small_frame

runs_on_executors(__name__)

NEIGHBOURS = 5
SCALE = 256
PAGE = 64
FANOUT = 16
SHARD_ROWS = 4096
QUERY_ROWS = 2048
SAMPLE_ROWS = 8192
MOST_CELLS = 1024
SEED = 17
#: Share of the longest distance by which rounding may shift a bound.
SLACK = 1e-6
#: Sums of integers below this are exact in double precision, in whatever order.
EXACT = 1 << 53

RESULT = "query_id long, rank int, vec_id long, score long"
PAGES = (
    "cell long, shard long, page long, parent long, leaf boolean, routing array<double>, radius double, "
    "parent_distance double, ids array<long>, vectors array<double>, distances array<double>"
)


def lengthened(x: np.ndarray, square: float) -> np.ndarray:
    """Vectors with the component that makes them all as long as the square root of ``square``."""
    return np.column_stack((x, np.sqrt(np.maximum(0, square - (x * x).sum(1)))))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0, square))


def build(x: np.ndarray, ids: np.ndarray, square: float, page_rows: int = PAGE) -> list[dict]:
    """The pages of one shard, root first. Every page's routing vector is one of its vectors."""
    points = lengthened(x, square)
    rng = np.random.default_rng(SEED)
    pages: list[dict] = []
    left = [(np.arange(len(x)), 0, -1)]  # rows, routing row, parent page
    while left:
        own, routing, parent = left.pop()
        away = distances(points[own], points[routing : routing + 1])[:, 0]
        up = 0.0 if parent < 0 else float(distances(points[[routing]], np.array([pages[parent]["routing"]]))[0, 0])
        leaf = len(own) <= page_rows
        page = {
            "page": len(pages), "parent": parent, "leaf": leaf, "routing": points[routing], "radius": float(away.max()),
            "parent_distance": up, "ids": ids[own] if leaf else [], "vectors": x[own].ravel() if leaf else [],
            "distances": away if leaf else [],
        }
        pages.append(page)
        if leaf:
            continue
        picked = rng.choice(own, min(FANOUT, -(-len(own) // page_rows)), replace=False)
        nearest = distances(points[own], points[picked]).argmin(1)
        groups = [own[nearest == k] for k in range(len(picked))]
        if max(map(len, groups)) == len(own):  # vectors that no distance tells apart
            groups = np.array_split(own, len(picked))
            picked = np.array([g[0] for g in groups])
        left += [(g, r, page["page"]) for g, r in zip(groups, picked, strict=True) if len(g)]
    return pages


def _products(q: np.ndarray, x: np.ndarray, exact_in_doubles: bool) -> np.ndarray:
    if exact_in_doubles:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def search(pages, queries, query_ids, bound, square, k, exact_in_doubles=True):
    """Best (ids, scores) of each query below one root; no score yet is the least integer.

    ``bound`` holds the distance that a neighbour must not exceed, as far as known. Also
    returns how many vectors were compared, for tests.
    """
    size = queries.shape[1]
    children: dict[int, list[int]] = {}
    for p in pages:
        children.setdefault(p["parent"], []).append(p["page"])
    routing = np.stack([p["routing"] for p in pages])
    radius = np.array([p["radius"] for p in pages])
    up = np.array([p["parent_distance"] for p in pages])
    held = [np.asarray(p["vectors"], float).reshape(-1, size) if p["leaf"] else None for p in pages]
    asked = np.column_stack((queries, np.zeros(len(queries))))
    lengths = (queries * queries).sum(1) + square  # exact integers
    slack = SLACK * np.sqrt(lengths + square)
    bound = bound + slack
    none = np.iinfo(np.int64).min
    found = np.full((len(queries), k), none)
    found_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    low = np.full((len(queries), len(pages)), np.inf)  # of the pages that wait
    away = np.zeros((len(queries), len(pages)))
    away[:, 0] = distances(asked, routing[:1])[:, 0]
    low[:, 0] = away[:, 0] - radius[0]
    compared = 0
    going = np.arange(len(queries))
    while len(going):
        nearest = low[going].argmin(1)
        least = low[going, nearest]
        goes = np.isfinite(least) & (least <= bound[going])
        going, nearest = going[goes], nearest[goes]
        low[going, nearest] = np.inf  # visited
        for page in np.unique(nearest):
            who = going[nearest == page]
            if not pages[page]["leaf"]:
                below = np.array(children[page])
                near = np.abs(away[who, page][:, None] - up[below]) - radius[below] <= bound[who][:, None]
                for c, ask in zip(below, near.T, strict=True):
                    some = who[ask]
                    if len(some):
                        away[some, c] = distances(asked[some], routing[c : c + 1])[:, 0]
                        low[some, c] = away[some, c] - radius[c]
                continue
            own, own_ids = held[page], np.asarray(pages[page]["ids"])
            near = np.abs(away[who, page][:, None] - np.asarray(pages[page]["distances"])[None, :]) <= bound[who][:, None]
            near &= own_ids[None, :] != query_ids[who][:, None]
            some = np.flatnonzero(near.any(0))
            if not len(some):
                continue
            compared += int(near.sum())
            scores = np.where(near[:, some], _products(queries[who], own[some], exact_in_doubles), none)
            scores = np.concatenate((found[who], scores), 1)
            ids = np.concatenate((found_ids[who], np.broadcast_to(own_ids[some], (len(who), len(some)))), 1)
            ids[scores == none] = np.iinfo(np.int64).max
            best = np.lexsort((ids, -scores.astype(float) if exact_in_doubles else ~scores))[:, :k]
            found[who] = np.take_along_axis(scores, best, 1)
            found_ids[who] = np.take_along_axis(ids, best, 1)
            last = found[who, -1]
            reach = np.sqrt(np.maximum(0, lengths[who] - 2.0 * last)) + slack[who]
            bound[who] = np.minimum(bound[who], np.where(last > none, reach, np.inf))
    return found_ids, found, compared


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & finite & (F.size(vector) > 0)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = NEIGHBOURS,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the exactly ``k`` best of every query row, or all if fewer.

    A component x counts as the integer floor(``scale`` * x); scores are integer inner products,
    the largest first, ties to the smaller id. Candidates are all rows but those of the query's own id.
    Vectors that are null, empty or hold null or non-finite components, rows with a null id, and
    vectors of another length than the commonest (the longer of two equally common) take no part;
    zero vectors do. A row repeated among the candidates is found as often; queries repeated with
    one id are asked once, with the smallest of their vectors. An empty table gives an empty
    result. Raises ValueError if a score could exceed 64 bits. The root's routing vectors come from
    ``sample_rows`` rows at most; all rows are indexed.
    """
    spark = vectors.sparkSession
    usable = vectors.select(
        field(vec_id).cast("long").alias("id"), field(embedding).cast("array<double>").alias("x"), is_query.alias("asked")
    ).where(_usable(F.col("x")) & F.col("id").isNotNull())
    usable = usable.withColumn("x", F.transform("x", lambda v: F.floor(v * scale).cast("double")))
    length = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    largest = F.max(F.array_max(F.transform("x", F.abs)))
    sizes = usable.groupBy(F.size("x").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.max(length).alias("square"), largest.alias("largest")
    )
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if top is None:
        return small_frame(spark, [], "query_id long, vec_id long").select(
            "query_id", F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        )
    size, n, square = top["size"], top["n"], top["square"]
    most = size * top["largest"] ** 2
    if most >= 1 << 62:
        raise ValueError(f"components up to {top['largest']:g} give scores beyond 64 bits")
    in_doubles = most < EXACT
    usable = usable.where(F.size("x") == size)

    sample = usable.orderBy(F.xxhash64("id"), "id", "x").limit(sample_rows).select("x").collect()
    points = lengthened(np.array([r["x"] for r in sample]), square)
    points = np.unique(points, axis=0)
    wanted = max(1, min(MOST_CELLS, len(points), round(n / shard_rows)))
    pivots = points[np.random.default_rng(SEED).choice(len(points), wanted, replace=False)]

    @F.arrow_udf(T.StructType().add("cell", T.LongType()).add("away", T.DoubleType()))
    def deal_out(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            away = distances(lengthened(x, square), pivots)
            cell = away.argmin(1)
            yield pa.StructArray.from_arrays([pa.array(cell), pa.array(away.min(1))], ["cell", "away"])

    indexed = usable.select("id", "x", deal_out("x").alias("at")).select("id", "x", "at.*")
    indexed = written(indexed.withColumn("row", F.monotonically_increasing_id()), "vectors")
    cells = sorted(indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect())
    numbers = np.array([c["cell"] for c in cells])
    radius = np.array([c["radius"] for c in cells])
    routes = pivots[numbers]
    deal = small_frame(spark, [(c["cell"], -(-c["n"] // shard_rows)) for c in cells], "cell long, shards long")  # MOST_CELLS rows at most

    def paged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        pages = pd.DataFrame(build(np.stack(rows["x"]), rows["id"].to_numpy(), square))
        return pages.assign(cell=key[0], shard=key[1])[[f.split()[0] for f in PAGES.split(", ")]]

    shard = F.pmod(F.xxhash64("row"), "shards").alias("shard")
    pages = indexed.join(F.broadcast(deal), "cell").select("cell", shard, "id", "x")
    pages = written(pages.groupBy("cell", "shard").applyInPandas(paged, PAGES), "pages")
    queries = usable.where("asked").groupBy("id").agg(F.min("x").alias("q")).withColumnRenamed("id", "query_id")
    queries = written(queries, "queries")

    @F.arrow_udf("array<long>")
    def reached(q: pa.Array, bound: pa.Array) -> pa.Array:
        asked = q.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        low = distances(np.column_stack((asked, np.zeros(len(asked)))), routes) - radius
        own = bound.to_numpy(zero_copy_only=False)[:, None]
        slack = SLACK * np.sqrt((asked * asked).sum(1) + 2 * square)[:, None]
        # nothing known yet: the nearest cell only
        near = np.where(np.isnan(own), np.arange(len(numbers)) == low.argmin(1)[:, None], low <= own + slack)
        return pa.array([numbers[r] for r in near], pa.list_(pa.int64()))

    def visit(asking: DataFrame, first_only: bool) -> DataFrame:
        """(query_id, vec_id, score): each query's best of every shard it reaches."""
        wide = asking.withColumn("cell", F.explode(reached("q", "bound"))).join(F.broadcast(deal), "cell")
        busy = [(r["cell"], -(-r["n"] // QUERY_ROWS)) for r in wide.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()]
        blocks = small_frame(spark, busy, "cell long, blocks long")
        last = F.lit(0).cast("long") if first_only else F.col("shards") - 1
        wide = wide.join(F.broadcast(blocks), "cell").select(
            "query_id", "q", "bound", "cell",
            F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("shard"),
            F.pmod(F.xxhash64("query_id"), "blocks").alias("block"),
        )
        held = pages.where("shard = 0") if first_only else pages
        held = held.join(F.broadcast(blocks), "cell").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

        def best(own: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
            if not len(own) or not len(asks):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            bound = asks["bound"].to_numpy(float)
            ids, scores, _ = search(
                own.sort_values("page").to_dict("records"), np.stack(asks["q"]), asks["query_id"].to_numpy(),
                np.where(np.isnan(bound), np.inf, bound), square, k, in_doubles,
            )
            who, at = np.nonzero(scores > np.iinfo(np.int64).min)
            return pd.DataFrame({"query_id": asks["query_id"].to_numpy()[who], "vec_id": ids[who, at], "score": scores[who, at]})

        keys = ["cell", "shard", "block"]
        return held.groupBy(*keys).cogroup(wide.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score long")

    # Spark keeps k rows of a query in each task before the shuffle (a group limit), then merges these.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = ranked(visit(queries.withColumn("bound", F.lit(None).cast("double")), True))
    known = written(first.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth")), "bounds")
    far = F.aggregate("q", F.lit(float(square)), lambda a, v: a + v * v) - 2 * F.col("kth")
    bound = F.when(F.col("kth").isNull(), float("inf")).otherwise(F.sqrt(F.greatest(F.lit(0.0), far)))
    bounded = queries.join(known, "query_id", "left").select("query_id", "q", bound.alias("bound"))
    return ranked(visit(bounded, False)).select("query_id", "rank", "vec_id", "score").to(T.StructType.fromDDL(RESULT))
