import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import neighbours as module
from eventmart.llm.neighbours import cell_of, chi_square, nearest, split, top_tree

VECTORS = "vec_id long, embedding array<float>, label int"
EVERY = "vec_id % 20 = 0"


def brute(rows, k=20):
    """Nearest of every twentieth row by score, then id; vectors that take no part left out."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in good:
        if q % 20 == 0:
            scored = sorted((-float(x @ v), i) for i, v in good if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(result):
    out = {}
    for r in result.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("kind", ["clusters", "noise", "lengths"])
def test_recall_against_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24))
    if kind == "clusters":
        x = x * 0.3 + rng.standard_normal((10, 24))[rng.integers(0, 10, 1500)]
    if kind == "lengths":
        x *= rng.exponential(1, (1500, 1))
    rows = [(i, [float(v) for v in r.astype(np.float32)], 0) for i, r in enumerate(x)]
    got = found(nearest(spark.createDataFrame(rows, VECTORS), F.expr(EVERY), shard_rows=100, sample_rows=500))
    want = brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    scores = {(q, i): s for q, w in brute(rows, 1500).items() for i, s in w}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, w in got.items() for i, s in w)


def test_hot_vector_ties_and_shards(spark):
    """A third of the rows are one vector: ties by id, over all shards of its cell."""
    rng = np.random.default_rng(5)
    hot = [0.5] * 8
    rows = [(i, hot if i % 3 == 0 else [float(v) for v in rng.standard_normal(8).astype(np.float32)], 1) for i in range(900)]
    got = found(nearest(spark.createDataFrame(rows, VECTORS), F.expr(EVERY), shard_rows=50, sample_rows=200))
    want = brute(rows)
    assert recall(got, want) >= 0.9
    for w in got.values():
        assert w == sorted(w, key=lambda h: (-h[1], h[0]))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0),
        (6, [inf, 1.0], 0), (7, [1.0, 2.0, 3.0], 0), (None, [5.0, 5.0], 0), (8, [2.0, 0.0], None), (9, [2.0, 0.0], 0), (9, [2.0, 0.0], 0), (20, [-1.0, 0.5], 0),
    ]
    vectors = spark.createDataFrame(rows, VECTORS)
    for c in ("x", "p", "q", "cell", "row", "rank", "score", "query_id", "asked"):
        vectors = vectors.withColumn(c, F.col("label"))
    got = found(nearest(vectors, F.expr(EVERY)))
    # fewer candidates than asked for: all of them; ties to the smaller id, repeated rows as often
    assert got == {0: [(8, 2.0), (9, 2.0), (9, 2.0), (20, -1.0)], 20: [(0, -1.0), (0, -1.0), (8, -2.0), (9, -2.0), (9, -2.0)]}
    assert nearest(vectors.limit(0), F.expr(EVERY)).collect() == []
    assert nearest(vectors.where("vec_id = 3"), F.expr(EVERY)).collect() == []
    assert nearest(vectors.where("vec_id = 0"), F.expr(EVERY)).collect() == []


def test_chi_square_quantiles():
    assert chi_square(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert chi_square(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_trees_hold_every_point_once():
    points = np.random.default_rng(6).standard_normal((500, 4))
    points[:200] = 1.0
    assert sorted(np.concatenate(split(points, 16)).tolist()) == list(range(500))
    nodes = top_tree(points, 30, 16)
    cells = cell_of(points, nodes)
    assert len(nodes) + 1 >= len(set(cells)) > 4 and len(set(cells[:200])) == 1


def test_lists_are_merged_in_levels(spark, monkeypatch):
    """More shards than are merged at once: the result does not change."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.standard_normal((900, 4)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    once = sorted(map(tuple, nearest(table, F.col("vec_id") % 20 == 0, shard_rows=30, certainty=0.9999).collect()))
    monkeypatch.setattr(module, "MERGED", 2)
    assert once == sorted(map(tuple, nearest(table, F.col("vec_id") % 20 == 0, shard_rows=30, certainty=0.9999).collect()))
    x = np.array([r[1] for r in rows])
    hits = 0
    for q in range(0, 900, 20):
        order = sorted((-float(np.float64(x[q] @ x[i])), i) for i in range(900) if i != q)[:20]
        hits += len({i for _, i in order} & {r[2] for r in once if r[0] == q})
    assert hits >= 0.99 * 45 * 20
