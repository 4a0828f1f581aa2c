"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmart.llm import metric_tree
from eventmart.llm.metric_tree import build, search, top_k


def expected(rows, is_query, k=5, scale=256):
    """(query_id, rank, vec_id, score) by comparing all."""
    usable = [
        (i, [math.floor(scale * v) for v in x])
        for i, x in rows
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x)
    ]
    lengths = [len(x) for _, x in usable]
    size = max(lengths, key=lambda s: (lengths.count(s), s), default=0)
    usable = [(i, x) for i, x in usable if len(x) == size]
    queries = {}
    for i, x in usable:
        if is_query(i):
            queries[i] = min(queries.get(i, x), x)
    out = []
    for q, x in queries.items():
        scored = sorted((-sum(map(lambda a, b: a * b, x, y)), i) for i, y in usable if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def result(spark, rows, **how):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell long, row long") if rows and len(rows[0]) > 2 else (
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    )
    return sorted(tuple(r) for r in top_k(table, F.col("vec_id") % 50 == 0, **how).collect())


@pytest.mark.parametrize("shape", ["clusters", "ball", "integers"])
def test_equals_brute_force(spark, shape, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 6))
    if shape == "clusters":
        x = rng.standard_normal((12, 6))[rng.integers(0, 12, 1500)] * 3 + x / 10
    if shape == "integers":
        x = rng.integers(-1, 2, (1500, 6)) / 256  # many ties and equal vectors
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    monkeypatch.setattr(metric_tree, "QUERY_ROWS", 8)
    assert result(spark, rows, shard_rows=200) == expected(rows, lambda i: i % 50 == 0)


def test_equal_vectors_and_a_hot_cell(spark):
    rows = [(i, [0.5, 0.25]) for i in range(700)] + [(i, [0.0, 0.0]) for i in range(700, 760)]
    assert result(spark, rows, shard_rows=100) == expected(rows, lambda i: i % 50 == 0)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1, 1), (0, [1.0, 2.0], 1, 1), (50, [0.0, 0.0], 1, None), (1, None, 1, 1), (2, [], 1, 1),
        (3, [nan, 1.0], 1, 1), (4, [inf, 1.0], 1, 1), (5, [None, 1.0], 1, 1), (6, [1.0, 2.0, 3.0], 1, 1), (None, [9.0, 9.0], 1, 1),
        (7, [-1.0, 0.003], None, 1), (7, [-1.0, 0.003], 1, 1), (100, [3.0, -4.0], 1, 1),
    ]
    assert result(spark, rows) == expected([r[:2] for r in rows], lambda i: i % 50 == 0)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
    assert [f.dataType.simpleString() for f in top_k(empty, F.lit(True)).schema] == ["bigint", "int", "bigint", "bigint"]
    assert result(spark, [(0, [1.0])]) == []


def test_large_components(spark):
    rows = [(i, [float(i) * 1e4, 1e6 - i]) for i in range(0, 300, 7)] + [(50, [2e6, 3.5])]
    assert result(spark, rows) == expected(rows, lambda i: i % 50 == 0)
    with pytest.raises(ValueError, match="64 bits"):
        result(spark, [(0, [1e30]), (1, [1.0])])


def test_bounds_spare_comparisons():
    rng = np.random.default_rng(5)
    x = np.floor(rng.standard_normal((40, 3))[rng.integers(0, 40, 4000)] * 2000 + rng.standard_normal((4000, 3)) * 20)
    square = float((x * x).sum(1).max())
    pages = build(x, np.arange(4000), square)
    assert sorted(i for p in pages for i in p["ids"]) == list(range(4000))
    for p in pages[1:]:
        up = np.linalg.norm(p["routing"] - pages[p["parent"]]["routing"])
        assert abs(up - p["parent_distance"]) < 1e-3 and p["radius"] <= pages[p["parent"]]["radius"] * 2 + 1
    queries = x[:20]
    ids, scores, compared = search(pages, queries, np.arange(20), np.full(20, np.inf), square, 5)
    for k in range(20):
        order = sorted((-int(s), i) for i, s in enumerate(queries[k] @ x.T) if i != k)[:5]
        assert [(-s, i) for s, i in order] == [(s, i) for s, i in zip(scores[k], ids[k], strict=True)]
    assert compared < 0.5 * 20 * 4000
