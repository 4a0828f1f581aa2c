"""Runs of words against a search of all periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from plain import SMOKE, awkward, needs_tables, none_of
from pyspark.sql import functions as F

from eventmart.llm import periodic_runs as module
from eventmart.llm.periodic_runs import Index, WaveletTree, periodic_runs, runs_by_text
from eventmart.llm.queries import QUERIES


def plain_runs(words):
    """Every maximal stretch of each period, the smallest period of a stretch only."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k - start + q
            if length >= max(6, 4 * q):
                out.setdefault((start, length), q)
    return sorted((s, m, q) for (s, m), q in out.items())


def expected(text, doc_id, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and words:
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(runs), *shown, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(kept))


def repetitive(rng, n):
    """Words of a small alphabet with repeated, nested and neighbouring repetitions."""
    out = []
    while len(out) < n:
        kind = rng.integers(4)
        if kind == 0:
            out += rng.integers(0, 3, rng.integers(1, 12)).tolist()
        elif kind == 1:
            unit = rng.integers(0, 2, rng.integers(1, 9)).tolist()
            out += (unit * 9)[: rng.integers(1, 9 * len(unit) + 1)]
        elif kind == 2 and out:
            unit = out[-int(rng.integers(1, min(len(out), 40) + 1)) :]
            out += unit * int(rng.integers(1, 6))
        else:
            inner = [0] * int(rng.integers(1, 9)) + [1] + [0] * int(rng.integers(0, 9))
            out += inner * int(rng.integers(1, 7))
    return out[:n]


def test_all_runs_of_repetitive_sequences():
    rng = np.random.default_rng(1)
    texts = [repetitive(rng, int(rng.integers(0, 300))) for _ in range(400)]
    texts += [[0] * n for n in (5, 6, 7, 64, 1000)] + [[0, 1] * 40 + [2] + [0, 1] * 5, list(range(50)) * 4, (list(range(33)) * 5)[:-1]]
    texts += [([0] * 15 + [1]) * 5, (([0] * 15 + [1]) * 4 + [2]) * 4, [k % 7 for k in range(28)], [k % 7 for k in range(27)]]
    for joint in (texts, *([t] for t in texts)):
        got = runs_by_text([[b"%d" % w for w in t] for t in joint])
        assert [list(map(tuple, r.tolist())) for r in got] == [plain_runs(t) for t in joint]


def test_without_cutting_first(monkeypatch):
    monkeypatch.setattr(module, "ROUNDS", 0)
    rng = np.random.default_rng(2)
    texts = [repetitive(rng, 200) for _ in range(60)]
    got = runs_by_text([[b"%d" % w for w in t] for t in texts])
    assert [list(map(tuple, r.tolist())) for r in got] == [plain_runs(t) for t in texts]


def test_wavelet_tree_and_suffix_array():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 64, 201):
        order = rng.permutation(n)
        tree = WaveletTree(order)
        low = rng.integers(0, n, 300)
        high = rng.integers(low + 1, n + 1)
        limit = rng.integers(0, n + 40, 300)
        pick = rng.integers(0, high - low)
        assert tree.below(low, high, limit).tolist() == [int((order[a:b] < x).sum()) for a, b, x in zip(low, high, limit, strict=True)]
        assert tree.nth(low, high, pick).tolist() == [sorted(order[a:b])[k] for a, b, k in zip(low, high, pick, strict=True)]
    words = np.array([*repetitive(rng, 300), 99])
    index = Index(words, 300)
    x, y = rng.integers(0, 300, 500), rng.integers(0, 300, 500)
    x, y = x[x != y], y[x != y]
    for back in (False, True):
        for a, b, got in zip(x, y, index.common(x, y, back), strict=True):
            want, step = 0, -1 if back else 1
            while min(a, b) + want * step >= 0 and max(a, b) + want * step < 301 and words[a + want * step] == words[b + want * step]:
                want += 1
            assert got == want


def rows_of(docs, **how):
    digest = F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")
    found = periodic_runs(docs, plant=True, **how)
    return [tuple(r) for r in found.select("doc_id", *module.FOUND.names[:-1], digest).collect()]


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("period", F.lit("other"))
    got = rows_of(docs)
    plain = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in got:
        if row[0] != 7:  # too long for the plain search
            assert row[1:] == expected(plain[row[0]], row[0])
    assert sum(r[0] == 7 for r in got) == 2 and len(got) == 13
    assert periodic_runs(none_of(spark)).count() == 0
    kept = periodic_runs(docs)
    assert set(docs.columns) <= set(kept.columns) and dict(kept.dtypes)["period"] == "bigint"


def test_long_texts(spark, monkeypatch):
    # texts and runs longer than a part
    monkeypatch.setattr(module, "PART_WORDS", 1000)
    unit = [f"w{k}" for k in range(20_000)]
    texts = [" ".join(unit * 5), "a " * 300_000, " ".join(f"x{k}" for k in range(200_000)), "b c " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic_runs(docs).collect()}
    assert (got[0]["n_runs"], got[0]["start"], got[0]["length"], got[0]["period"]) == (1, 0, 100_000, 20_000)
    assert got[0]["collapsed"] == " ".join(unit) and got[0]["exponent_milli"] == 5000
    assert (got[1]["length"], got[1]["period"], got[1]["collapsed"]) == (300_000, 1, "a")
    assert got[2]["n_runs"] == 0 and got[2]["collapsed"] == texts[2] and got[2]["start"] is None
    assert got[3]["n_runs"] == 0 and got[3]["collapsed"] == "b c b c b c"


@needs_tables
def test_query_against_all_periods(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    short = {i: t for i, t in docs.items() if len((t or "").split()) < 1500}
    assert len(short) > 150
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op13_periodic_runs"](spark, SMOKE).collect()}
    assert set(got) == set(docs)
    for doc_id, text in short.items():
        assert got[doc_id] == expected(text, doc_id), doc_id
