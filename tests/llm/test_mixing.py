import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from plain import CLASHES, awkward, none_of

from eventmart.llm.mixing import mix, mix_plan


def shares(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets dealt out round by round, sources in order of code points, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, left = {}, dict(weight)
    while left:
        rest = share * sum(sizes.values()) - sum(full.values())
        above = [s for s in left if left[s] * (rest / sum(left.values())) > most * sizes[s]]
        if not above:
            return full | {s: left[s] * (rest / sum(left.values())) for s in left}
        for s in above:
            full[s] = most * sizes[s]
            del left[s]
    return full


def expected(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for n, (_, _, source) in zip(size, rows, strict=True):
        sizes[source] += n
    target = shares(sizes)
    out = []
    for n, (doc_id, text, source) in zip(size, rows, strict=True):
        key = str(doc_id) if doc_id is not None else hashlib.md5(text.encode()).hexdigest() if text is not None else "-"
        rate = target[source] / sizes[source] if sizes[source] else 0
        draw = int(hashlib.md5(f"{key}:mix".encode()).hexdigest()[:13], 16) / 2**52
        out.append((doc_id, n, sizes[source], pytest.approx(target[source]), math.floor(rate) + (draw < rate - math.floor(rate))))
    return out


def test_same_as_plain_rounds(spark):
    rows = [(i, " ".join(["w"] * (i % 13)), [None, "z", "b", "a", "é"][min(i % 7, 4)]) for i in range(300)]
    plan = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = [tuple(r) for r in plan.select("doc_id", "size", "source_size", "target", "copies").orderBy("doc_id").collect()]
    assert got == expected(rows)


def test_full_source_passes_its_excess_on():
    assert shares({"a": 1, "b": 100, "c": 100})["a"] == 2
    assert sum(shares({"a": 1, "b": 100, "c": 100}).values()) == pytest.approx(1.5 * 201)


def test_copies_come_out_and_reruns_agree(spark):
    rows = [(i, "one two", "a" if i % 3 else "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r["doc_id"]: r["copies"] for r in mix_plan(docs).collect()}
    first = Counter(r["doc_id"] for r in mix(docs).collect())
    again = Counter(r["doc_id"] for r in mix(docs.repartition(7)).collect())
    assert first == again == Counter({k: n for k, n in plan.items() if n})
    assert max(plan.values()) <= 2
    assert sum(first.values()) * 2 == pytest.approx(1.5 * 800, rel=0.1)


def test_awkward_rows(spark):
    docs = awkward(spark)
    plan = mix_plan(docs)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    got = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["copies"]) for r in plan.collect()]
    assert sorted(got, key=lambda r: repr(r[:3])) == sorted(expected(rows), key=lambda r: repr(r[:3]))
    assert all(r[c] == r["n_chars"] for r in plan.collect() for c in CLASHES)
    assert mix(docs).columns == docs.columns


def test_empty_table_and_no_words(spark):
    assert mix_plan(none_of(spark)).collect() == [] and mix(none_of(spark)).collect() == []
    docs = spark.createDataFrame([(1, "", "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert [tuple(r)[-4:] for r in mix_plan(docs).collect()] == [(0, 0, 0.0, 0)] * 2
