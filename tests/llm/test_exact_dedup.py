import hashlib
import random
import time
from collections import defaultdict

import pytest
from plain import CLASHES, awkward, none_of, normalised

from eventmart.llm import exact_dedup as module
from eventmart.llm.exact_dedup import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normalised(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def found(result):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in result.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_same_as_plain_grouping(spark, block):
    rng = random.Random(block)
    rows = [(i, "".join(rng.choice("ab \n") for _ in range(rng.choice([0, 1, 2, 3, 9, 10])))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(exact_dedup(docs, block_chars=block)) == expected(rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    result = exact_dedup(docs)
    assert found(result) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert result.columns == [*docs.columns, "keep_id", "group_size", "kept", "text_sha256"]
    kept = [r for r in result.collect() if r["kept"]]
    # one row of each text stays, also of repeated rows and of rows without an id
    assert len(kept) == len({normalised(r["text"]) for r in docs.collect()})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert all(r[c] == r["n_chars"] for r in kept for c in CLASHES)


def test_empty_table_and_carried_columns(spark):
    assert exact_dedup(none_of(spark)).collect() == []
    assert exact_dedup(awkward(spark), carry=["lang"]).columns == ["doc_id", "lang", "keep_id", "group_size", "kept", "text_sha256"]
    with pytest.raises(ValueError):
        exact_dedup(awkward(spark), block_chars=0)


def test_added_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "x", 99)], "doc_id long, text string, group_size long")
    assert exact_dedup(docs).select("group_size").collect()[0][0] == 1


def test_colliding_digests_get_another_salt(spark, monkeypatch):
    whole = module._digest
    monkeypatch.setattr(module, "_digest", lambda block, salt: whole(block.substr(1, 1) if salt == 0 else block, salt))
    rows = [(1, "aa"), (2, "ab"), (3, "aa")]
    assert found(exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_blocks_of_characters_beyond_the_basic_plane(spark):
    texts = ["🙂é漢 \x85x" * 5, "🙂é漢 \x85x" * 4 + "🙂é漢 \x85y", "🙂", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (1, 4, 7):
        cut = docs.select("doc_id", module._blocks(docs["text"], size).alias("b")).orderBy("doc_id").collect()
        assert [r["b"] for r in cut] == [[t[k : k + size] for k in range(0, len(t), size)] or [""] for t in texts]


def test_texts_of_many_million_characters(spark):
    """A text is cut in one pass, so its time grows with its length only."""
    rows = [(k, 3_000_000 + k % 2) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, n int").selectExpr("doc_id", "repeat('some words of it ', n) AS text")
    started = time.monotonic()
    kept = exact_dedup(docs, carry=[]).where("kept").select("doc_id", "group_size").collect()
    assert sorted(map(tuple, kept)) == [(0, 2), (1, 2)]
    assert time.monotonic() - started < 120
