"""The registered queries against SQL, and the pipeline against plain code, on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest
import test_line_dedup
import test_mixing
import test_ngram_join
from plain import DOCS, SMOKE, awkward, needs_tables

import __spark_entry__ as contract
import corpus_pipeline
from eventmart.llm.queries import ORACLE, PIECE_MODEL, QUERIES

needs_model = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no vocabulary file")


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert "pipeline" not in contract.oracle_sql()


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE}/{table}.parquet'")
    got, want = QUERIES[name](spark, SMOKE), db.sql(ORACLE[name])
    at = [want.columns.index(c) for c in got.columns]
    left = sorted((tuple(map(_plain, r)) for r in got.collect()), key=repr)
    assert left == sorted((tuple(_plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@needs_tables
def test_columns_of_the_contract(spark):
    # The order and the types that the contracts name.
    wanted = {
        "op3_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
        "op4_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
        "op5_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op6_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
        "op8_neighbours": "query_id bigint, rank int, vec_id bigint, score double",
        "op9_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op11_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string",
        "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string",
        "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    }
    for name, columns in wanted.items():
        assert ", ".join(f"{c} {t}" for c, t in QUERIES[name](spark, SMOKE).dtypes) == columns


@needs_tables
@needs_model
def test_pipeline_against_plain_code(spark):
    from sentencepiece import SentencePieceProcessor

    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "mixing", "pieces"]

    # language: no document of these tables is without letters, none is rejected
    ids = list(rows)
    copies = test_ngram_join.expected([(i, rows[i]["text"]) for i in ids])
    texts = [t for t, _, _ in test_line_dedup.expected([rows[i]["text"] for i in ids], 10, units=[c[0] for c in copies])]
    cut = dict(zip(ids, texts, strict=True))
    groups = test_ngram_join.expected([(i, cut[i]) for i in ids])
    kept = [i for i, g in zip(ids, groups, strict=True) if g[0] == i]
    plan = test_mixing.expected([(i, cut[i], rows[i]["source"]) for i in kept])
    want = Counter({i: p[4] for i, p in zip(kept, plan, strict=True) if p[4]})

    result = corpus_pipeline.run(spark, SMOKE).collect()
    assert Counter(r["doc_id"] for r in result) == want
    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in result[:50]:
        assert r["ids"] == library.encode(cut[r["doc_id"]]) and r["n_pieces"] == len(r["ids"])
        assert r["n_chars"] == len(cut[r["doc_id"]])
    assert all(r["round_trip"] for r in result)

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMOKE).columns == columns, name


def test_language_stage_drops_what_it_rejects_only(spark):
    docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 2, 3, 7, 7, None, None, 8, 10])  # without 4, 5, 6 and 9, which have no letter


@needs_model
def test_stages_take_awkward_and_empty_tables(spark):
    awkward_docs = awkward(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), "").count() == 0, name
        assert stage(spark, awkward_docs, "").count() > 0, name


def _through_the_copies(spark, texts):
    """What the line and the copy stage leave of English texts."""
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], DOCS)
    for stage in (corpus_pipeline.drop_shared_lines, corpus_pipeline.keep_one_of_each):
        docs = stage(spark, docs, "")
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.mark.parametrize("changed", [0, 1])
def test_a_text_of_twelve_copies_comes_out_whole(spark, changed):
    lines = [" ".join(f"w{k}x{j}" for j in range(9)) for k in range(20)]
    near = [lines[:k] + [lines[k] + f" v{k}" * changed] + lines[k + 1 :] for k in range(12)]
    others = [[f"{word}{k} is a text of its own" for word in ("one", "two", "three")] for k in range(12)]
    texts = ["\n".join([*own, "the footer of all pages"]) for own in near + others]
    kept = _through_the_copies(spark, texts)
    assert set(kept) == {0, *range(12, 24)}
    assert kept[0] == "\n".join(near[0]) and kept[12] == "\n".join(others[0])
