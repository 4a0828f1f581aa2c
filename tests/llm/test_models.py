"""Language, quality and toxicity: held-out results, bounds, awkward rows."""

import zlib

import numpy as np
import pytest
from plain import CLASHES, SMOKE, awkward, needs_tables, none_of
from pyspark.sql import functions as F

from eventmart.llm import language_id as lang
from eventmart.llm import quality as qual
from eventmart.llm import toxicity as tox
from eventmart.llm.learning import labelled_sample

BIGGER = SMOKE.replace("sf0.001", "sf0.01")


def auc(pairs):
    ones, zeros = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def tables(spark):
    return spark.read.parquet(f"{BIGGER}/documents.parquet"), spark.read.parquet(f"{BIGGER}/labels.parquet")


@needs_tables
def test_language_of_held_out_documents(spark):
    docs, _ = tables(spark)
    rows = lang.language_id(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


@needs_tables
@pytest.mark.parametrize("operator, label, parts, part", [(qual.quality, "quality", 4, 2), (tox.toxicity, "toxic", 3, 1)])
def test_scores_of_held_out_documents(spark, operator, label, parts, part):
    docs, labels = tables(spark)
    rows = operator(docs, labels).collect()
    marks = {r["doc_id"]: r[label] for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == part) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert auc([(marks[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in marks]) > 0.85


@needs_tables
@pytest.mark.parametrize("operator, label, parts, part", [(qual.quality, "quality", 4, 2), (tox.toxicity, "toxic", 3, 1)])
def test_held_out_labels_are_not_learnt(spark, operator, label, parts, part):
    docs, labels = (t.where("doc_id < 300") for t in tables(spark))
    turned = f"CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % {parts} = {part} THEN 1 - {label} ELSE {label} END AS {label}"
    other = labels.selectExpr("doc_id", turned)
    a = {r["doc_id"]: r["score"] for r in operator(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in operator(docs, other).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("operator, label", [(qual.quality, "quality"), (tox.toxicity, "toxic")])
def test_labelled_awkward_rows(spark, operator, label):
    docs = awkward(spark)
    marks = [(1, 1), (2, 0), (2, 0), (3, 1), (3, 0), (4, None), (7, 1), (7, 1), (None, 1), (8, 5), (9, 0), (99, 1)]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int")
    result = operator(docs, labels)
    rows = result.collect()
    assert result.columns == [*docs.columns, "held_out", "score", "predicted"]
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r[c] == r["n_chars"] for r in rows for c in CLASHES)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert len({round(r["score"], 9) for r in rows if r["text"] in (None, "")}) == 1
    assert operator(none_of(spark), labels).collect() == []
    one_kind = operator(docs, labels.where(f"{label} = 1")).collect()
    assert {r["score"] for r in one_kind} == {1.0}
    none = operator(docs, labels.limit(0)).collect()
    assert len({r["score"] for r in none}) == 1


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    result = lang.language_id(docs)
    rows = result.collect()
    assert result.columns == [*docs.columns, "lang_pred", "score", "held_out"]
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
        assert all(r[c] == r["n_chars"] for c in CLASHES)
    assert lang.language_id(none_of(spark)).collect() == []
    unknown = lang.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unknown.collect()} == {("und", 0.0)}


def test_kernel_weights_are_the_kernel_machine():
    """Folded weights score like the landmarks' kernels and regressions they stand for."""
    texts = ["the cat and the dog", "der hund und die katze", "the house on the hill", "das haus auf dem berg"]
    rows = [{"slots": np.unique(lang.grams(t)).tolist(), "label": k} for t, k in zip(texts, ["en", "de"] * 2, strict=True)]
    names, weights = lang.train(rows, landmarks=4)
    sets = [set(r["slots"]) for r in rows]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    wanted = np.array([[1.0 if r["label"] == n else -1.0 for n in names] for r in rows])
    values, vectors = np.linalg.eigh(kernel)
    features = kernel @ (vectors / np.sqrt(values))
    fitted = np.linalg.solve(features.T @ features + lang.RIDGE * np.eye(4), features.T @ wanted)
    folded = np.stack([weights[list(s)].sum(0) / np.sqrt(len(s)) for s in sets])
    plain = features @ fitted
    assert np.allclose(folded / folded[0, 0], plain / plain[0, 0], atol=1e-3)
    assert lang.score(texts + [None, "123"], names, weights)[0] == ["en", "de", "en", "de", "und", "und"]


def test_ngrams_see_letters_only():
    assert np.array_equal(lang.grams("A  b!"), lang.grams("a...B\n"))
    assert lang.grams("12 !") is None and lang.grams(None) is None


def test_sample_is_bounded_balanced_and_repeatable(spark):
    rows = [(k, int(k % 10 == 0)) for k in range(2000)]
    labelled = spark.createDataFrame(rows, "key long, label int")
    a = sorted(map(tuple, labelled_sample(labelled, 200).collect()))
    assert len(a) == 200 and a == sorted(map(tuple, labelled_sample(labelled.repartition(5), 200).collect()))
    assert 60 < sum(x[1] for x in a) < 140
    assert sum(x[2] for x in a) == pytest.approx(2000)


def test_grammar_weighs_clauses():
    machine = tox.grammar({"idiot": 2.0, "vequ*": 3.0})

    def score(clause):
        return tox.clause_score(clause.split(), machine)

    plain = score("some idiot here")
    assert plain == 2.0 and score("calm words") == 0
    assert score("you are an idiot") > plain > score("not an idiot") > 0
    assert score("she said some idiot came") < plain
    assert score("vequance") == 3.0 and score("vequ") == 0  # a beginning needs more behind it
    assert score("not one two three idiot") == plain  # out of reach
    assert score("i will kill you idiot") > plain
    assert tox.matches("Calm. You idiot! Not an idiot; fine", machine) == [score("you idiot"), score("not an idiot")]


def test_aimed_threats_match_without_learnt_words():
    def score(text):
        return sum(tox.threats(text, tox.grammar()))

    plain = score("I will kill you")
    assert plain == score("Je vais te tuer") > 0
    assert 0 < score("she said I will kill you") < plain < score("I will kill you. You! I beat them")
    assert score("the frost will kill crops") == score("I will never kill you") == score("you are skilled") == score(None) == 0
    assert score("kill one two three four you") == 0  # out of reach
    assert tox.features("I will kill you", tox.grammar()) != tox.features("frost will kill crops", tox.grammar())
    for said in ("he killed them", "killing you", "er schlägt dich", "ich töte euch", "te mataré", "je te frapperai", "they shot him"):
        assert score(said) > 0, said
    assert score("tu es you") == score("my mat for you") == score("a skill you have") == 0


def test_threats_of_held_out_documents_without_learnt_words(spark):
    """Verbs that are as usual in clean texts are no learnt words; only their target tells."""
    kinds = [("tonight I will {} you", 1), ("tonight frost will {} crops", 0), ("I will see you tonight", 0), ("I will never {} you tonight", 0)]
    verbs = tox.THREAT_STEMS["English"]
    rows = [(k, kinds[k % 4][0].format(verbs[k // 4 % 8]), kinds[k % 4][1]) for k in range(480)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    held = [(rows[r["doc_id"]][2], r["score"], r["predicted"]) for r in tox.toxicity(docs, labels).collect() if r["held_out"]]
    assert len(held) > 100 and auc([h[:2] for h in held]) > 0.99
    assert all(y == predicted for y, _, predicted in held)


def test_machines_of_words_read_what_they_hold_and_nothing_else():
    forms = {stem + e for k, stems in tox.THREAT_STEMS.items() for stem in stems for e in tox.ENDINGS[k]} | set(tox.THREAT_FORMS)
    machine = tox.threat_words()
    rng = np.random.default_rng(3)
    near = {f[:k] + c + f[k + d :] for f in forms for k in range(len(f) + 1) for c in ("", "e", "t") for d in (0, 1)}
    assert {w for w in near | forms if machine.weight(w)} == forms
    weights = {"ab": 1.0, "abc": 0.5, "ab*": 2.0, "abcd*": 3.0, "b*": 0.25, "é": 4.0}
    learnt = tox.insult_words(weights)
    for _ in range(2000):
        word = "".join(rng.choice(list("abcdé"), rng.integers(0, 7)))
        want = weights.get(word) or max((v for k, v in weights.items() if k[-1] == "*" and word.startswith(k[:-1]) and len(word) >= len(k)), default=0)
        assert learnt.weight(word) == want, word


def test_composition_equals_the_chain_one_after_the_other():
    """Every machine reads the whole clause that the one before has written."""
    rng = np.random.default_rng(5)
    machine = tox.grammar()
    for _ in range(500):
        symbols = rng.choice(["insult", "threat", "negation", "target", "report", "other"], rng.integers(1, 15)).tolist()
        tape, product = list(symbols), np.ones(len(symbols))
        for single in machine.chain:
            state, written = 0, []
            for k, symbol in enumerate(tape):
                state, out, weight = single.step(state, symbol)
                written.append(out)
                product[k] *= weight
            tape = written
        state, got, weights = machine.start, [], []
        for symbol in symbols:
            state, out, weight = machine.step(state, symbol)
            got.append(out)
            weights.append(weight)
        assert got == tape and weights == pytest.approx(product.tolist())


def test_lexicon_holds_words_and_beginnings_of_fixed_length(spark):
    """A stem with many endings is learnt as a beginning, of four or five characters wherever the word stands."""
    endings = [a + b for a in "abcdefghij" for b in "klmnopqrst"]
    rows = [(f"some plain words come first then grumb{e} it is", 1) for e in endings] + [(f"some plain words come first then {e} it is", 0) for e in endings]
    learnt = tox.lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert {"grum*", "grumb*"} <= set(learnt) and all(len(k) - 1 in tox.BEGINNINGS for k in learnt if k.endswith("*"))
    assert tox.grammar(learnt).insults.weight("grumbzz") > 0 == tox.grammar(learnt).insults.weight("plain")


def test_arcs_are_chosen_by_the_labels():
    rng = np.random.default_rng(6)
    y = np.arange(400) % 2
    x = rng.normal(size=(400, 1 + sum(len(v) - 1 for v in tox.CHOICES.values()), tox.FEATURES))
    assert tox.chosen_arcs(np.repeat(x[:, :1], x.shape[1], 1), y, np.ones(400)) == tox.DEFAULTS
    x[:, 4, 1] += 3 * y  # the second other weight of "aimed"
    assert tox.chosen_arcs(x, y, np.ones(400))["aimed"] == tox.CHOICES["aimed"][2]


def test_word_vectors_add_up_over_tasks(spark):
    docs = spark.createDataFrame([(k, f"a b c{k % 3} d e {k}") for k in range(60)], "doc_id long, text string")
    one, many = qual.word_vectors(docs.coalesce(1), "text"), qual.word_vectors(docs.repartition(6), "text")
    assert np.array_equal(one, many) and np.linalg.norm(one, axis=1).max() <= 1 + 1e-6


def plain_quality_features(texts):
    """Random indexing word by word, in dictionaries."""
    places, signs = qual.index_vectors()
    index = {}

    def index_of(slot):
        if slot not in index:
            index[slot] = np.zeros(qual.DIMENSIONS)
            index[slot][places[slot]] = signs[slot]
        return index[slot]

    read = []
    for text in texts:
        _, core, form = qual.words([text or ""])
        read.append(list(zip(core.tolist(), form.tolist(), strict=True)))
    context = {}
    for words in read:
        for i, (core, form) in enumerate(words):
            near = [words[j][0] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < len(words)] + [form]
            for slot in near:
                context[core] = context.get(core, 0) + index_of(slot)
            for slot in [words[j][1] for j in (i - 1, i + 1) if 0 <= j < len(words)] + [core]:
                context[form] = context.get(form, 0) + index_of(slot)
    unit = {slot: v / max(np.linalg.norm(v), 1) for slot, v in context.items()}
    none = np.zeros(3 * qual.DIMENSIONS)
    return [np.mean([np.concatenate((unit[c], unit[f], index_of(f))) for c, f in words], axis=0) if words else none for words in read]


def test_pooled_vectors_equal_a_plain_dictionary(spark):
    rng = np.random.default_rng(9)
    vocabulary = ["the", "The", "cat", "cat,", "(sat)", "ON", "mat.", "42", "--", "é", "Straße"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(60)] + [None, "", " ", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    vectors = qual.word_vectors(docs, "text")
    assert np.allclose(qual.pooled(texts, vectors), plain_quality_features(texts), atol=1e-5)


def test_words_of_texts():
    at, core, form = qual.words(["The the, the, (THE)", "", "  ", "x"])
    assert at.tolist() == [0, 0, 0, 0, 3] and len(set(core[:4])) == 1
    assert len(set(form[:4])) == 4  # title; mark; the same again; capitals in brackets
