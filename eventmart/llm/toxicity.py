"""Toxicity scoring with a weighted pattern grammar.

A word is read by two transducers over its characters: one for threats, stems followed by the endings
of their paradigm, and one for insults, whose words, word beginnings and weights are learnt from
labelled clauses. Each gives the word's symbol and weight. A clause of such symbols is read by a chain
of transducers, each of which passes them on with a weight: negation weakens what it governs, a
target near by strengthens it, reported speech weakens what follows. How much they do is
chosen on the labelled sample. All machines are determinised or composed as far as they are
needed. A document's score comes from its matched clauses, not from single words: those with a
learnt word, and those in which a threat is aimed at a target and not negated, learnt or not.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import LOWER, UPPER, field, held_out, packed, runs_on_executors, unpacked
from eventmart.llm.learning import labelled_sample, training_labels

runs_on_executors(__name__)

HELD_OUT = (3, 1)
THRESHOLD = 0.7
TRAINING_ROWS = 8_000
#: A learnt word or word beginning must be this much likelier in toxic clauses (log-odds), and
#: this far from chance (log-likelihood ratio).
LEAST_WEIGHT = 2.0
LEAST_RATIO = 20.0
BEGINNINGS = (4, 5)
LEXICON_SIZE = 20_000

# Fixed word lists of the grammar: closed classes of the languages at hand.
NEGATIONS = "not no never nor neither isn aren wasn don doesn didn nicht nie kein keine pas jamais ni nunca jamás".split()
TARGETS = "you your yours yourself u ur they them their he him his she her du dich dir dein euch tu toi te vous votre usted ustedes".split()
REPORTS = "said says say called calls wrote claims claimed told quoted sagte sagt schrieb dit disait dijo dice llamó".split()
ENDINGS = {
    "English": ["", "s", "ed", "ing"],
    "German": "e st est t et en end te ten test".split(),
    "French": "er e es ons ez ent é ée és ées ait aient erai eras era erons erez eront ant".split(),
    "Spanish": "ar o as a amos an é ó aste aron aba aban aré arás ará arán ando ado".split(),
}
#: Stems of threats with the endings that they take.
THREAT_STEMS = {
    "English": "kill hurt beat destroy murder shoot stab burn".split(),
    "German": "töt umbring schlag".split(),
    "French": "tu frapp".split(),
    "Spanish": "mat golpe".split(),
}
#: Forms that no paradigm has.
THREAT_FORMS = "beaten shot stabbed stabbing burnt umgebracht schlägst schlägt geschlagen getötet".split()

#: Threats count little beside insults; what those without one count is learnt, as a feature of their own.
THREAT_WEIGHT = 0.5
#: Loss that another weight of an arc must spare; words whose reading is remembered.
LEAST_GAIN = 1e-3
MOST_KNOWN = 200_000

THREATENING = re.compile("|".join([*(stem for stems in THREAT_STEMS.values() for stem in stems), *THREAT_FORMS]))
CLAUSE = re.compile(r"[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+")


class Spelling:
    """A transducer from a word's characters to a symbol's weight: arcs may share characters and cross paths.

    ``*`` is any character. States are sets of its own, made when first needed. Of several
    ways to read a word the one of the highest rank, then weight, counts.
    """

    def __init__(self):
        self.arcs: dict[tuple[int, str], set[int]] = {}
        self.ends: dict[int, tuple[int, float]] = {}
        self.size = 1
        self.known: dict[tuple[frozenset, str], frozenset] = {}
        self.read: dict[str, float] = {}

    def path(self, start: int, chars: str) -> int:
        """The state after ``chars``; what is not there yet is added."""
        for c in chars:
            after = self.arcs.setdefault((start, c), set())
            if not after:
                after.add(self.size)
                self.size += 1
            start = min(after)
        return start

    def word(self, form: str, weight: float, start: int = 0) -> None:
        at = self.path(start, form)
        self.ends[at] = max(self.ends.get(at, (0, 0.0)), (1, weight))

    def beginning(self, form: str, weight: float) -> None:
        """All longer words that begin so."""
        more = self.size
        self.size += 1
        self.arcs.setdefault((self.path(0, form), "*"), set()).add(more)
        self.arcs[more, "*"] = {more}
        self.ends[more] = (0, weight)

    def weight(self, word: str) -> float:
        """The weight of a word, 0 if it cannot be read."""
        found = self.read.get(word)
        if found is None:
            states = frozenset((0,))
            for c in word:
                after = self.known.get((states, c))
                if after is None:
                    after = frozenset().union(*(self.arcs.get((s, x), ()) for s in states for x in (c, "*")))
                    self.known[states, c] = after
                states = after
                if not states:
                    break
            found = max((self.ends[s] for s in states if s in self.ends), default=(0, 0.0))[1]
            if len(self.read) > MOST_KNOWN:
                self.read, self.known = {}, {}
            self.read[word] = found
        return found


def threat_words() -> Spelling:
    """Stems, each followed by the endings of its language."""
    machine = Spelling()
    for language, stems in THREAT_STEMS.items():
        for stem in stems:
            at = machine.path(0, stem)
            for ending in ENDINGS[language]:
                machine.word(ending, THREAT_WEIGHT, at)
    for form in THREAT_FORMS:
        machine.word(form, THREAT_WEIGHT)
    return machine


def insult_words(weights: dict[str, float]) -> Spelling:
    """Learnt words and word beginnings (``abcd*``) with their weights."""
    machine = Spelling()
    for form, weight in weights.items():
        if form.endswith("*"):
            machine.beginning(form[:-1], weight)
        else:
            machine.word(form, weight)
    return machine


class Transducer:
    """Arcs by (state, symbol): next state, symbol passed on, weight. ``*`` is any other symbol."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str | None, float]]):
        self.arcs = arcs

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        to, out, weight = self.arcs.get((state, symbol)) or self.arcs.get((state, "*")) or (state, None, 1.0)
        return to, symbol if out is None else out, weight


class Composed:
    """Transducers one after the other; product states and arcs are made when first needed."""

    def __init__(self, *chain: Transducer):
        self.chain, self.known = chain, {}
        self.start = (0,) * len(chain)

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str, float]:
        found = self.known.get((state, symbol))
        if not found:
            after, weight, passed = [], 1.0, symbol
            for machine, own in zip(self.chain, state, strict=True):
                to, passed, w = machine.step(own, passed)
                after.append(to)
                weight *= w
            found = self.known[state, symbol] = (tuple(after), passed, weight)
        return found


HIT = ("insult", "threat")
FEATURES = 5


def negation(reach: int = 3, weight: float = 0.4) -> Transducer:
    """Weakens insults and threats up to ``reach`` words after a negation."""
    arcs = {(s, "negation"): (reach, None, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs[s, "*"] = (s - 1, None, 1.0)
        arcs |= {(s, hit): (s - 1, "weakened " + hit, weight) for hit in HIT}
    return Transducer(arcs)


def target(reach: int = 4, weight: float = 1.5) -> Transducer:
    """Strengthens insults and threats up to ``reach`` words after a target."""
    arcs = {(s, "target"): (reach, None, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs[s, "*"] = (s - 1, None, 1.0)
        arcs |= {(s, hit): (s - 1, "aimed " + hit, weight) for hit in HIT}
    return Transducer(arcs)


def aim(reach: int = 4, weight: float = 1.5) -> Transducer:
    """A target up to ``reach`` words after a threat that is not negated is what it is aimed at."""
    arcs = {(s, "threat"): (reach, None, 1.0) for s in range(reach + 1)}
    for s in range(1, reach + 1):
        arcs |= {(s, "*"): (s - 1, None, 1.0), (s, "target"): (0, "aimed threat", weight)}
    return Transducer(arcs)


def reported(weight: float = 0.6) -> Transducer:
    """Weakens insults and threats that follow a verb of speech in the same clause."""
    hits = [*HIT, *(f"{how} {hit}" for how in ("weakened", "aimed") for hit in HIT)]
    return Transducer({(0, "report"): (1, None, 1.0)} | {(1, hit): (1, "reported " + hit, weight) for hit in hits})


#: What negation, targets and reported speech do to a weight: the first is taken unless another fits the labels better.
CHOICES = {"negated": (0.4, 0.1, 0.8), "aimed": (1.5, 1.0, 2.5), "told": (0.6, 0.3, 1.0)}
DEFAULTS = {name: values[0] for name, values in CHOICES.items()}


class Grammar(Composed):
    """The machines of words and the chain of clauses."""

    def __init__(self, weights: dict[str, float], negated: float, aimed: float, told: float):
        super().__init__(negation(weight=negated), target(weight=aimed), aim(weight=aimed), reported(told))
        self.threats, self.insults = threat_words(), insult_words(weights)

    def symbol(self, word: str) -> tuple[str, float]:
        """A word's symbol, and its learnt weight or that of a threat."""
        own, threat = self.insults.weight(word), self.threats.weight(word)
        symbol = "threat" if threat else CLASSES.get(word) or ("insult" if own else "other")
        return symbol, own or threat


def grammar(weights: dict[str, float] | None = None, **choice: float) -> Grammar:
    return Grammar(weights or {}, **{**DEFAULTS, **choice})


CLASSES = dict.fromkeys(REPORTS, "report") | dict.fromkeys(TARGETS, "target") | dict.fromkeys(NEGATIONS, "negation")


def clause_score(tokens: list[str], machine: Grammar) -> float:
    """Sum of the weights of the hits of one clause, as the grammar changes them."""
    state, total = machine.start, 0.0
    for word in tokens:
        symbol, own = machine.symbol(word)
        state, _, weight = machine.step(state, symbol)
        if symbol in HIT:
            total += weight * own
    return total


def clause_threat(tokens: list[str], machine: Grammar) -> float:
    """Sum of the weights of the threats of one clause that are aimed at a target and not negated."""
    state, total = machine.start, 0.0
    for word in tokens:
        symbol = "threat" if machine.threats.weight(word) else CLASSES.get(word, "other")
        state, passed, weight = machine.step(state, symbol)
        if passed.endswith("aimed threat"):
            total += weight
    return total


def matches(text: str | None, machine: Grammar) -> list[float]:
    """Scores of all clauses of a whole text in which a learnt word matches."""
    lower = (text or "").lower()
    if not any(machine.insults.weight(w) for w in set(WORD.findall(lower))):
        return []
    found = []
    for clause in CLAUSE.split(lower):
        tokens = WORD.findall(clause)
        if any(machine.insults.weight(w) for w in tokens):
            found.append(clause_score(tokens, machine))
    return found


def threats(text: str | None, machine: Grammar) -> list[float]:
    """Scores of all clauses of a whole text in which an aimed threat matches, learnt words or not."""
    lower = (text or "").lower()
    if not THREATENING.search(lower):
        return []
    found = [WORD.findall(clause) for clause in CLAUSE.split(lower)]
    scores = [clause_threat(tokens, machine) for tokens in found if any(machine.threats.weight(w) for w in tokens)]
    return [x for x in scores if x]


def features(text: str | None, machine: Grammar) -> list[float]:
    found, aimed = matches(text, machine), threats(text, machine)
    own = [1.0, max(found), math.log1p(sum(found)), len(found) / (1 + len(CLAUSE.findall(text)))] if found else [0.0] * 4
    return [*own, math.log1p(sum(aimed))]


def variants(weights: dict[str, float]) -> list[Grammar]:
    """The grammar as it is, then with each other choice alone."""
    return [grammar(weights)] + [grammar(weights, **{name: v}) for name, values in CHOICES.items() for v in values[1:]]


def chosen_arcs(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, float]:
    """Of each arc's weights the one under which the regression fits best; ``x`` holds all variants' features."""

    def loss(own: np.ndarray) -> float:
        p = np.clip(_sigmoid(own, train(own, y, weight)), 1e-9, 1 - 1e-9)
        return -float((weight * np.where(y == 1, np.log(p), np.log(1 - p))).sum() / weight.sum())

    losses = [loss(x[:, k]) for k in range(x.shape[1])]
    out, at = dict(DEFAULTS), 1
    for name, values in CHOICES.items():
        best = min(range(1, len(values)), key=lambda k: losses[at + k - 1])
        if losses[at + best - 1] < losses[0] - LEAST_GAIN:
            out[name] = values[best]
        at += len(values) - 1
    return out


def lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings (``abcd*``) with their log-odds, from rows (text, label).

    What is counted are different clauses, so that copies of one document count once.
    """
    lower = F.lower(F.translate(F.col("text"), UPPER, LOWER))
    clauses = (
        sample.select("label", F.explode(F.split(lower, CLAUSE.pattern)).alias("clause"))
        .groupBy("clause")
        .agg(F.min("label").alias("label"))
    )
    own = F.array_distinct(F.regexp_extract_all("clause", F.lit(r"([\p{L}]+)"), 1))

    def beginnings(n: int) -> Column:
        longer = F.filter("own", lambda w: F.char_length(w) > n)
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    starts = [beginnings(n) for n in BEGINNINGS]
    terms = clauses.select("label", own.alias("own")).select("label", F.explode(F.array_distinct(F.concat("own", *starts))).alias("term"))
    totals = clauses.groupBy().agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    counts = terms.groupBy("term").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("clean"))
    share = (totals[0] + 1) / (totals[0] + totals[1] + 2)
    odds = F.log((F.col("toxic") + 0.5) / (totals[0] + 1)) - F.log((F.col("clean") + 0.5) / (totals[1] + 1))
    own_share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = 2 * (
        F.col("toxic") * F.log(F.greatest(own_share, F.lit(1e-9)) / share)
        + F.col("clean") * F.log(F.greatest(1 - own_share, F.lit(1e-9)) / (1 - share))
    )
    good = counts.select("term", "toxic", odds.alias("odds"), ((ratio >= LEAST_RATIO) & (odds >= LEAST_WEIGHT)).alias("keep")).where("keep")
    strength = F.col("odds") * F.sqrt("toxic")
    rows = good.orderBy(strength.desc(), "term").limit(LEXICON_SIZE).collect()
    return {r["term"]: r["odds"] for r in rows}


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the last number is the intercept."""
    x = np.column_stack((x, np.ones(len(x))))
    weight = weight / weight.mean()
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 1e-1 * b
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-1 * np.eye(len(b))
        b = b - np.linalg.solve(curve, slope)
    return b


def _sigmoid(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ b[:-1] + b[-1], -30, 30)))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Every row with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    The lexicon and the regression learn from at most ``training_rows`` labelled documents,
    about as many of each label and weighted by what they stand for, none held out. Labels other than 0 and 1, null ids, and ids with both labels are not learnt from; without any label of one kind all
    scores are the share of label 1 (0 if there are none). Null and empty texts have no clause
    and are scored like any text without a match. Rows with the same id are scored each by its
    own text; a null id is never held out. Columns of the added names are replaced; an empty
    table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    chosen = labelled_sample(training_labels(docs, labels, doc_id, label, *HELD_OUT), training_rows)
    own = docs.where(~held_out(doc_id, *HELD_OUT)).select(field(doc_id).alias("key"), field(text).cast("string").alias("text"))
    sample = own.join(F.broadcast(chosen), "key")
    kinds = {r[0] for r in chosen.select("label").distinct().collect()}
    model: tuple | float = float(next(iter(kinds), 0.0))
    if len(kinds) == 2:
        weights = context.broadcast(lexicon(sample))

        def pools(made) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Features, labels and weights of the sample; of rows with the same id one is learnt from."""

            @F.arrow_udf("array<double>")
            def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
                machines = made()
                for batch in texts:
                    yield pa.array([[v for m in machines for v in features(x, m)] for x in batch.to_pylist()], pa.list_(pa.float64()))

            rows = sample.select("key", "label", "weight", found("text").alias("x")).groupBy("key", "label", "weight").agg(F.min("x").alias("x"))
            rows = sorted(rows.collect())
            x = np.array([r["x"] for r in rows]).reshape(len(rows), -1, FEATURES)
            return x, np.array([r["label"] for r in rows]), np.array([r["weight"] for r in rows])

        x, y, weight = pools(lambda: variants(weights.value))
        if len(x):
            arcs = chosen_arcs(x, y, weight)
            if arcs != DEFAULTS:
                x, y, weight = pools(lambda: [grammar(weights.value, **arcs)])
            model = (weights.value, arcs, train(x[:, 0], y, weight))
        else:
            model = 0.5
    sent = context.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if isinstance(sent.value, float):
            for batch in texts:
                yield pa.array(np.full(len(batch), sent.value))
            return
        weights, arcs, b = sent.value
        machine = grammar(weights, **arcs)
        for batch in texts:
            x = np.array([features(t, machine) for t in batch.to_pylist()]).reshape(-1, FEATURES)
            yield pa.array(_sigmoid(x, b))

    whole = docs.select(packed(docs).alias("row"), held_out(doc_id, *HELD_OUT).alias("held"), scored(field(text).cast("string")).alias("p"))
    return unpacked(
        whole,
        "row",
        {"held_out": F.col("held"), "score": F.col("p"), "predicted": (F.col("p") >= THRESHOLD).cast("int")},
    )
