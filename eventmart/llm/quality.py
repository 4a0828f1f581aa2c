"""Quality classification of documents.

Random indexing gives every word a vector: the sum, over the whole corpus, of fixed sparse
ternary vectors of what stands next to it. Words are known by a hash slot of their core (lower
case, without marks at the ends) and by one of their form (case, marks, same as the word
before), so the table has a fixed size however many words there are. A document is the mean of
its words' vectors; a two-layer network scores it, its sharpness calibrated by a temperature
fitted on rows that the network has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import field, held_out, packed, runs_on_executors, unpacked
from eventmart.llm.learning import labelled_sample, training_labels

runs_on_executors(__name__)

#: Hash slots of cores and of forms; the table of their vectors has a fixed size.
CORES = 1 << 18
FORMS = 1 << 14
SLOTS = CORES + FORMS
DIMENSIONS = 24
ONES = 4
TRAINING_ROWS = 12_000
HIDDEN = 32
HELD_OUT = (4, 2)
THRESHOLD = 0.7
SEED = 7
#: Texts are taken apart in parts of about so many characters, to bound memory.
PART_CHARS = 1_000_000


@cache
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ones of each slot's index vector."""
    rng = np.random.default_rng(SEED)
    places = rng.permuted(np.tile(np.arange(DIMENSIONS, dtype=np.int8), (SLOTS, 1)), axis=1)[:, :ONES]
    return places.astype(np.int32), rng.choice(np.array([-1, 1], np.int32), (SLOTS, ONES))


def parts(texts: list) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``PART_CHARS`` characters; a longer text is alone."""
    part, size = [], 0
    for x in texts:
        if part and size + len(x or "") > PART_CHARS:
            yield part
            part, size = [], 0
        part.append(x or "")
        size += len(x or "")
    if part:
        yield part


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts in order: text number, slot of the core, slot of the form."""
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pa.array(texts, pa.large_string())))
    flat, at = split.flatten(), pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    codes, own = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    core = pc.replace_substring_regex(pc.utf8_lower(own), r"^[^\pL\pN]+|[^\pL\pN]+$", "")
    marks = pc.replace_substring_regex(own, r"[\pL\pN].*[\pL\pN]|[\pL\pN]", "_")
    case = np.where(pc.utf8_is_upper(own), "U", np.where(pc.utf8_is_title(own), "T", "l")).astype(object)
    cores = pd.util.hash_array(core.to_numpy(zero_copy_only=False).astype(object))
    forms = pd.util.hash_array(case + marks.to_numpy(zero_copy_only=False).astype(object))
    same = np.zeros(len(codes), np.uint64)
    same[1:] = (codes[1:] == codes[:-1]) & (at[1:] == at[:-1])
    form = (forms[codes] * np.uint64(2) + same) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(50)  # 14 bits
    full = pc.binary_length(own).to_numpy(zero_copy_only=False)[codes] > 0  # an empty text has one empty word
    return at[full], (cores % CORES).astype(np.int64)[codes][full], CORES + form.astype(np.int64)[full]


def neighbours(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of slots (of a word, of what stands near it)."""
    at, core, form = words(texts)
    for distance in (1, 2):
        same = at[distance:] == at[:-distance]
        left, right = core[:-distance][same], core[distance:][same]
        yield left, right
        yield right, left
    same = at[1:] == at[:-1]
    yield form[1:][same], form[:-1][same]
    yield form[:-1][same], form[1:][same]
    yield core, form
    yield form, core


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total = np.zeros(SLOTS * DIMENSIONS, np.int32)
    for batch in batches:
        for part in parts(batch.column(0).to_pylist()):
            for slot, near in neighbours(part):
                for k in range(ONES):
                    np.add.at(total, slot * DIMENSIONS + places[near, k], signs[near, k])
    table = total.reshape(SLOTS, DIMENSIONS).astype(np.int64)
    found = np.flatnonzero(table.any(1))
    columns = [pa.array(found), *(pa.array(table[found, k]) for k in range(DIMENSIONS))]
    yield pa.RecordBatch.from_arrays(columns, ["slot", *_dimensions()])


def _dimensions() -> list[str]:
    return [f"v{k}" for k in range(DIMENSIONS)]


def word_vectors(docs: DataFrame, text: str) -> np.ndarray:
    """Vectors of unit length of all slots, from all texts; a table of fixed size.

    Every task adds up its texts and gives one row for a slot at most. Sums are whole numbers
    and so do not depend on their order.
    """
    sums = docs.select(field(text).cast("string").alias("text")).mapInArrow(
        _sums, "slot long, " + ", ".join(f"{c} long" for c in _dimensions())
    )
    rows = sums.groupBy("slot").agg(*[F.sum(c).alias(c) for c in _dimensions()]).toPandas()
    table = np.zeros((SLOTS, DIMENSIONS), np.float32)
    table[rows["slot"].to_numpy(np.int64)] = rows[_dimensions()].to_numpy(np.float32)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)


def pooled(texts: list, vectors: np.ndarray) -> np.ndarray:
    """Per text the means of its words' core vectors, form vectors and form index vectors."""
    places, signs = index_vectors()
    index = np.zeros((FORMS, DIMENSIONS), np.float32)
    np.put_along_axis(index, places[CORES:], signs[CORES:].astype(np.float32), axis=1)
    out = [np.zeros((0, 3 * DIMENSIONS), np.float32)]
    for part in parts(texts):
        at, core, form = words(part)
        mean = np.zeros((len(part), 3 * DIMENSIONS), np.float32)
        if len(at):
            first = np.flatnonzero(np.diff(at, prepend=-1))
            count = np.diff(first, append=len(at))[:, None]
            for k, (table, slot) in enumerate(((vectors, core), (vectors, form), (index, form - CORES))):
                mean[at[first], k * DIMENSIONS : (k + 1) * DIMENSIONS] = np.add.reduceat(table[slot], first) / count
        out.append(mean)
    return np.concatenate(out)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, hidden: int = HIDDEN, rounds: int = 60) -> dict:
    """A two-layer network and its temperature."""
    rng = np.random.default_rng(SEED)
    shift, scale = x.mean(0), x.std(0) + 1e-4
    x, weight = (x - shift) / scale, weight / weight.mean()
    order = rng.permutation(len(x))
    unseen, seen = order[: len(x) // 5], order[len(x) // 5 :]
    net = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second, step = [0 * p for p in net], [0 * p for p in net], 0
    for _ in range(rounds):
        for rows in np.array_split(rng.permutation(seen), max(1, len(seen) // 128)):
            inner = x[rows] @ net[0] + net[1]
            out = np.maximum(inner, 0)
            error = (_sigmoid(out @ net[2] + net[3]) - y[rows]) * weight[rows] / len(rows)
            back = np.outer(error, net[2]) * (inner > 0)
            slope = [x[rows].T @ back + 1e-4 * net[0], back.sum(0), out.T @ error, error.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(slope):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] = net[k] - 3e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model = {"net": net, "shift": shift, "scale": scale, "temperature": 1.0}
    if len(unseen):
        margin = _margin(x[unseen], net)

        def loss(t):
            p = np.clip(_sigmoid(margin / t), 1e-6, 1 - 1e-6)
            return -(weight[unseen] * np.where(y[unseen] == 1, np.log(p), np.log(1 - p))).sum()

        model["temperature"] = min(np.geomspace(0.7, 7, 41), key=loss)
    return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _margin(x: np.ndarray, net: list) -> np.ndarray:
    return np.maximum(x @ net[0] + net[1], 0) @ net[2] + net[3]


def score(x: np.ndarray, model: dict) -> np.ndarray:
    return _sigmoid(_margin((x - model["shift"]) / model["scale"], model["net"]) / model["temperature"])


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Every row with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on).

    Word vectors come from all texts. The network learns from at most ``training_rows``
    labelled documents, about as many of each label and weighted by what they stand for, none
    held out. Labels other than 0 and 1, null ids, and ids with both labels are not learnt
    from; without any label of one kind all scores are the share of label 1 (0.5 if there are
    none). Null and empty texts are scored like a text without words. Rows with the same id are
    scored each by its own text; a null id is never held out. Columns of the added names are
    replaced; an empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs, text))

    @F.arrow_udf("array<float>")
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(list(pooled(batch.to_pylist(), vectors.value)), pa.list_(pa.float32()))

    chosen = labelled_sample(training_labels(docs, labels, doc_id, label, *HELD_OUT), training_rows)
    own = docs.where(~held_out(doc_id, *HELD_OUT)).select(field(doc_id).alias("key"), field(text).cast("string").alias("text"))
    pools = own.join(F.broadcast(chosen), "key").select("key", "label", "weight", features("text").alias("x"))
    # of rows with the same id one is learnt from
    rows = sorted(pools.groupBy("key", "label", "weight").agg(F.min("x").alias("x")).collect())
    kinds = {r["label"] for r in rows}
    if len(kinds) == 2:
        x = np.array([r["x"] for r in rows])
        model = train(x, np.array([r["label"] for r in rows]), np.array([r["weight"] for r in rows]))
    else:
        model = float(next(iter(kinds), 0.5))
    sent = context.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            if isinstance(sent.value, float):
                yield pa.array(np.full(len(batch), sent.value))
            else:
                yield pa.array(score(pooled(batch.to_pylist(), vectors.value), sent.value).astype(float))

    whole = docs.select(packed(docs).alias("row"), held_out(doc_id, *HELD_OUT).alias("held"), scored(field(text).cast("string")).alias("p"))
    return unpacked(
        whole,
        "row",
        {"held_out": F.col("held"), "score": F.col("p"), "predicted": (F.col("p") >= THRESHOLD).cast("int")},
    )
