"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3, letters in lower
case, everything else one space) that occur in both, over the root of the product of their
numbers of n-grams. Landmark texts span a Nyström feature space, in which one ridge
regression per language separates it from the rest. As the kernel is linear in the n-gram
indicators, landmarks and regressions fold into one weight per n-gram and language; a batch
of texts is scored by one product of its indicator matrix with these weights.

N-grams are told apart by a hash of 16 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import field, held_out, packed, runs_on_executors, unpacked
from eventmart.llm.learning import labelled_sample

runs_on_executors(__name__)

SLOT_BITS = 16
SLOTS = 1 << SLOT_BITS
TRAINING_ROWS = 2400
LANDMARKS = 128
RIDGE = 1e-2
HELD_OUT = (4, 2)
BATCH = 64
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _letters


def grams(text: str | None) -> np.ndarray | None:
    """Slots of all n-grams of a whole text, with repeats; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, np.uint32(32))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # of each run of other characters one space stays
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint32)
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77) + np.uint32(2)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
    mixed = np.concatenate((codes * np.uint32(0x165667B1), two * np.uint32(0x9E3779B1), three * np.uint32(0x9E3779B1)))
    return mixed >> np.uint32(32 - SLOT_BITS)


@F.arrow_udf(T.ArrayType(T.IntegerType()))  # no session is needed yet
def _slots(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        rows = [grams(x) for x in batch.to_pylist()]
        yield pa.array([[] if x is None else np.unique(x).astype(np.int32) for x in rows], pa.list_(pa.int32()))


def train(rows: list, *, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray]:
    """Languages and the weights (slots x languages) from rows with ``slots`` and ``label``."""
    rows = [(np.asarray(r["slots"], np.int64), r["label"]) for r in rows if r["slots"]]
    names = sorted({label for _, label in rows})
    if not rows:
        return names, np.zeros((SLOTS, 0), np.float32)
    marks = np.zeros((SLOTS, min(landmarks, len(rows))), np.float32)
    for k in range(marks.shape[1]):
        own = rows[k][0]
        marks[own, k] = 1 / np.sqrt(len(own))
    kernel = np.stack([marks[own].sum(0) / np.sqrt(len(own)) for own, _ in rows]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[: marks.shape[1]])
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = kernel @ whiten
    wanted = np.array([[1.0 if label == name else -1.0 for name in names] for _, label in rows])
    fitted = np.linalg.solve(
        features.T @ features + ridge * len(rows) * np.eye(features.shape[1]) / features.shape[1], features.T @ wanted
    )
    margins = features @ fitted
    own = wanted.argmax(1)
    # a softmax over the margins; its sharpness is the likeliest on the training rows
    sharp = max((2.0, 4.0, 8.0, 16.0), key=lambda t: _log_softmax(margins * t)[np.arange(len(own)), own].sum())
    return names, (marks.astype(np.float64) @ (whiten @ fitted) * sharp).astype(np.float32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def score(texts: list, names: list[str], weights: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Predicted language and its probability for a list of texts."""
    best, sure = [], np.zeros(len(texts))
    for start in range(0, len(texts), BATCH):
        part = [grams(x) for x in texts[start : start + BATCH]]
        has = np.zeros((len(part), SLOTS), np.float32)
        for k, own in enumerate(part):
            if own is not None:
                has[k, own] = 1
        n = np.maximum(has.sum(1, keepdims=True), 1)
        chance = np.exp(_log_softmax((has @ weights) / np.sqrt(n))) if names else np.zeros((len(part), 1))
        at = chance.argmax(1)
        for k, own in enumerate(part):
            known = own is not None and names
            best.append(names[at[k]] if known else UNKNOWN)
            sure[start + k] = chance[k, at[k]] if known else 0.0
    return best, sure


def language_id(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    training_rows: int = TRAINING_ROWS,
    landmarks: int = LANDMARKS,
) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` (its probability) and ``held_out``.

    Learns from at most ``training_rows`` documents with a language, about as many of each,
    none of them held out; their whole texts come to the driver as sets of n-gram slots, at
    most 65,536 numbers each. Text that is null, empty or without a letter is ``und`` with
    score 0, and so is everything if no row can be learnt from. Rows with the same id are
    judged each by its own text; a null id is never held out. Columns of the added names are
    replaced; an empty table gives an empty result.
    """
    may_learn = ~held_out(doc_id, *HELD_OUT) & field(lang).isNotNull() & field(doc_id).isNotNull() & field(text).isNotNull()
    known = docs.where(may_learn).select(field(doc_id).alias("key"), field(lang).cast("string").alias("label"))
    chosen = labelled_sample(known, training_rows).select("key", "label").distinct()
    texts = docs.where(may_learn).select(
        field(doc_id).alias("key"), field(lang).cast("string").alias("label"), field(text).cast("string").alias("text")
    )
    slots = texts.join(F.broadcast(chosen), ["key", "label"]).select("key", "label", _slots("text").alias("slots"))
    rows = slots.groupBy("key", "label").agg(F.min("slots").alias("slots"))  # of rows with the same id one is learnt from
    # the landmarks are the first rows of a fixed shuffle
    collected = sorted(rows.collect(), key=lambda r: (zlib.crc32(f"landmark {r['key']}".encode()), r["label"]))
    names, weights = train(collected, landmarks=landmarks)
    model = docs.sparkSession.sparkContext.broadcast((names, weights))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            best, sure = score(batch.to_pylist(), *model.value)
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(sure, pa.float64())], ["lang_pred", "score"])

    scored = docs.select(packed(docs).alias("row"), held_out(doc_id, *HELD_OUT).alias("held"), predict(field(text).cast("string")).alias("found"))
    return unpacked(
        scored,
        "row",
        {"lang_pred": F.col("found.lang_pred"), "score": F.col("found.score"), "held_out": F.col("held")},
    )


def accepted(scored: DataFrame, *, least: float = 0.4) -> DataFrame:
    """The rows of ``language_id`` that name a language with at least this probability."""
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
