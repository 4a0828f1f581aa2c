"""Periodic runs of words, found by internal pattern matching.

A run of period q and at least four periods holds, for the power of two b with 3q/4 < b <= 3q/2,
a block of b words that starts at a multiple of b and occurs again q words later. So each such
dyadic block asks where it occurs in its neighbouring window, from 2b/3 to 4b/3 words on: a range
successor query, answered by a wavelet tree over the suffix array, as a block's occurrences
are an interval of the suffix array. Three or more occurrences there are an arithmetic
progression whose difference is a period of the block; then the two stretches of that period, around
the block and around the progression, must end (or begin) one run period apart, which leaves
two candidate periods. One or two occurrences are candidates themselves. A candidate is extended
to both sides with the ranks of all dyadic blocks, which compare exactly.

Spark deals the texts over tasks; a task takes many short texts, or one long text, at a time.
Words that do not recur within a quarter of the stretch around them cannot be inside a run; texts are cut there first.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import field, packed, runs_on_executors, unpacked

runs_on_executors(__name__)

#: A run has at least this many words and this many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Rounds of cutting texts at words that no run can hold; it may stop at any time.
ROUNDS = 12
#: Words that a task indexes at a time, unless one text has more.
PART_WORDS = 400_000

FOUND = (
    T.StructType()
    .add("n_runs", T.LongType())
    .add("start", T.LongType())
    .add("length", T.LongType())
    .add("period", T.LongType())
    .add("exponent_milli", T.LongType())
    .add("runs_sha256", T.StringType())
    .add("collapsed", T.StringType())
)


class WaveletTree:
    """The numbers 0 to n - 1 in some order, bit by bit; queries on many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros = []  # per level, how many of the first i numbers have bit 0 there
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate(([0], np.cumsum(~ones))).astype(np.int32))
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of the numbers at low <= i < high are less than ``limit``."""
        low, high, count = low.copy(), high.copy(), np.zeros(len(low), np.int64)
        limit = np.minimum(limit, len(self.zeros[0]) - 1)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = (limit >> bit) & 1 == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of the numbers at low <= i < high."""
        low, high, n, value = low.copy(), high.copy(), n.copy(), np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value


class Index:
    """Suffix array of a sequence that ends in a number of its own, with the ranks of its dyadic blocks.

    ``ranks[k][i]`` is where the suffixes that begin like the 2^k words at i start in the suffix
    array, ``sizes[k][i]`` how many they are. Equal ranks mean equal blocks.
    """

    def __init__(self, words: np.ndarray, longest: int):
        n = len(words)
        self.ranks: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        key, order = words.astype(np.int64), None
        while True:
            order = np.argsort(key, kind="stable")
            new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            starts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            rank, count = np.empty(n, np.int32), np.empty(n, np.int32)
            rank[order] = starts[group]
            count[order] = np.diff(np.append(starts, n))[group]
            self.ranks.append(rank)
            self.sizes.append(count)
            b = 1 << (len(self.ranks) - 1)
            if 16 * b > 3 * longest or len(starts) == n:  # a run's blocks are 3/2 periods long at most
                break
            after = np.zeros(n, np.int64)
            after[: n - b] = rank[b:].astype(np.int64) + 1
            key = rank.astype(np.int64) * (n + 1) + after
        self.tree = WaveletTree(order.astype(np.int64))

    def common(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from x and y on; ``back``: up to x and y, backwards."""
        x, y, total = x.copy(), y.copy(), np.zeros(len(x), np.int64)
        n = len(self.ranks[0])
        for k in range(len(self.ranks) - 1, -1, -1):
            b, rank, going = 1 << k, self.ranks[k], np.arange(len(x))
            while len(going):
                a, c = (x[going] - b + 1, y[going] - b + 1) if back else (x[going], y[going])
                inside = (np.minimum(a, c) >= 0) & (np.maximum(a, c) < n)
                same = np.zeros(len(going), bool)
                same[inside] = rank[a[inside]] == rank[c[inside]]
                going = going[same]
                total[going] += b
                x[going] += -b if back else b
                y[going] += -b if back else b
                if k < len(self.ranks) - 1:
                    break  # twice the block would have agreed before
        return total


def _candidates(index: Index, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) pairs that the blocks of 2^k words give."""
    b, n = 1 << k, len(index.ranks[0])
    p = np.arange(0, n - b + 1, b)
    p = p[index.sizes[k][p] > 1]
    low = index.ranks[k][p].astype(np.int64)
    high = low + index.sizes[k][p]
    first = index.tree.below(low, high, p + -(-2 * b // 3))
    after = index.tree.below(low, high, p + 4 * b // 3 + 1)
    some = after > first
    p, low, high, first, after = p[some], low[some], high[some], first[some], after[some]
    one = index.tree.nth(low, high, first)
    starts, periods = [p], [one - p]
    two = np.flatnonzero(after - first == 2)
    starts.append(p[two])
    periods.append(index.tree.nth(low[two], high[two], first[two] + 1) - p[two])
    many = np.flatnonzero(after - first > 2)
    if len(many):
        at, near = p[many], one[many]
        step = index.tree.nth(low[many], high[many], first[many] + 1) - near
        ends = [x + index.common(x, x + step) for x in (at, near)]
        begins = [x - index.common(x - 1, x - 1 + step, back=True) for x in (at, near)]
        starts += [at, at]
        periods += [ends[1] - ends[0], begins[1] - begins[0]]
    starts, periods = np.concatenate(starts), np.concatenate(periods)
    return starts[periods > 0], periods[periods > 0]


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) of all runs, by start and period, of a sequence that ends in a number of its own.

    ``longest`` bounds the length of a run. Numbers that occur once end every run.
    """
    index = Index(words, longest)
    found = [np.zeros((0, 3), np.int64)]
    for k in range(len(index.ranks)):
        p, q = _candidates(index, k)
        before = index.common(p - 1, p + q - 1, back=True)
        length = before + index.common(p, p + q) + q
        good = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * q)
        found.append(np.column_stack((p - before, length, q))[good])
    runs = np.unique(np.concatenate(found), axis=0)
    # the smallest period of a stretch: its multiples have the same one
    return runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(1)))] if len(runs) else runs


def stretches(codes: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Which words may be in a run: those of stretches that hold no word without a near neighbour.

    In a run every word has the same word at most a quarter of the run away, before or after.
    """
    n = len(codes)
    keep = np.ones(n, bool)
    key = text_of * (codes.max() + 1) + codes
    order = np.argsort(key, kind="stable")
    gap = np.where(np.diff(key[order]) == 0, np.diff(order), n + 1)
    near = np.full(n, n + 1)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    for _ in range(ROUNDS):
        edge = np.concatenate(([True], (keep[1:] != keep[:-1]) | (text_of[1:] != text_of[:-1])))
        size = np.diff(np.append(np.flatnonzero(edge), n))
        size = size[np.cumsum(edge) - 1]
        now = keep & (size >= LEAST_WORDS) & (near <= size // LEAST_PERIODS)
        if (now == keep).all():
            break
        keep = now
    return keep


def runs_by_text(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, (start, length, period) by start and period."""
    sizes = np.array([len(t) for t in texts])
    flat = [w for t in texts for w in t]
    out = [np.zeros((0, 3), np.int64)] * len(texts)
    if not flat:
        return out
    codes = pd.factorize(np.array(flat, object))[0].astype(np.int64)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = np.flatnonzero(stretches(codes, text_of))
    if not len(kept):
        return out
    # stretches one after the other, each with a number of its own at its end
    cut = np.flatnonzero((np.diff(kept) > 1) | (np.diff(text_of[kept]) > 0)) + 1
    lengths = np.diff(np.concatenate(([0], cut, [len(kept)])))
    at = np.arange(len(kept)) + np.repeat(np.arange(len(lengths)), lengths)
    joined = np.empty(len(kept) + len(lengths), np.int64)
    origin = np.zeros(len(joined), np.int64)
    joined[at], origin[at] = codes[kept], kept
    joined[np.cumsum(lengths) + np.arange(len(lengths))] = codes.max() + 1 + np.arange(len(lengths))
    runs = runs_of(joined, int(lengths.max()))
    source = origin[runs[:, 0]]
    runs[:, 0] = place[source]
    for part in np.split(np.arange(len(runs)), np.flatnonzero(np.diff(text_of[source])) + 1) if len(runs) else []:
        out[text_of[source[part[0]]]] = runs[part]
    return out


def planted(words: list[bytes], doc_id) -> list[bytes]:
    """The words with the periodic ending that one in ten ids asks for."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _summary(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = runs.tolist()
    kept = np.ones(len(words), bool)
    for start, length, period in listed:
        kept[start + period : start + length] = False
    collapsed = b" ".join(words if kept.all() else [words[k] for k in np.flatnonzero(kept)]).decode()
    # shares of numbers below 2^31 differ by more than 2^-62, so this order is exact
    best = min(listed, key=lambda r: (-((r[1] << 64) // r[2]), r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    text = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
    return len(listed), *shown, hashlib.sha256(text.encode()).hexdigest(), collapsed


def _found(plant: bool):
    @F.arrow_udf(FOUND)
    def found(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows, waiting, size = [], [], 0
        keys, sizes = ids.to_pylist(), pc.binary_length(texts.fill_null("")).to_pylist()
        for k, key in enumerate(keys):
            words = (texts[k].as_py() or "").encode().split()  # splits at the white space of ASCII only
            waiting.append(planted(words, key) if plant else words)
            size += len(words)
            if size >= PART_WORDS or k == len(keys) - 1 or size + sizes[k + 1] // 2 > 4 * PART_WORDS:
                rows += map(_summary, waiting, runs_by_text(waiting))
                waiting, size = [], 0
        columns = zip(*rows, strict=True) if rows else [[]] * len(FOUND)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], FOUND.names)

    return found


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """Every row with what its text's runs of words are, and the text with each run cut to one period.

    A run is a stretch of words of smallest period q, of at least max(6, 4q) words, that no
    neighbouring word extends with that period. ``n_runs`` counts them; ``start``, ``length``,
    ``period`` and ``exponent_milli`` (1000 * length / period, rounded down) are those of the run of
    most periods (ties: smallest start, then period; null without a run); ``runs_sha256`` is
    the digest of a line ``start,length,period`` for each run by start, then period; ``collapsed`` has
    the words, joined by one space, that no run holds after its first period. These columns
    replace others of their names.

    Words are what ASCII white space separates. Null and empty texts have no word and no run.
    Repeated rows and null ids are rows like others. ``plant`` first makes the texts of one in
    ten ids periodic (see ``planted``). An empty table gives an empty result.
    """
    key, content = field(doc_id).cast("string"), field(text).cast("string")
    rows = docs.select(packed(docs).alias("row"), _found(plant)(key, content).alias("found"))
    return unpacked(rows, "row", {c: F.col("found")[c] for c in FOUND.names})
