"""SentencePiece encoding and decoding with a relational lattice.

No piece of a vocabulary reaches over a border between two characters that stand side by side in
no piece, so texts fall apart there into short units, and equal units get equal pieces.

Units are counted over all texts. The commonest, up to a fixed number, are encoded as a relation:
their substrings are exploded, joined to the piece table, the edges grouped by unit, and folded
with Spark's ``aggregate``. For a unigram model the fold is Viterbi's: the path of the largest
sum of scores. A merge model (BPE) is defined by another order, the edge of best score between
two neighbours first, and the fold over the same edges takes that one. The outcome is a
dictionary of bounded size that every task holds; the texts themselves never move. A unit that is
not in the dictionary is run through the same recurrence in the task that meets it.

Characters without a piece become their UTF-8 bytes, so that decoding gives the text back.
"""

from __future__ import annotations

import ctypes
import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import field, packed, runs_on_executors, unpacked, written

runs_on_executors(__name__)

SPACE = "▁"
DICTIONARY = 1 << 19
#: Longer units are not in the dictionary: the borders of one are bits of a long.
UNIT_CHARS = 60
#: A task of the lattice has about so many units.
TASK_UNITS = 8192
#: Different units that a task counts before it passes the counts on.
FLUSH = 200_000
#: Texts that are decoded at once.
DECODED_ROWS = 200
#: Texts are put together in parts of about so many characters, to bound memory.
PART_CHARS = 1_000_000


@dataclass
class Vocabulary:
    """Pieces with ids and scores; ids of the 256 bytes; the score of a character without piece."""

    pieces: dict[str, tuple[int, float]]
    bytes: list[int]
    texts: list[bytes]
    merges: bool = False

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.missing = min((s for _, s in self.pieces.values()), default=0.0) - 10.0
        pairs = {(a, b) for p in self.pieces for a, b in zip(p, p[1:], strict=False)}
        chars = sorted({c for pair in pairs for c in pair})
        self.number = {c: k + 1 for k, c in enumerate(chars)}
        self.adjacent = np.zeros((len(chars) + 1,) * 2, bool)
        for a, b in pairs:
            self.adjacent[self.number[a], self.number[b]] = True

    def plain(self) -> tuple:
        """What a task makes the vocabulary from again."""
        return self.pieces, self.bytes, self.texts, self.merges

    def table(self) -> np.ndarray:
        """Number of every code point among those that stand side by side in pieces, else 0."""
        out = np.zeros(0x110000, np.int16)
        for c, k in self.number.items():
            out[ord(c)] = k
        return out


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, read where the driver runs."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = SentencePieceProcessor(model_file=path)
    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).trainer_spec
    if spec.model_type not in (spec.UNIGRAM, spec.BPE):
        raise ValueError("neither a unigram nor a merge model")
    pieces, byte_ids, texts = {}, [0] * 256, []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            byte_ids[int(piece[3:5], 16)] = k
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            texts.append(b"")
        else:
            pieces[piece] = (k, float(model.get_score(k)))
            texts.append(piece.replace(SPACE, " ").encode())
    return Vocabulary(pieces, byte_ids, texts, spec.model_type == spec.BPE)


def pieces_of(unit: str, known: Vocabulary) -> list[int]:
    """The recurrence for one unit, as the lattice has it."""
    out = []
    for start, end in _merged(unit, known) if known.merges else _best_path(unit, known):
        found = known.pieces.get(unit[start:end])
        out += [found[0]] if found else [known.bytes[b] for b in unit[start:end].encode()]
    return out


def _best_path(unit: str, known: Vocabulary) -> list[tuple[int, int]]:
    """The largest sum of scores; of equal ones that of the longer last piece."""
    score, back = [0.0], [0]
    for end in range(1, len(unit) + 1):
        best, begin = float("-inf"), end - 1
        for start in range(max(0, end - known.longest), end):
            found = known.pieces.get(unit[start:end])
            if found or end - start == 1:
                total = score[start] + (found[1] if found else known.missing)
                if total > best:
                    best, begin = total, start
        score.append(best)
        back.append(begin)
    out, end = [], len(unit)
    while end:
        out.append((back[end], end))
        end = back[end]
    return out[::-1]


def _merged(unit: str, known: Vocabulary) -> list[tuple[int, int]]:
    """Neighbours merged, the best score and then the leftmost first."""
    end_of = list(range(1, len(unit) + 1))  # by start; 0 once a part is gone
    start_of = list(range(-1, len(unit)))  # by end: the start of the part that ends there
    waiting: list[tuple[float, int, int, int]] = []

    def offer(start: int) -> None:
        border = end_of[start]
        if border < len(unit):
            found = known.pieces.get(unit[start : end_of[border]])
            if found:
                heapq.heappush(waiting, (-found[1], start, border, end_of[border]))

    for k in range(len(unit) - 1):
        offer(k)
    while waiting:
        _, start, border, end = heapq.heappop(waiting)
        if end_of[start] == border and end_of[border] == end:
            end_of[start], end_of[border], start_of[end] = end, 0, start
            offer(start)
            if start:
                offer(start_of[start])
    out, start = [], 0
    while start < len(unit):
        out.append((start, end_of[start]))
        start = end_of[start]
    return out


def units(text: str | None, known: Vocabulary, table: np.ndarray) -> list[str]:
    """The text, spaces marked and one put before it, cut wherever no piece can reach."""
    if not text:
        return []
    marked = SPACE + text.replace(" ", SPACE)
    at = table[np.frombuffer(marked.encode("utf-32-le"), np.uint32)]
    cuts = np.flatnonzero(~known.adjacent[at[:-1], at[1:]]) + 1
    cuts = [0, *cuts.tolist(), len(marked)]
    return [marked[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _give_back() -> None:
    """Returns freed memory to the system: Spark keeps Python workers, and allocators keep what was freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def _count(send) -> object:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()  # what earlier tasks of this worker left
        known = Vocabulary(*send.value)
        table, counts = known.table(), Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["unit", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(units(text.as_py(), known, table))
                if len(counts) > FLUSH:
                    yield rows()
                    counts.clear()
                    _give_back()
        yield rows()
        counts.clear()
        _give_back()

    return count


def lattice(words: DataFrame, pieces: DataFrame, known: Vocabulary, tasks: int) -> DataFrame:
    """``unit`` with its pieces' ``ids`` (-1 for a character without piece) and ``ends``.

    Rows are dealt by unit once; exploding and joining to the small piece table keep that, so
    the edges are grouped where they are.
    """
    at = words.select("unit").repartition(tasks, "unit").withColumn("size", F.char_length("unit"))
    starts = at.withColumn("start", F.explode(F.sequence(F.lit(1), "size")))
    reach = F.least(F.lit(known.longest), F.col("size") - F.col("start") + 1)
    parts = starts.withColumn("long", F.explode(F.sequence(F.lit(1), reach)))
    parts = parts.withColumn("piece", F.substring("unit", F.col("start"), F.col("long")))
    edges = parts.join(F.broadcast(pieces), "piece", "left").where((F.col("long") == 1) | F.col("id").isNotNull())
    edges = edges.select(
        "unit", "size", (F.col("start") - 1).alias("start"), (F.col("start") + F.col("long") - 1).alias("end"),
        F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("score", F.lit(known.missing)).alias("score"),
    )
    return _merge_fold(edges) if known.merges else _viterbi_fold(edges)


def _viterbi_fold(edges: DataFrame) -> DataFrame:
    grouped = edges.groupBy("unit", "size").agg(F.collect_list(F.struct("start", "end", "id", "score")).alias("edges"))

    def step(best: Column, end: Column) -> Column:
        into = F.filter("edges", lambda x: x["end"] == end)
        paths = F.transform(
            into,
            lambda x: F.struct(
                (F.get(best, x["start"])["score"] + x["score"]).alias("score"), (-x["start"]).alias("back"), x["id"].alias("id")
            ),
        )
        return F.concat(best, F.array(F.array_max(paths)))

    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"), F.lit(-1).alias("id")))
    best = grouped.select("unit", "size", F.aggregate(F.sequence(F.lit(1), "size"), begin, step).alias("best"))

    def follow(path: Column, _: Column) -> Column:
        own = F.get("best", path["end"])
        piece = F.struct(own["id"].alias("id"), path["end"].alias("end"))
        before = F.struct((-own["back"]).alias("end"), F.concat(F.array(piece), path["path"]).alias("path"))
        return F.when(path["end"] == 0, path).otherwise(before)

    none = F.array().cast("array<struct<id: int, end: int>>")
    path = F.aggregate(F.sequence(F.lit(1), "size"), F.struct(F.col("size").alias("end"), none.alias("path")), follow)["path"]
    return best.select("unit", F.transform(path, lambda p: p["id"]).alias("ids"), F.transform(path, lambda p: p["end"]).alias("ends"))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _merge_fold(edges: DataFrame) -> DataFrame:
    """The state is a long whose bits are the borders that are left."""
    inner = (_bit(F.col("end")) - _bit(F.col("start") + 1)).alias("inner")
    outer = (_bit(F.col("end")) + _bit(F.col("start"))).alias("outer")
    edge = F.struct((-F.col("score")).alias("rank"), "start", "end", "id", inner, outer)
    grouped = edges.groupBy("unit", "size").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    grouped = grouped.withColumn("long", F.filter("edges", lambda x: x["inner"] != 0))

    def step(borders: Column, _: Column) -> Column:
        merges = F.filter(
            "long",
            lambda x: (borders.bitwiseAND(x["outer"]) == x["outer"]) & (F.bit_count(borders.bitwiseAND(x["inner"])) == 1),
        )
        return F.coalesce(borders.bitwiseAND(F.bitwise_not(F.get(merges, F.lit(0))["inner"])), borders)

    every = _bit(F.col("size") + 1) - 1
    folded = grouped.withColumn("borders", F.aggregate(F.sequence(F.lit(1), "size"), every, step))
    borders = F.col("borders")
    path = F.filter(
        "edges", lambda x: (borders.bitwiseAND(x["outer"]) == x["outer"]) & (borders.bitwiseAND(x["inner"]) == 0)
    )
    path = F.sort_array(F.transform(path, lambda x: F.struct(x["end"].alias("end"), x["id"].alias("id"))))
    return folded.select("unit", F.transform(path, lambda p: p["id"]).alias("ids"), F.transform(path, lambda p: p["end"]).alias("ends"))


@dataclass
class Dictionary:
    """Units in order of their hashes, with their pieces one after the other."""

    hashes: np.ndarray
    units: pa.LargeStringArray
    starts: np.ndarray
    ids: np.ndarray

    def plain(self) -> tuple:
        return self.hashes, self.units, self.starts, self.ids

    def places(self, wanted: list[str]) -> np.ndarray:
        """The number of each wanted unit, -1 if it is not there."""
        out = np.full(len(wanted), -1, np.int64)
        if len(self.hashes) and wanted:
            at = np.searchsorted(self.hashes, _hashes(wanted)).clip(max=len(self.hashes) - 1)
            same = pc.equal(self.units.take(pa.array(at)), pa.array(wanted, pa.large_string()))
            out = np.where(same.to_numpy(zero_copy_only=False), at, -1)
        return out


def _hashes(own: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(own, object), categorize=False)


def dictionary(spark: SparkSession, texts: DataFrame, known: Vocabulary, entries: int) -> Dictionary:
    """The pieces of the commonest units: all of at least some count, ``entries`` at most."""
    send = spark.sparkContext.broadcast(known.plain())
    counts = texts.mapInArrow(_count(send), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    counts = written(counts.where((F.col("n") > 1) & (F.char_length("unit") <= UNIT_CHARS)), "units")
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    least, total = 64, 0
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if total + r["count"] > entries:
            break
        least, total = r["level"], total + r["count"]
    rows = [(p, k, s) for p, (k, s) in known.pieces.items()]
    table = spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "id", "score"]), "piece string, id int, score double")
    tasks = 1 + total // TASK_UNITS
    encoded = written(lattice(counts.where(level >= least), table, known, tasks), "unit-pieces")
    found = encoded.toArrow().combine_chunks()
    own, parts, ends = (found.column(c).combine_chunks() for c in ("unit", "ids", "ends"))
    ids, sizes = parts.flatten().to_numpy(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    spelt = np.flatnonzero(ids < 0)  # characters that become bytes
    if len(spelt):
        unit_of, end = np.repeat(np.arange(len(own)), sizes)[spelt], ends.flatten().to_numpy()[spelt]
        as_bytes = [[known.bytes[b] for b in own[int(u)].as_py()[e - 1 : e].encode()] for u, e in zip(unit_of, end, strict=True)]
        more = np.array([len(x) - 1 for x in as_bytes])
        sizes = sizes + np.bincount(unit_of, more, len(own)).astype(np.int64)
        repeats = np.ones(len(ids), np.int64)
        repeats[spelt] += more
        ids = np.repeat(ids, repeats)
        ids[ids < 0] = [k for x in as_bytes for k in x]
    hashes = _hashes(own.to_pylist()) if len(own) else np.zeros(0, np.uint64)
    order = hashes.argsort(kind="stable")
    starts = np.concatenate(([0], np.cumsum(sizes[order]))).astype(np.int64)
    moved = np.repeat((np.cumsum(sizes) - sizes)[order] - starts[:-1], sizes[order]) + np.arange(len(ids))
    return Dictionary(hashes[order], own.cast(pa.large_string()).take(pa.array(order)), starts, ids[moved.astype(np.int64)].astype(np.int32))


def encode(
    docs: DataFrame, model: str, *, text: str = "text", ids: str = "ids", round_trip: str | None = None, entries: int = DICTIONARY
) -> DataFrame:
    """Every row with the piece ids of its whole text, as a list of integers in column ``ids``.

    ``model`` is the path of a model file on the driver. ``entries`` bounds the dictionary that is
    sent to all tasks. Null and empty texts have no pieces. Control, unknown and unused pieces
    are never used; a text that spells one is ordinary text. With ``round_trip`` a column of that
    name tells whether decoding gives the text back (null counting as empty); the task that
    encodes a text decodes it as well. Columns of the added names are replaced; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    known = vocabulary(model)
    texts = docs.select(field(text).cast("string").alias("text"))
    send = spark.sparkContext.broadcast((known.plain(), dictionary(spark, texts, known, entries).plain()))

    coded = F.arrow_udf("struct<ids: array<int>, same: boolean>")(_encode(send, round_trip is not None))
    rows = docs.select(packed(docs).alias("row"), coded(field(text).cast("string")).alias("coded"))
    added = {ids: F.col("coded.ids")} | ({round_trip: F.col("coded.same")} if round_trip else {})
    return unpacked(rows, "row", added)


def _encode(send, round_trip: bool) -> object:
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _give_back()  # what earlier tasks of this worker left
        plain, entries = send.value
        known, common = Vocabulary(*plain), Dictionary(*entries)
        table, spelt = known.table(), _spelling(known.texts)
        for batch in batches:
            # the lists go out part by part: neither this task nor Spark ever holds those of a whole batch
            for part in _parts(batch):
                seen, lists = _numbers(), []
                for x in part:
                    own = units(x, known, table)
                    lists.append(np.fromiter(map(seen.__getitem__, own), np.int64, len(own)))
                found = _lists(seen, lists, common, known)
                same = [a == (b or "") for a, b in zip(_decoded(found, spelt), part, strict=True)] if round_trip else [None] * len(part)
                yield pa.StructArray.from_arrays([found, pa.array(same, pa.bool_())], ["ids", "same"])
                _give_back()

    return coded


def _parts(batch: pa.Array) -> Iterator[list]:
    """The texts of a batch in order, in lists of about ``PART_CHARS`` characters."""
    part, size = [], 0
    for x in batch:
        part.append(x.as_py())
        size += len(part[-1] or "")
        if size > PART_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _numbers() -> defaultdict:
    """Gives every new key the next number."""
    out: defaultdict = defaultdict()
    out.default_factory = out.__len__
    return out


def _lists(seen: dict[str, int], lists: list[np.ndarray], common: Dictionary, known: Vocabulary) -> pa.Array:
    """Piece lists of texts given as lists of numbers of distinct units."""
    distinct = list(seen)
    at = common.places(distinct)
    rare = [np.array(pieces_of(distinct[k], known), np.int32) for k in np.flatnonzero(at < 0)]
    begin = np.cumsum([0, *map(len, rare)])
    flat = np.concatenate([common.ids, *rare])
    starts, sizes = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    starts[at >= 0], sizes[at >= 0] = common.starts[at[at >= 0]], np.diff(common.starts)[at[at >= 0]]
    starts[at < 0], sizes[at < 0] = len(common.ids) + begin[:-1], np.diff(begin)
    numbers = np.concatenate([*lists, np.zeros(0, np.int64)])
    counts = sizes[numbers]
    ends = np.cumsum(counts)
    values = flat[np.repeat(starts[numbers] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
    per_text = np.cumsum([0, *map(len, lists)])
    borders = np.concatenate(([0], ends))[per_text]
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values, pa.int32()))


def decode(rows: DataFrame, model: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """Every row with the text of its piece ids in column ``text``.

    A null list gives a null text, an empty one the empty text. Bytes that are no UTF-8 become the
    replacement character; ids outside the vocabulary and null ids are left out.
    """
    send = rows.sparkSession.sparkContext.broadcast(vocabulary(model).texts)

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spelt = _spelling(send.value)
        for batch in batches:
            yield pa.array(_decoded(batch, spelt), pa.string())

    whole = rows.select(packed(rows).alias("row"), decoded(field(ids).cast("array<int>")).alias("spelt"))
    return unpacked(whole, "row", {text: F.col("spelt")})


def _spelling(texts: list[bytes]) -> pa.Array:
    """What each id spells, and at the end what spells nothing."""
    return pa.array([*texts, b""], pa.binary())


def _decoded(lists: pa.Array, spelt: pa.Array) -> list:
    """The texts of lists of piece ids."""
    out, nothing = [], len(spelt) - 1
    for start in range(0, len(lists), DECODED_ROWS):
        part = lists.slice(start, DECODED_ROWS)
        own = pc.fill_null(part.flatten(), nothing).to_numpy(zero_copy_only=False)
        own = np.where((own >= 0) & (own < nothing), own, nothing)
        ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))))
        pieces = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spelt.take(pa.array(own)))
        joined = pc.if_else(part.is_null(), None, pc.binary_join(pieces, b""))
        out += [x if x is None else x.decode("utf-8", "replace").removeprefix(" ") for x in joined.to_pylist()]
    return out
