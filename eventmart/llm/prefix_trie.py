"""Prefix trie of conversations, by collapse of whole sequences.

Identical conversations become one weighted sequence, which its smallest conversation stands for.
Only these sequences are cut into prefixes. A prefix is known by a digest chained from turn to
turn, so no prefix is ever held as a whole. A sequence is a leaf unless its digest is that of
another one's proper prefix (an anti join); the weighted prefixes are then added up to nodes.

A node belongs to the smallest sequence that passes through it. The nodes of a sequence's path
that belong to it are the path's end, so a running sum from the path's end upwards has what each sequence
adds to the subtrees above, without a list of ancestors. No join is made on a key that many
rows share: values of nodes go back to the paths by (sequence, depth), which is unique, and
the few parents of a large share of all nodes are joined apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import WHITE, field, runs_on_executors, written

runs_on_executors(__name__)

#: The first turns of a conversation may come from the one whose id is the next multiple towards 0.
STRIDE = 20
MOST_SHARED = 4
WORD = WHITE.replace("[", "[^") + "+"
ROOT = hashlib.sha256(b"").digest()[:16]
#: Ids of one row of an end list, and a parent's share of all nodes from which it is joined apart.
ENDS_ROWS = 256
HOT_SHARE = 2000


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``place`` from 0, a digest of role and text, and the words of the text.

    Only digests are shuffled and sorted. Turns of the same number are ordered by digest.
    """
    said_by, said = (F.coalesce(field(c).cast("string"), F.lit("")) for c in (role, text))
    content = F.concat(F.char_length(said_by).cast("string"), F.lit(":"), said_by, said)
    rows = turns.where(field(conv_id).isNotNull()).select(
        field(conv_id).cast("long").alias("conv"),
        field(turn).cast("long").alias("turn"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv", (F.row_number().over(order) - 1).cast("long").alias("place"), "digest", "words")


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from the one it is rebuilt on."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(places: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of the conversation it is built on.

    That one is the conversation of the multiple of ``STRIDE``; it may have fewer turns or be absent.
    """
    base, shared = F.col("conv") - F.col("conv") % STRIDE, shared_turns(F.col("conv"))
    own = places.where((F.col("conv") == base) | (F.col("place") >= shared))
    first = places.where((F.col("conv") == base) & (F.col("place") < MOST_SHARED - 1))
    first = first.select(F.col("conv").alias("base"), "place", "digest", "words")
    others = places.where("place = 0").select("conv", base.alias("base"), shared.alias("shared")).where("conv <> base")
    opening = others.join(first, "base").where("place < shared")
    return own.select("conv", "place", "digest", "words").unionAll(opening.select("conv", "place", "digest", "words"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place: depth, own and parent's digest, whether it is the last."""
    names = ["conv", "depth", "words", "prefix", "parent", "last"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
    held, out = None, []
    for batch in batches:
        for conv, digest, words in zip(*(batch.column(c).to_pylist() for c in ("conv", "digest", "words")), strict=True):
            if held is not None:
                out.append((*held, held[0] != conv))
            if digest is None:  # the mark that opens each conversation
                held = (conv, 0, 0, ROOT, None)
            else:
                held = (conv, held[1] + 1, words, hashlib.sha256(held[3] + digest).digest()[:16], held[3])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types, strict=True)], names)
        out = []
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*held, True), types, strict=True)], names)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (prefix, conv) rows as rows of up to ``ENDS_ROWS`` joined ids."""

    def batch_of(rows):
        columns = zip(*rows) if rows else [[]] * 3
        types = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["prefix", "first", "ids"])

    prefix, ids = None, []
    for batch in batches:
        out = []
        for key, conv in zip(batch.column("prefix").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if ids and (key != prefix or len(ids) == ENDS_ROWS):
                out.append((prefix, ids[0], ",".join(map(str, ids))))
                ids = []
            prefix = key
            ids.append(conv)
        yield batch_of(out)
    if ids:
        yield batch_of([(prefix, ids[0], ",".join(map(str, ids)))])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each prefix' whole list, fed row by row: no list is held as a whole."""

    def batch_of(rows):
        columns = zip(*rows) if rows else [[]] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.string()], strict=True)], ["prefix", "ends"])

    prefix, state = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch.column("prefix").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key == prefix:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((prefix, state.hexdigest()))
            prefix, state = key, hashlib.sha256(ids.encode())
        yield batch_of(out)
    if state is not None:
        yield batch_of([(prefix, state.hexdigest())])


def end_lists(ends: DataFrame) -> DataFrame:
    """(prefix, ends): SHA-256 of the ascending, comma-joined ids of rows (prefix, conv).

    A list of any length is sorted in ranges over all tasks; only joined text meets in one task,
    which hashes it as it comes.
    """
    rows = ends.repartitionByRange("prefix", "conv").sortWithinPartitions("prefix", "conv")
    lists = rows.mapInArrow(_listed, "prefix binary, first long, ids string")
    return lists.repartition("prefix").sortWithinPartitions("prefix", "first").mapInArrow(_hashed, "prefix binary, ends string")


def prefix_trie(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rebuild: bool = True
) -> DataFrame:
    """One row per node of the trie of all conversations: each distinct sequence of first turns.

    ``conv_id`` (smallest member) and ``depth`` name a node, ``parent_conv_id`` is its parent's
    smallest member (null for the root), ``n_convs`` counts its members, ``n_children`` and
    ``n_leaves`` its children and the childless nodes of its subtree. ``saved_tokens`` adds
    (members - 1) x words of the last text over the subtree, ``ends_sha256`` is the digest of the ids of
    the members that end there.

    Turns are ordered by number, null first, equal numbers by a digest of role and text, so
    that repeated rows stay repeated turns. Null role or text is empty. Rows with a null
    conversation id take no part. ``rebuild`` first gives conversations the opening turns they
    share (see ``rebuilt``); one that is left without turns is a member of the root. An empty
    table gives an empty result.

    A conversation is chained turn by turn in one task, whatever its length, in constant memory.
    """
    places = written(numbered(turns, conv_id, turn, role, text), "turns")
    none = F.lit(None).cast("binary")
    marks = places.where("place = 0").select("conv", F.lit(-1).cast("long").alias("place"), none.alias("digest"), F.lit(0).cast("long").alias("words"))
    sequences = marks.unionAll(rebuilt(places) if rebuild else places)
    sequences = sequences.repartition("conv").sortWithinPartitions("conv", "place").select("conv", "digest", "words")
    chained = written(
        sequences.mapInArrow(_chain, "conv long, depth long, words long, prefix binary, parent binary, last boolean"), "chains"
    )
    ends = chained.where("last")
    collapsed = written(ends.groupBy("prefix").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight")), "collapsed")
    paths = written(chained.join(collapsed.select("conv", "weight"), "conv"), "paths")
    inner = paths.where("NOT last").select("prefix").distinct()
    leaves = collapsed.join(inner, "prefix", "left_anti").select("conv", F.lit(1).alias("leaf"))
    paths = written(paths.join(leaves, "conv", "left"), "weighted-paths")
    nodes = written(
        paths.groupBy("prefix").agg(
            F.min("conv").alias("conv"),
            F.max("depth").alias("depth"),
            F.max("words").alias("words"),
            F.max("parent").alias("parent"),
            F.sum("weight").alias("n_convs"),
            F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        ),
        "nodes",
    )
    own = nodes.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    upwards = Window.partitionBy("conv").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lifted = paths.join(own, ["conv", "depth"], "left").select("prefix", F.sum(F.coalesce("own", F.lit(0))).over(upwards).alias("saved"))
    zero, no_text = F.lit(0).cast("long"), F.lit(None).cast("string")
    parts = lifted.select("prefix", "saved", zero.alias("children"), no_text.alias("ends"))
    parts = parts.unionAll(nodes.where("parent IS NOT NULL").select("parent", zero, zero + 1, no_text))
    parts = parts.unionAll(end_lists(ends.select("prefix", "conv")).select("prefix", zero, zero, "ends"))
    summed = parts.groupBy("prefix").agg(F.sum("saved").alias("saved"), F.sum("children").alias("children"), F.max("ends").alias("ends"))
    known = written(nodes.join(summed, "prefix"), "known")

    up = known.where("children > 0").select(F.col("prefix").alias("parent"), F.col("conv").alias("parent_conv"), "children")
    hot = F.col("children") >= F.lit(max(1, known.count() // HOT_SHARE))
    few = written(up.where(hot), "hot-parents")  # at most HOT_SHARE of them: their children are all different nodes
    below = known.join(F.broadcast(few.select("parent", F.col("parent_conv").alias("hot_conv"))), "parent", "left")
    rest = up.where(~hot).select("parent", "parent_conv")
    # nodes without a parent to look up go by a key of their own
    key = F.when(F.col("hot_conv").isNull() & F.col("parent").isNotNull(), F.col("parent")).otherwise(F.col("prefix"))
    found = below.withColumn("at", key).join(rest.withColumnRenamed("parent", "at"), "at", "left")
    own_parent = F.when(F.col("parent").isNull(), F.lit(None)).otherwise(F.coalesce("hot_conv", "parent_conv"))
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        own_parent.cast("long").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
