"""N-gram Jaccard join with a MinHash LSH forest.

A text is the set of its five-word shingles. Texts of the same set form a class of copies and
go on as one node. A node's MinHash signature gives one label per tree; the trees are prefix
tries of these labels. Two nodes of similarity s share a prefix of d values in some of t trees with
probability 1 - (1 - s^d)^t.

The longest prefix comes first: where many nodes share it, each is compared with one of
them, the centre. Two nodes within half the allowed distance of a centre are linked, as
the Jaccard distance is a metric. Such a cluster's links are counted without looking at its pairs, so a group of
near copies costs as much as it has members.

Then nodes of different clusters are brought together where they share the shortest prefix
that could ever be needed. From the estimates of its pairs each node takes the longest prefix
that meets the target recall for the least similar of them, and all pairs that share as much
are verified with the shingles of their whole texts.

A pair is looked at in the first tree where it meets and nowhere else, so links can be counted
without listing them. A trie node of many members is cut into blocks, and each pair of
blocks is a group of its own: no group is larger than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import field, packed, row_identity, runs_on_executors, written

runs_on_executors(__name__)

WORDS = 5
SIMILARITY = 0.8
TREES = 16
DEPTH = 6
TARGET = 0.9999
BLOCK = 256
#: Pairs whose signatures agree this much less than wanted (seven deviations) are not verified.
SLACK = 0.3
#: Nodes that share a longest prefix, from which on one of them becomes a centre; trees that are asked.
CLUSTER_FROM = 64
CLUSTER_TREES = 4
#: A similarity estimated from signatures may be so far from the true one (three deviations).
DOUBT = 0.12
SEED = 5

_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list, n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each whole text.

    Words are what white space separates. A text of fewer than ``n`` words is one shingle;
    one without words has none.
    """
    split = [(x or "").split() for x in texts]
    flat = [w for words in split for w in words]
    if not flat:
        return [np.zeros(0, np.uint64) for _ in texts]
    codes, own = pd.factorize(np.array(flat, object))
    hashes = pd.util.hash_array(own)[codes]
    out, at = [], 0
    for words in split:
        h = hashes[at : at + len(words)]
        at += len(words)
        size = min(n, len(h))
        if not size:
            out.append(h)
            continue
        mixed = np.full(len(h) - size + 1, np.uint64(size))
        for k in range(size):
            mixed = (mixed * _BASE) ^ (h[k : len(h) - size + 1 + k] >> np.uint64(7)) + h[k : len(h) - size + 1 + k]
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(np.unique(mixed ^ (mixed >> np.uint64(32))))
    return out


def signature(shingled: np.ndarray) -> np.ndarray:
    """MinHash values of one set: TREES x DEPTH numbers."""
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
    least = np.full(TREES * DEPTH, np.uint32(0xFFFFFFFF))
    short = (shingled >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 2048):
        values = short[start : start + 2048, None] * factor + shift
        values ^= values >> np.uint32(15)
        least = np.minimum(least, (values * np.uint32(0x2C1B3C6D)).min(0))
    return least


@F.arrow_udf(T.StructType().add("set", T.BinaryType()).add("signature", T.BinaryType()))  # no session is needed yet
def _signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sets = [s for start in range(0, len(batch), 500) for s in shingles(batch.slice(start, 500).to_pylist())]
        keys = pa.array([md5(s.tobytes()).digest() for s in sets], pa.binary())
        yield pa.StructArray.from_arrays([keys, pa.array([signature(s).tobytes() for s in sets], pa.binary())], ["set", "signature"])


def found_with(similarity, depth: int, trees: int = TREES):
    """Probability that two sets share a prefix of ``depth`` values in some tree."""
    return 1 - (1 - np.asarray(similarity) ** depth) ** trees


def shortest_prefix(similarity: float, target: float) -> int:
    """The longest prefix that meets the target even if all links are just similar enough."""
    return max([d for d in range(1, DEPTH + 1) if found_with(similarity, d) >= target], default=1)


def prefix_borders(floor: int, target: float) -> list[float]:
    """The similarities from which on prefixes of ``floor`` + 1, ... ``DEPTH`` values meet the target."""
    grid = np.linspace(0, 1, 100_001)
    return [float(grid[found_with(grid, d) >= target][0]) for d in range(floor + 1, DEPTH + 1)]


def pairs_of(signatures: np.ndarray, tree: int, blocks: np.ndarray, clusters: np.ndarray, across: bool, floor: int, similarity: float):
    """The pairs that a group is in charge of: rows, shared prefix, estimated similarity.

    Pairs of one cluster (-1: none) are known already.
    """
    if across:
        first = blocks.min()
        a, b = np.meshgrid(np.flatnonzero(blocks == first), np.flatnonzero(blocks != first), indexing="ij")
        a, b = a.ravel(), b.ravel()
    else:
        a, b = np.triu_indices(len(signatures), 1)
    out = []
    for start in range(0, len(a), 1 << 16):
        x, y = a[start : start + (1 << 16)], b[start : start + (1 << 16)]
        other = (clusters[x] != clusters[y]) | (clusters[x] < 0)
        x, y = x[other], y[other]
        same = (signatures[x] == signatures[y]).reshape(len(x), TREES, DEPTH)
        guess = same.mean((1, 2))
        shared = np.logical_and.accumulate(same, 2).sum(2)
        meets = shared >= floor
        good = (meets.argmax(1) == tree) & meets[:, tree] & (guess >= similarity - SLACK)
        out.append((x[good], y[good], shared.max(1)[good], guess[good]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of sorted rows, also those that cross a batch's end."""
    left = None
    for batch in batches:
        rows = batch.to_pandas()
        if left is not None:
            rows = pd.concat((left, rows), ignore_index=True)
        if not len(rows):
            continue
        values = rows[keys].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]).any(1))))
        for k in range(len(starts) - 1):
            yield rows.iloc[starts[k] : starts[k + 1]]
        left = rows.iloc[starts[-1] :].reset_index(drop=True)
    if left is not None and len(left):
        yield left


GROUP = ["bucket", "low", "high"]


def _batches(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _meet(floor: int, similarity: float) -> Callable:
    """Per group, the nodes with a pair to look at, and the least estimate of their pairs."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [*GROUP, "tree", "block", "node", "cluster"]
        names, types = [*kept, "shared", "estimate"], [pa.int64()] * (len(kept) + 1) + [pa.float64()]
        out = []
        for own in runs(batches, GROUP):
            if len(own) > 1:
                signatures = np.stack([np.frombuffer(s, np.uint32) for s in own["signature"]])
                blocks, across = own["block"].to_numpy(), own["low"].iloc[0] != own["high"].iloc[0]
                if across and len(np.unique(blocks)) < 2:
                    continue
                clusters = own["cluster"].to_numpy()
                x, y, shared, guess = pairs_of(signatures, own["tree"].iloc[0], blocks, clusters, across, floor, similarity)
                longest, least = np.zeros(len(own), np.int64), np.full(len(own), np.inf)
                for side in (x, y):
                    np.maximum.at(longest, side, shared)
                    np.minimum.at(least, side, guess)
                for k in np.flatnonzero(longest):
                    row = own.iloc[k]
                    out.append((*(int(row[c]) for c in kept), int(longest[k]), float(least[k])))
            if len(out) >= 5000:
                yield _batches(out, names, types)
                out = []
        yield _batches(out, names, types)

    return meet


def similar(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs of sets are similar enough, exactly."""
    sizes = np.array([len(s) for s in sets])
    if len(x) < 4 * len(sets):
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y, strict=True)], float)
    else:
        # many pairs of few sets: one matrix product over the shingles that occur twice
        values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(count > 1) - 1
        owner = np.repeat(np.arange(len(sets)), sizes)
        twice = count[at] > 1
        owner, at = owner[twice], place[at[twice]]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int((count > 1).sum()), 8192):
            part = (at >= start) & (at < start + 8192)
            has = np.zeros((len(sets), 8192), np.float32)
            has[owner[part], at[part] - start] = 1
            both += has @ has.T
        common = both[x, y].astype(float)
    return common >= similarity * (sizes[x] + sizes[y] - common) - 1e-9


def _verify(floor: int, similarity: float) -> Callable:
    """Per group, every linked node with the documents it links to and the least node it is joined with."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["node", "links", "root"], [pa.int64()] * 3
        out = []
        for own in runs(batches, GROUP):
            blocks, across = own["block"].to_numpy(), own["low"].iloc[0] != own["high"].iloc[0]
            if len(own) > 1 and not (across and len(np.unique(blocks)) < 2):
                sets = shingles(own["text"].tolist())
                signatures = np.stack([signature(s) for s in sets])
                depth, clusters = own["depth"].to_numpy(), own["cluster"].to_numpy()
                x, y, shared, _ = pairs_of(signatures, own["tree"].iloc[0], blocks, clusters, across, floor, similarity)
                far = shared >= np.minimum(depth[x], depth[y])
                x, y = x[far], y[far]
                good = similar(sets, x, y, similarity) if len(x) else np.zeros(0, bool)
                x, y = x[good], y[good]
                node, size = own["node"].to_numpy(), own["size"].to_numpy()
                links = np.bincount(x, size[y], len(own)) + np.bincount(y, size[x], len(own))
                root = node.copy()
                while len(x):
                    before = root.copy()
                    np.minimum.at(root, x, before[y])
                    np.minimum.at(root, y, before[x])
                    if (root == before).all():
                        break
                out += [(int(node[k]), int(links[k]), int(root[k])) for k in np.flatnonzero(links)]
            if len(out) >= 5000:
                yield _batches(out, names, types)
                out = []
        yield _batches(out, names, types)

    return verify


def _settle(similarity: float) -> Callable:
    """Per group of a centre and some nodes, the nodes that are similar enough to it."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["node", "cluster"], [pa.int64()] * 2
        out = []
        for own in runs(batches, ["centre", "block"]):
            node, centre = own["node"].to_numpy(), int(own["centre"].iloc[0])
            at, others = np.flatnonzero(node == centre), np.flatnonzero(node != centre)
            if len(at) and len(others):
                sets = shingles(own["text"].tolist())
                good = similar(sets, others, np.repeat(at[:1], len(others)), similarity)
                out += [(int(k), centre) for k in node[others[good]]]
            if len(out) >= 5000:
                yield _batches(out, names, types)
                out = []
        yield _batches(out, names, types)

    return settle


def _buckets(floor: int, trees: int = TREES) -> Callable:
    """The node of each tree's trie that a signature's first ``floor`` values name."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            values = np.stack([np.frombuffer(s, np.uint32) for s in batch.column("signature").to_pylist()])
            prefixes = values.reshape(len(batch), TREES, DEPTH)[:, :trees, :floor].astype(np.uint64)
            key = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), (len(batch), trees)).copy()
            for k in range(floor):
                key = (key ^ prefixes[:, :, k]) * _BASE
                key ^= key >> np.uint64(31)
            repeated = [pa.array(np.repeat(batch.column(c).to_numpy(), trees)) for c in ("node", "cluster")]
            own = [pa.array(key.view(np.int64).ravel()), pa.array(np.tile(np.arange(trees), len(batch))), *repeated]
            yield pa.RecordBatch.from_arrays(own, ["bucket", "tree", "node", "cluster"])

    return buckets


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of rows (node, root), root below node: every node with the least of its component.

    Alternates large-star and small-star steps. A node of many edges is one row per task when
    its least neighbour is sought, and the join that follows may be split at run time.
    """

    def lowered(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        return pairs.join(written(least, "least-neighbours"), "a")

    edges = written(edges.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = written(lowered(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "edges")
        low = lowered(large)
        small = low.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = written(small.unionAll(low.select("a", F.col("least").alias("b"))).distinct(), "edges")


def _with_texts(docs: DataFrame, needed: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with the text of their ``ident``. Rows repeated with id and text are one text here."""
    needed = written(needed, "needed")
    texts = docs.select(row_identity(doc_id, text).alias("ident"), field(text).cast("string").alias("text"))
    # what is needed grows with the table, so it is never broadcast, however small it is at first
    own = texts.join(needed.select("ident").distinct().hint("merge"), "ident", "left_semi").dropDuplicates(["ident"])
    return needed.join(own, "ident")


BUCKETS = "bucket long, tree long, node long, cluster long"


def _clusters(docs: DataFrame, classes: DataFrame, doc_id: str, text: str, similarity: float) -> DataFrame:
    """(node, cluster) of the nodes near a centre, centres included, where many share a longest prefix."""
    plain = classes.select("node", "signature", F.lit(-1).cast("long").alias("cluster"))
    deep = plain.mapInArrow(_buckets(DEPTH, CLUSTER_TREES), BUCKETS).select("bucket", "node")
    centres = deep.groupBy("bucket").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("members"))
    centres = written(centres.where(F.col("members") >= CLUSTER_FROM).select("bucket", "centre"), "centres")
    chosen = deep.join(centres, "bucket").groupBy("node").agg(F.min("centre").alias("centre")).where("node <> centre")
    chosen = written(chosen, "chosen")
    cut = chosen.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("cut"))
    members = chosen.join(cut, "centre").select("centre", F.pmod(F.xxhash64("node"), F.col("cut")).alias("block"), "node")
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1))
    needed = members.unionAll(cut.select("centre", blocks.alias("block"), F.col("centre").alias("node")))
    needed = needed.join(classes.select("node", F.col("least.ident").alias("ident")), "node")
    compared = _with_texts(docs, needed, doc_id, text).repartition("centre", "block").sortWithinPartitions("centre", "block")
    near = written(compared.mapInArrow(_settle((1 + similarity) / 2), "node long, cluster long"), "near-centres")
    heads = near.select(F.col("cluster").alias("node")).distinct()
    return written(near.join(heads, "node", "left_anti").unionAll(heads.select("node", F.col("node").alias("cluster"))), "clusters")


def _members(nodes: DataFrame) -> DataFrame:
    """Every node once for each pair of blocks of its bucket that it is in.

    A cluster of more than a block has blocks of its own, which are not paired with one
    another; all other nodes of a bucket share blocks. Buckets of one cluster alone are left out.
    """
    size = nodes.groupBy("bucket", "cluster").agg(F.count(F.lit(1)).alias("n"))
    part = F.when((F.col("cluster") >= 0) & (F.col("n") > BLOCK), F.col("cluster")).otherwise(-1)
    apart = F.when(F.col("cluster") >= 0, 1).otherwise(F.col("n"))
    parts = size.groupBy("bucket", part.alias("part")).agg(F.ceil(F.sum("n") / BLOCK).alias("cut"), F.sum(apart).alias("apart"))
    met = parts.groupBy("bucket").agg(F.sum("apart").alias("apart"), F.sort_array(F.collect_list(F.struct("part", "cut"))).alias("parts"))
    met = written(met.where("apart > 1").drop("apart"), "buckets")

    def blocks(keep) -> F.Column:
        return F.aggregate(F.filter("parts", keep), F.lit(0).cast("long"), lambda a, p: a + p["cut"])

    joined = nodes.join(met, "bucket").withColumn(
        "part", F.when(F.exists("parts", lambda p: p["part"] == F.col("cluster")), F.col("cluster")).otherwise(-1)
    )
    first, own = blocks(lambda p: p["part"] < F.col("part")), blocks(lambda p: p["part"] == F.col("part"))
    dealt = joined.select("bucket", "tree", "node", "cluster", "part", first.alias("first"), own.alias("own"), blocks(lambda p: F.lit(True)).alias("all"))
    other = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("all") - 1),
        lambda b: (F.col("part") < 0) | (b < F.col("first")) | (b >= F.col("first") + F.col("own")),
    )
    dealt = dealt.select("bucket", "tree", "node", "cluster", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("own"))).alias("block"), F.explode(other).alias("other"))
    return dealt.select("bucket", "tree", "node", "cluster", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def _joined(docs: DataFrame, doc_id: str, text: str, similarity: float, target: float) -> DataFrame:
    """Every row's ident and id with its group, its copies' representative and its links."""
    floor = shortest_prefix(similarity, target)
    signed = written(
        docs.select(row_identity(doc_id, text).alias("ident"), field(doc_id).alias("id"), _signed(field(text).cast("string")).alias("s")).select(
            "ident", "id", "s.set", "s.signature"
        ),
        "signatures",
    )
    classes = written(
        signed.groupBy("set")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "ident")).alias("least"),
            F.count(F.lit(1)).alias("size"),
            F.min("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    clusters = _clusters(docs, classes, doc_id, text, similarity)
    known = classes.join(clusters, "node", "left").select("node", "signature", F.coalesce("cluster", F.lit(-1).cast("long")).alias("cluster"))
    nodes = known.mapInArrow(_buckets(floor), BUCKETS)
    grouped = _members(nodes).join(classes.select("node", "signature"), "node").repartition(*GROUP).sortWithinPartitions(*GROUP)
    schema = "bucket long, low long, high long, tree long, block long, node long, cluster long, shared long, estimate double"
    meetings = written(grouped.mapInArrow(_meet(floor, similarity), schema), "meetings")
    # each node's own prefix: as long as the least similar of its pairs allows
    least = F.greatest(F.lit(similarity), F.min("estimate") - DOUBT)
    depth = sum((F.when(least >= s, 1).otherwise(0) for s in prefix_borders(floor, target)), F.lit(floor))
    depths = written(meetings.groupBy("node").agg(depth.cast("long").alias("depth")), "depths")
    looked = meetings.join(depths, "node").where(F.col("shared") >= F.col("depth"))
    looked = looked.select(*GROUP, "tree", "block", "node", "cluster", "depth").join(
        classes.select("node", "size", F.col("least.ident").alias("ident")), "node"
    )
    compared = _with_texts(docs, looked, doc_id, text).repartition(*GROUP).sortWithinPartitions(*GROUP)
    verified = compared.mapInArrow(_verify(floor, similarity), "node long, links long, root long")
    sizes = clusters.join(classes.select("node", "size"), "node")
    whole = sizes.groupBy("cluster").agg(F.sum("size").alias("all"), F.min("node").alias("root"))
    inside = sizes.join(whole, "cluster").select("node", (F.col("all") - F.col("size")).alias("links"), "root")
    links = written(verified.unionAll(inside), "links")
    roots = components(links.where("root < node").select("node", "root"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = written(
        classes.select("node", "set", "least", "size")
        .join(roots, "node", "left")
        .join(counted, "node", "left")
        .select("set", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")),
        "nodes",
    )
    groups = written(known.groupBy("root").agg(F.min("least").alias("first")), "groups")
    known = written(known.join(groups, "root").select("set", "least", "first", "n_links"), "known")
    return signed.select("ident", "id", "set").join(known, "set")


def ngram_join(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, target: float = TARGET
) -> DataFrame:
    """One row per document: id, ``class_id``, ``copy_id`` and ``n_links``.

    ``copy_id`` is the smallest id among documents of the same shingle set, ``n_links`` the
    number of other documents of Jaccard similarity ``similarity`` or more, copies counted,
    and ``class_id`` the smallest id of the group that links connect. Null and empty texts have
    no shingle and are copies of one another alone; shorter texts than a shingle are one
    shingle. Null ids come last in any order. Each repeated row counts as a document. An empty
    table gives an empty result.
    """
    rows = _joined(docs, doc_id, text, similarity, target)
    return rows.select(F.col("id").alias(doc_id), F.col("first.id").alias("class_id"), F.col("least.id").alias("copy_id"), "n_links")


def one_of_each(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, target: float = TARGET
) -> DataFrame:
    """The rows of ``docs`` without all but the first document (smallest id) of each group.

    Of rows repeated with the same id and text one stays. Null ids come last, so a document
    without an id stays only if no other of its group has one. Null, empty and blank texts are copies
    of one another, so one of them stays. An empty table stays empty. All columns stay as they are.
    """
    rows = _joined(docs, doc_id, text, similarity, target)
    stay = rows.where(F.col("ident") == F.col("first.ident")).groupBy("ident").agg(F.count(F.lit(1)).alias("rows"))
    stay = written(stay, "stay")
    whole = docs.select(row_identity(doc_id, text).alias("ident"), packed(docs).alias("row")).join(stay, "ident")
    single = whole.where("rows = 1").select("row")
    repeated = whole.where("rows > 1").groupBy("ident").agg(F.min("row").alias("row")).select("row")
    return single.unionAll(repeated).select("row.*")
