"""Exact deduplication by deterministic naming of text blocks.

Every text is cut into blocks of a fixed number of characters. The distinct blocks are
sorted and numbered, so equal blocks, and only they, get the same integer name. Then the
names of adjacent blocks are paired and the distinct pairs are numbered in the same way,
until one name is left per document. Two documents of as many blocks have the same last
name exactly if their texts are equal: no step trusts a hash.

A block travels to its name by its digest instead of its text. The digests are proven on
the data first: if two different blocks have the same one, all blocks get digests with
another salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import WHITE, field, packed, unpacked, written

BLOCK_CHARS = 8192


def normalised(text: str):
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(field(text).cast("string"), F.lit("")), WHITE + "+", " ")


def _digest(block, salt: int):
    return F.unhex(F.md5(F.concat(F.lit(f"{salt}:"), block).cast("binary")))


def _blocks(chars, size: int):
    """The text in blocks of ``size`` characters, cut in one pass; an empty text is one empty block."""
    cut = F.regexp_extract_all(chars, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(chars == "", F.array(F.lit(""))).otherwise(cut)


def _numbered(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Integer names in sorted order within each partition; distinct rows come in, so no key is hot."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _block_names(chars: DataFrame, size: int) -> tuple[DataFrame, int]:
    """The name of every distinct block, by digest, and the salt under which digests are unique."""
    salt = 0
    while True:
        block = chars.select(F.explode(_blocks(F.col("chars"), size)).alias("block"))
        distinct = block.select(_digest(F.col("block"), salt).alias("digest"), "block").distinct()
        names = written(_numbered(distinct, ["block"]).select("digest", "name"), "block-names")
        if names.count() == names.select("digest").distinct().count():
            return names, salt
        salt += 1


def _pair_names(named: DataFrame) -> DataFrame:
    """One level up: (rid, place, name, left) of half as many names a document."""
    pairs = named.groupBy("rid", F.shiftright("place", 1).alias("place")).agg(
        F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("first"),
        # the last name of an odd number has no partner
        F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("second"),
        F.max(F.shiftright(F.col("left") + 1, 1)).alias("left"),
    )
    names = written(_numbered(pairs.select("first", "second").distinct(), ["first", "second"]), "pair-names")
    return written(pairs.join(names, ["first", "second"]).select("rid", "place", "name", "left"), "names")


def exact_dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with the row that stays for its text.

    Adds ``keep_id`` (id of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256``; columns of these names are replaced, all others stay. Null text counts
    as empty; empty texts equal one another. Of equal texts the smallest id stays, null last;
    of rows repeated with that id one stays. An empty table gives an empty result. ``carry``
    names the columns that the result needs besides the id (all by default): texts that nobody
    reads need not travel along.
    """
    if block_chars < 1:
        raise ValueError("block_chars must be positive")
    kept = [field(c) for c in docs.columns if carry is None or c in (doc_id, *carry)]
    chars = docs.select(normalised(text).alias("chars"))
    names, salt = _block_names(chars, block_chars)
    digests = F.transform(_blocks(F.col("chars"), block_chars), lambda b: _digest(b, salt))
    rows = written(
        docs.select(packed(docs.select(*kept)).alias("row"), normalised(text).alias("chars"))
        .withColumn("rid", F.monotonically_increasing_id())
        .select("rid", "row", F.sha2(F.col("chars").cast("binary"), 256).alias("sha"), digests.alias("digests")),
        "documents",
    )
    size = F.size("digests")
    rest = written(
        rows.select("rid", size.alias("left"), F.posexplode("digests").alias("place", "digest"))
        .join(names, "digest")
        .select("rid", "place", "name", "left"),
        "names",
    )
    ended = []
    while True:
        ended.append(rest.where("left = 1").select("rid", "name"))
        rest = rest.where("left > 1")
        if rest.isEmpty():
            break
        rest = _pair_names(rest)
    last = ended[0]
    for more in ended[1:]:
        last = last.unionAll(more)
    named = written(
        rows.select("rid", "row", "sha", size.alias("blocks")).join(last, "rid"),
        "identities",
    )
    own = field("row").getField(doc_id)
    groups = written(
        named.groupBy("blocks", "name").agg(
            F.min(F.struct(own.isNull().alias("no_id"), own.alias("id"), F.col("rid"))).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    joined = named.join(groups, ["blocks", "name"])
    return unpacked(
        joined,
        "row",
        {
            "keep_id": F.col("keep.id"),
            "group_size": F.col("group_size"),
            "kept": F.col("rid") == F.col("keep.rid"),
            "text_sha256": F.col("sha"),
        },
    )
