"""Removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import BLANKS, LOWER, UPPER, WHITE, field, packed, row_identity, unpacked, written

MIN_DOCS = 10
MIN_CHARS = 1


#: Copies are told by five-word shingles: bands of the least hashes of a share of them each.
WORDS = 5
BANDS = 8
BAND_VALUES = 3
ROUNDS = 2


def _key(line):
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    units: DataFrame | None = None,
) -> DataFrame:
    """Documents without the lines whose key occurs in at least ``min_docs`` documents.

    A line's key is the line without white space at its ends, A-Z in lower case; keys of
    fewer than ``min_chars`` characters stay. Each row counts as one document, also if an id
    or a whole row is repeated. ``text`` becomes the kept lines joined by a line break;
    ``n_lines`` (before) and ``n_dropped`` are added and replace columns of these names. Null
    text counts as empty, which is one empty line. An empty table gives an empty result.

    ``units`` (ident, unit; ident as ``row_identity`` gives it) names documents that count as
    one, such as copies of one text: their lines are not shared with anybody by that alone.

    Keys are compared by 128-bit digest, made once for each line and written, 16 bytes a line.
    Only digests are shuffled for counting, once per document and digest; a line in a third of all documents is one row per task there, and
    the join that finds its places may be split by Spark at run time. Texts move once, for
    the documents that lose lines.
    """
    content = F.coalesce(field(text).cast("string"), F.lit(""))

    def digest(key):
        return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key.cast("binary"))))

    ident = row_identity(doc_id, text).alias("ident")
    keys = F.transform(F.split(content, "\n"), _key)  # a step of its own: a name within one lambda is evaluated at each use
    lines = written(docs.select(ident, F.transform(keys, digest).alias("digests")), "line-digests")
    seen = lines.select("ident", F.explode(F.array_distinct("digests")).alias("digest")).where(F.col("digest").isNotNull())
    if units is not None:
        seen = seen.join(units, "ident").select("digest", "unit").distinct()
    shared = written(
        seen.groupBy("digest").count().where(F.col("count") >= min_docs).select("digest"),
        "shared-lines",
    )
    dropped = written(
        lines.select("ident", F.posexplode("digests").alias("place", "digest"))
        .join(shared, "digest")
        .groupBy("ident")
        .agg(F.collect_set("place").alias("places")),
        "dropped-lines",
    )
    whole = docs.select(ident, packed(docs).alias("row"), content.alias("content"))
    joined = whole.join(dropped, "ident", "left").select(
        "row", "content", "places", F.split("content", "\n").alias("lines")
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.when(F.col("places").isNull(), F.col("content")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    )
    return unpacked(
        joined,
        "row",
        {
            text: kept,
            "n_lines": F.size("lines").cast("long"),
            "n_dropped": F.coalesce(F.size("places"), F.lit(0)).cast("long"),
        },
    ).select(*[field(c) for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def near_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, unit) of every distinct row, for ``units``: rows of one group of copies have one unit.

    The hashes of a text's shingles are dealt into ``BANDS`` shares by their value, and the least
    of each share form a band; texts of similarity 0.8 have one of eight bands in common with
    probability 0.997, those of 0.3 with 0.2. A row takes the least identity among the rows that it shares a band with,
    then, in a second round, the least that any of these has taken. Texts of
    fewer shingles than ``BANDS`` bands take twice are copies only if their sets are equal. Null and empty texts are copies
    of one another. An empty table gives an empty result.
    """
    content = F.coalesce(field(text).cast("string"), F.lit(""))
    words = F.split(F.btrim(F.regexp_replace(content, WHITE + "+", " ")), " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WORDS - 1), F.lit(1)))
    hashes = F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WORDS))))

    def band(g: int) -> Column:
        share = F.filter("hashes", lambda h: F.pmod(h, F.lit(BANDS)) == g)
        return F.xxhash64(F.lit(g), F.slice(F.sort_array(share), 1, BAND_VALUES))

    bands = F.array(*[band(g) for g in range(BANDS)])
    whole = F.array(F.xxhash64(F.lit(-1), F.sort_array("hashes")))
    enough = F.size("hashes") >= 2 * BANDS * BAND_VALUES
    rows = docs.select(row_identity(doc_id, text).alias("ident"), words.alias("words")).select("ident", hashes.alias("hashes"))
    rows = rows.select("ident", F.explode(F.when(enough, bands).otherwise(whole)).alias("band"))
    rows = written(rows.distinct(), "bands")
    units = rows.select("ident", "band", F.col("ident").alias("unit"))
    for _ in range(ROUNDS):
        least = units.groupBy("band").agg(F.min("unit").alias("least"))
        taken = written(rows.join(least, "band").groupBy("ident").agg(F.min("least").alias("unit")), "units")
        units = rows.join(taken, "ident")
    return taken
