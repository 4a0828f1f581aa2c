"""Mixing of sources to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import WHITE, field, packed, unpacked, written
from eventmart.session import small_frame

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix"
WORD = WHITE.replace("[", "[^") + "+"


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in order of code points, null last, from 0.

    The sources are sorted by range; the driver only learns how many rows each range has.
    """
    order = [F.col("source").isNull(), F.col("source")]
    ranges = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(
        sources.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
        ),
        "sources",
    )
    first, before = [], 0
    for part, n in sorted(tuple(r) for r in rows.groupBy("part").count().collect()):
        first.append((part, before))
        before += n
    starts = small_frame(sources.sparkSession, first, "part int, before long")
    return rows.join(starts, "part").select("source", "source_size", (F.col("place") + F.col("before")).alias("place"))


def targets(sized: DataFrame, *, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of rows with ``source`` and ``size``.

    All sizes times ``share`` are dealt out by weight. A source gets ``most`` times its size
    at most; what is over goes to the others by weight until none is above.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    rows = written(
        _ranked(sources).select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("limit")),
        "weights",
    )
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    per_weight, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(per_weight) > F.col("limit")
        taken, weight_left, n = rows.agg(
            F.coalesce(F.sum(F.when(above, F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count_if(above),
        ).first()
        if n == full or not weight_left:
            break
        full, per_weight = n, (share * total - taken) / weight_left
    by_weight = F.col("weight") * F.lit(per_weight)
    target = F.least(by_weight, F.col("limit").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """Every row with ``size`` (words), ``source_size``, ``target`` of its source, and ``copies``.

    A source's repetition rate is its target over its size. Each document comes floor(rate)
    times, and once more if a number from 0 to 1 made from its id and the seed is below the
    fraction; no state, so reruns agree. Rows with the same id decide alike; a null id
    decides by the text. Null text has size 0. A source without words has target 0 and its
    documents come 0 times. A null source is a source of its own. Columns of the added names
    are replaced. An empty table gives an empty result.
    """
    content = field(text).cast("string")
    sized = docs.select(
        packed(docs).alias("row"),
        field(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(content, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(field(doc_id).cast("string"), F.md5(content.cast("binary")), F.lit("-")).alias("key"),
    )
    rates = written(
        targets(sized.select("source", "size"), weights=weights, share=share, most=most).withColumn(
            "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        ),
        "rates",
    ).withColumnRenamed("source", "of")
    draw = F.conv(F.substring(F.md5(F.concat("key", F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    whole = F.floor("rate").cast("long")
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return unpacked(
        joined,
        "row",
        {
            "size": F.col("size"),
            "source_size": F.col("source_size"),
            "target": F.col("target"),
            "copies": whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0),
        },
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the columns of ``docs``, each row as often as ``mix_plan`` says."""
    needed = [field(options.get(k, k)) for k in ("doc_id", "text", "source")]
    plan = mix_plan(docs.select(packed(docs).alias("whole row"), *needed), **options)
    copies = F.array_repeat(field("whole row"), F.col("copies").cast("int"))
    return plan.select(F.explode(copies).alias("row")).select("row.*")
