"""Bounded samples of labelled rows, the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import field, held_out, written


def draw(key) -> F.Column:
    """A number from 0 to 1 made from a key alone."""
    return F.shiftrightunsigned(F.xxhash64(key), 11) / F.lit(float(1 << 53))


def labelled_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """``key``, ``label`` and ``weight`` of at most ``rows`` rows of (key, label).

    Labels come about equally often, as far as there are rows; ``weight`` is how many rows a
    row stands for. Which ones are taken depends on nothing but the keys.
    """
    counts = written(labelled.groupBy("label").count(), "label-counts")
    ranked = labelled.join(counts, "label").withColumn("rank", draw(F.col("key")) * F.col("count"))
    taken = ranked.orderBy("rank", "key", "label").limit(rows)
    taken = written(taken.select("key", "label", "count"), "sample")
    own = taken.groupBy("label").agg(F.count(F.lit(1)).alias("taken"))  # of at most ``rows`` rows
    return taken.join(F.broadcast(own), "label").select("key", "label", (F.col("count") / F.col("taken")).alias("weight"))


def training_labels(docs: DataFrame, labels: DataFrame, doc_id: str, label: str, parts: int, part: int) -> DataFrame:
    """(key, label) of the documents that may be learnt from: labelled 0 or 1, not both, not held out."""
    marks = (
        labels.select(field(doc_id).alias("key"), field(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where("label = most")
        .drop("most")
    )
    ids = docs.where(~held_out(doc_id, parts, part)).select(field(doc_id).alias("key")).distinct()
    return ids.join(marks, "key")
