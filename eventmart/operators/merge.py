"""Keyed upserts into a snapshot-versioned mart."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.windows import DateWindow
from eventmart.storage import files
from eventmart.storage.snapshots import BATCH, KEY_HASH, NULL_DAY, Mart, Snapshot

# Files below this size are packed into files of about this size.
FILE_BYTES = 64 << 20
# The history's key hashes are asked first if it has so many times the rows of the source; a
# source of more keys would hit nearly every directory.
HASHES_FROM = 4


class DuplicateKeys(ValueError):
    """The source of an upsert holds a key more than once."""


def upsert(
    mart: Mart,
    source: DataFrame,
    *,
    unique: bool = False,
    stable_in: DateWindow | None = None,
) -> Snapshot:
    """Replace rows with a matching key, insert the others, keep unmatched target rows.

    The source is evaluated once: it is written as its own batch and everything
    after reads only that batch's key column. If the source is small, the key hashes of the
    history tell which directories can hold any of its keys; no other one is read. A target directory is then dropped if
    all its rows are replaced, kept by reference if none is, and only otherwise
    are its surviving rows rewritten. A replay rewrites nothing.

    ``unique``: a gate has already shown that the source holds no key twice.
    ``stable_in``: a gate has shown that no source key lies in the target outside
    this window, so other target dates need not be scanned for matches.
    """
    key = mart.spec.key
    base = mart.ensure()
    incoming = mart.write(source)
    keys = mart.scan([d for d in incoming if d.rows]).select(key)
    if not unique:
        _require_unique(keys, key, mart.spec.name)

    undated = [d for d in base.directories if d.day == NULL_DAY] if stable_in else []
    candidates = _possible(mart, [*base.within(stable_in), *undated], incoming)
    replaced = _replaced_rows(mart, candidates, keys)
    partly = [d for d in candidates if 0 < replaced.get(d.path, 0) < d.rows]
    gone = {d.path for d in candidates if replaced.get(d.path, 0) > 0}

    survivors = []
    if partly:
        rest = mart.scan(partly).join(keys, key, "left_anti")
        survivors = mart.write(rest.select(*mart.spec.schema.names))
    kept = [d for d in base.directories if d.path not in gone]
    return mart.commit([*incoming, *survivors, *kept], base)


def _require_unique(keys: DataFrame, key: str, name: str) -> None:
    repeated = keys.groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        raise DuplicateKeys(f"{name}: source repeats values of {key}")


def _possible(mart: Mart, directories, incoming) -> list:
    """The directories that can hold a key of the incoming batch, told by key hashes alone."""
    hashed = [d for d in directories if d.hashed]
    if sum(d.rows for d in hashed) < HASHES_FROM * sum(d.rows for d in incoming):
        return list(directories)
    wanted = mart.key_hashes([d for d in incoming if d.rows]).select(KEY_HASH)
    names = [BATCH, *([mart.spec.partition] if mart.spec.partition else [])]
    hits = mart.key_hashes(hashed).join(wanted, KEY_HASH, "left_semi").select(*names).distinct()
    # One row per directory of the manifest.
    found = {(r[0], str(r[1] or NULL_DAY) if len(names) > 1 else None) for r in hits.collect()}
    return [d for d in directories if not d.hashed or (d.batch, d.day) in found]


def _replaced_rows(mart: Mart, directories, keys: DataFrame) -> dict[str, int]:
    """Rows per target directory whose key occurs in the source (keys only are read)."""
    if not directories:
        return {}
    key, day = mart.spec.key, mart.spec.partition
    parts = [F.col(BATCH)] + ([F.col(day).cast("string").alias("day")] if day else [])
    target = mart.scan(directories, keep_batch=True).select(key, *parts)
    names = [BATCH] + (["day"] if day else [])
    matched = target.join(keys, key, "left_semi").groupBy(*names).count()
    # One row per directory of the manifest.
    found = {(r[BATCH], r["day"] if day else None): r["count"] for r in matched.collect()}
    return {
        d.path: found.get((d.batch, None if d.day == NULL_DAY else d.day), 0)
        for d in directories
    }


def packing(mart: Mart, directories, file_bytes: int = FILE_BYTES) -> DataFrame:
    """One row per data file: batch, day, file_name, file_path, length, ``bin`` and ``moves``.

    The files below ``file_bytes`` of a date are put into bins in order of size, a new bin
    where the sizes so far reach the next multiple of ``file_bytes``. A file moves if it
    shares its bin. Spark lists the directories; no content is read.
    """
    found = mart.listed(directories)
    small = F.col("length") < file_bytes
    order = Window.partitionBy("day", small).orderBy("length", "file_path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("length").over(order), F.lit(0))
    binned = found.withColumn("bin", F.when(small, F.floor(before / file_bytes).cast("long")))
    shared = F.count(F.lit(1)).over(Window.partitionBy("day", "bin")) > 1
    return binned.withColumn("moves", F.col("bin").isNotNull() & shared)


def compact(mart: Mart, window: DateWindow | None = None, file_bytes: int = FILE_BYTES) -> Snapshot:
    """Pack the small files of each date (of ``window``) into files of about ``file_bytes``.

    Only files that share a bin are read and rewritten, a bin as one file of less than twice
    ``file_bytes``. A larger file stays where it is, also if small ones lay beside it: the
    manifest then lists the files that still count.
    """
    base = mart.ensure()
    inside = base.within(window)
    if not inside:
        return base
    scratch = f"{mart.root}/packing/{uuid.uuid4().hex}"
    plan = packing(mart, inside, file_bytes)
    plan.withColumn("at", F.dense_rank().over(Window.partitionBy("moves").orderBy("day", "bin")) - 1).write.parquet(scratch)
    plan = mart.spark.read.parquet(scratch)
    touched = plan.groupBy("batch", "day").agg(
        F.count_if("moves").alias("moved"),
        F.collect_list(F.when(~F.col("moves"), F.col("file_name"))).alias("kept"),
        F.collect_list(F.when(F.col("moves"), F.col("file_name"))).alias("gone"),
    )
    # One row per directory that loses files; large files and what lies beside them by name.
    found = {(r["batch"], r["day"]): r for r in touched.where("moved > 0").collect()}
    if not found:
        files.remove(mart.spark, scratch)
        return base
    sources, rest = [], []
    for d in inside:
        row = found.get((d.batch, d.day))
        if row:
            sources.append(replace(d, files=tuple(sorted(row["gone"])) if row["kept"] else d.files))
            if row["kept"]:
                rest.append(replace(d, files=tuple(sorted(row["kept"]))))
    moves = plan.where("moves").select("file_path", "at")
    bins = moves.agg(F.max("at")).first()[0] + 1
    rows = mart.scan(sources, keep_file=True).join(moves, "file_path")
    packed = mart.write(rows.repartitionById(bins, F.col("at").cast("int")).select(*mart.spec.schema.names), arranged=True)
    files.remove(mart.spark, scratch)
    taken = {d.path for d in sources}
    return mart.commit([*packed, *mart.counted(rest), *(d for d in base.directories if d.path not in taken)], base)
