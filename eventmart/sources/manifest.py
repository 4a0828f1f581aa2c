"""Manifests of NDJSON data sets: writing them and verifying files against them.

``manifest.json`` holds the totals and names the folder with the file entries, which stay
where Spark computed them, as NDJSON, so neither writing nor verifying gathers them on the
driver. Manifests of other writers, with the entries in an array ``files``, are read as well.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.schemas import MANIFEST, MANIFEST_FILE
from eventmart.session import small_frame
from eventmart.sources.raw import SourceRejected, scan_events, scan_users
from eventmart.storage import files

ENTRIES = "manifest-files"
KINDS = ("events", "users")
MOST_FILE_BYTES = (1 << 31) - 1024


def _relative(spark: SparkSession, root: str) -> Column:
    """A scanned file's path below ``root``."""
    base = re.sub("^([a-z0-9]+):/+", r"\1:/", files.qualified(spark, root)).rstrip("/")
    one_slash = F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):/+", "$1:/")
    encoded = F.substring(one_slash, len(base) + 2, 1 << 16)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _long_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(uri, sha256) of text files of any length.

    A digest reads a file from its start to its end, so its lines, in the order of their blocks,
    meet in one task, sorted on disk and hashed batch by batch. Line feeds are put back; a
    byte order mark that the reader takes off is told from the size of the file.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished():
            for mark, state in states.items():
                missing = size - len(mark) - length
                if missing in (0, 1):
                    state.update(b"\n" * missing)
                    return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([state.hexdigest()])], ["uri", "sha256"])
            raise RuntimeError(f"{uri}: {length} of {size} bytes were read")

        uri, size, length, states = None, 0, 0, {}
        for batch in batches:
            uris = batch.column("uri").to_pylist()
            at = 0
            while at < len(uris):
                end = at + 1
                while end < len(uris) and uris[end] == uris[at]:
                    end += 1
                if uris[at] != uri:
                    if uri is not None:
                        yield finished()
                    uri, size, length = uris[at], batch.column("size")[at].as_py(), -1
                    states = {mark: hashlib.sha256(mark) for mark in (b"", b"\xef\xbb\xbf")}
                text = b"\n".join(batch.column("line").slice(at, end - at).to_pylist())
                text = text if length < 0 else b"\n" + text
                length = max(length, 0) + len(text)
                for state in states.values():
                    state.update(text)
                at = end
        if uri is not None:
            yield finished()

    place = [F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")]
    size = F.col("_metadata.file_size").alias("size")
    lines = spark.read.option("lineSep", "\n").text(paths)
    lines = lines.select(F.col("_metadata.file_path").alias("uri"), *place, size, F.col("value").cast("binary").alias("line"))
    sorted_lines = lines.repartition("uri").sortWithinPartitions("uri", "block", "at").select("uri", "size", "line")
    return sorted_lines.mapInArrow(hashed, "uri string, sha256 string")


def measure(spark: SparkSession, root: str) -> DataFrame:
    """Path, row count and SHA-256 of every data file below ``root/raw``.

    Rows are counted from a splittable text scan with one partial count per task. A file
    below 2 GiB is one row when its digest is made, a longer one is read by lines.
    """
    folders = [f"{root}/raw/{kind}" for kind in KINDS if files.exists(spark, f"{root}/raw/{kind}")]
    text = spark.read.option("recursiveFileLookup", True).text(folders)
    counts = (
        text.where(F.trim("value") != "")
        .groupBy(F.col("_metadata.file_path").alias("uri"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    fits = F.col("length") <= MOST_FILE_BYTES
    found = binary.select(F.col("_metadata.file_path").alias("uri"), _relative(spark, root).alias("path"), "length")
    digests = binary.where(fits).select(F.col("_metadata.file_path").alias("uri"), F.sha2("content", 256).alias("sha256"))
    long = [r["path"] for r in binary.where(~fits).select("path").collect()]  # the names of long files only
    if long:
        digests = digests.unionAll(_long_digests(spark, long))
    joined = found.join(digests, "uri").join(counts, "uri", "left")
    return joined.select("path", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "sha256")


def write(
    spark: SparkSession, root: str, events: int, users: int, start_id: int, partitioned_by: list[str]
) -> dict:
    target = f"{root}/{ENTRIES}"
    measure(spark, root).write.json(target)
    head = {"format": "ndjson", "events": events, "users": users, "start_id": start_id}
    if partitioned_by:
        head["partitioned_by"] = partitioned_by
    head["files_in"] = ENTRIES
    files.create_text(spark, f"{root}/manifest.json", json.dumps(head, indent=2) + "\n")
    return head


def totals(spark: SparkSession, root: str) -> dict:
    text = files.read_text(spark, f"{root}/manifest.json")
    if text is None:
        raise SourceRejected(f"{root} has no manifest")
    return json.loads(text)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """File entries of a data set's manifest."""
    folder = totals(spark, root).get("files_in")
    if folder:
        return spark.read.schema(MANIFEST_FILE).json(f"{root}/{folder}")
    document = spark.read.schema(MANIFEST).option("multiLine", True).json(f"{root}/manifest.json")
    return document.select(F.inline("files"))


def audit(spark: SparkSession, root: str) -> DataFrame:
    """Every listed or present file with its kind and status.

    ``ok``, ``missing``, ``checksum``, ``rows`` (count differs), ``outside`` (the
    path leaves the data set) or ``unlisted`` (present but in no entry).
    """
    want = listed(spark, root).select(
        "path", F.col("rows").alias("listed_rows"), F.col("sha256").alias("listed_sha256")
    )
    found = measure(spark, root)
    outside = F.col("path").rlike(r"^/|^[a-z0-9]+:|(^|/)\.\.(/|$)")
    status = (
        F.when(F.col("listed_sha256").isNull(), "unlisted")
        .when(outside, "outside")
        .when(F.col("sha256").isNull(), "missing")
        .when(F.col("sha256") != F.col("listed_sha256"), "checksum")
        .when(F.col("rows") != F.col("listed_rows"), "rows")
        .otherwise("ok")
    )
    return want.join(found, "path", "full").select(
        "path",
        F.split("path", "/").getItem(1).alias("kind"),
        "listed_rows",
        F.col("rows").alias("found_rows"),
        status.alias("status"),
    )


def audit_totals(spark: SparkSession, root: str) -> DataFrame:
    """Per kind: declared total, listed and found rows, and files by outcome."""
    head = totals(spark, root)
    declared = small_frame(spark, [(k, head[k]) for k in KINDS], "kind string, declared long")
    checked = audit(spark, root).groupBy("kind")
    listed_only = F.col("status") != "unlisted"
    summed = checked.agg(
        F.sum("listed_rows").alias("listed_rows"),
        F.sum(F.when(listed_only, F.col("found_rows"))).alias("found_rows"),
        F.count_if((F.col("status") != "ok") & listed_only).alias("bad_files"),
        F.count_if(~listed_only).alias("unlisted_files"),
    )
    return declared.join(summed, "kind", "left")


def load_verified(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Plain scans of a data set, after every file passed the audit and none is unlisted.

    All is decided per file, so no row is joined with the list of files.
    """
    for row in audit_totals(spark, root).collect():  # one row per kind
        wrong = row.bad_files or row.unlisted_files
        if wrong or row.listed_rows != row.declared or row.found_rows != row.declared:
            raise SourceRejected(f"{root}: {row.asDict()}")
    scans = {"events": scan_events, "users": scan_users}
    return {kind: scan(spark, f"{root}/raw/{kind}") for kind, scan in scans.items()}
