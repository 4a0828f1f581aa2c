"""Marts as immutable Parquet batches plus one small manifest per snapshot.

Layout below a mart's root::

    data/batch=<id>/[event_date=D/]part-*.parquet   written once, never changed
    snapshots/<n>.json                              the directories a snapshot reads
    refs/main                                       number of the current snapshot

A manifest lists directories with their row counts, so its size follows the
number of (batch, date) directories, not the number of files or rows. Only what compaction
leaves of a directory is listed by file. One writer at a time is the caller's duty; a lost
race fails when the manifest is created.

Each row is stored with a 64-bit hash of its key, the filter of a directory: this one column tells
whether it can hold any of many keys, in one join for all directories (a Bloom filter would have to
be asked for every key and directory). A hash may hit by chance, so a hit is looked up in the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators.windows import DateWindow
from eventmart.schemas import MartSpec, require
from eventmart.storage import files

BATCH = "batch"
KEY_HASH = "key_hash"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for a null partition value


@dataclass(frozen=True)
class Directory:
    batch: str
    rows: int
    day: str | None = None  # partition value as text; None for an unpartitioned mart
    hashed: bool = False  # whether its rows have key hashes
    files: tuple[str, ...] = ()  # the files that count, if not all do

    @property
    def path(self) -> str:
        return f"{BATCH}={self.batch}" + (f"/event_date={self.day}" if self.day else "")


@dataclass(frozen=True)
class Snapshot:
    id: int
    parent: int | None
    committed_at: datetime
    directories: tuple[Directory, ...]

    @property
    def rows(self) -> int:
        return sum(d.rows for d in self.directories)

    def within(self, window: DateWindow | None) -> tuple[Directory, ...]:
        """Directories a date window can touch (the null partition never matches)."""
        if window is None:
            return self.directories
        first, last = window.start.isoformat(), window.end.isoformat()
        return tuple(d for d in self.directories if d.day and first <= d.day <= last)

    def dumps(self) -> str:
        return json.dumps(
            {
                "id": self.id,
                "parent": self.parent,
                "committed_at": self.committed_at.isoformat(),
                "rows": self.rows,
                "directories": [asdict(d) for d in self.directories],
            },
            sort_keys=True,
        )

    @classmethod
    def loads(cls, text: str) -> "Snapshot":
        doc = json.loads(text)
        return cls(
            doc["id"],
            doc["parent"],
            datetime.fromisoformat(doc["committed_at"]),
            tuple(Directory(**{**d, "files": tuple(d.get("files", ()))}) for d in doc["directories"]),
        )


class Mart:
    """One snapshot-versioned table."""

    def __init__(self, spark: SparkSession, root: str, spec: MartSpec):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.data = f"{self.root}/data"

    # -- snapshots ---------------------------------------------------------

    def _manifest(self, number: int) -> str:
        return f"{self.root}/snapshots/{number}.json"

    def current_id(self) -> int | None:
        """The snapshot named by ref ``main``, which need not be the newest one."""
        text = files.read_text(self.spark, f"{self.root}/refs/main")
        return int(text) if text else None

    def snapshot(self, number: int) -> Snapshot:
        text = files.read_text(self.spark, self._manifest(number))
        if text is None:
            raise LookupError(f"{self.spec.name}: no snapshot {number}")
        return Snapshot.loads(text)

    def current(self) -> Snapshot | None:
        number = self.current_id()
        return None if number is None else self.snapshot(number)

    def numbers(self) -> list[int]:
        found = files.names(self.spark, f"{self.root}/snapshots")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def ancestors(self) -> Iterator[Snapshot]:
        """The current snapshot and what it came from, newest first, read one by one."""
        number = self.current_id()
        while number is not None:
            found = self.snapshot(number)
            yield found
            number = found.parent

    def history(self) -> list[Snapshot]:
        """The current snapshot and its ancestors, oldest first."""
        return [*self.ancestors()][::-1]

    def as_of(self, instant: datetime) -> Snapshot:
        """Newest snapshot of the history committed at or before ``instant``."""
        if instant.tzinfo is None:
            instant = instant.replace(tzinfo=timezone.utc)
        found = next((s for s in self.ancestors() if s.committed_at <= instant), None)
        if found is None:
            raise LookupError(f"{self.spec.name}: {instant} is before the retained history")
        return found

    def rollback(self, number: int) -> None:
        """Point ref ``main`` at an existing snapshot."""
        files.replace_text(self.spark, f"{self.root}/refs/main", str(self.snapshot(number).id))

    def commit(self, directories, parent: Snapshot | None) -> Snapshot:
        now = datetime.now(timezone.utc)
        if parent is not None:
            now = max(now, parent.committed_at + timedelta(microseconds=1))
        number = max(self.numbers(), default=0) + 1
        kept = tuple(sorted((d for d in directories if d.rows), key=lambda d: d.path))
        snapshot = Snapshot(number, parent.id if parent else None, now, kept)
        files.create_text(self.spark, self._manifest(number), snapshot.dumps())
        files.replace_text(self.spark, f"{self.root}/refs/main", str(number))
        return snapshot

    def ensure(self) -> Snapshot:
        """Current snapshot; an empty first one if the mart does not exist yet."""
        return self.current() or self.commit((), None)

    # -- data --------------------------------------------------------------

    def scan(self, directories, keep_batch: bool = False, keep_file: bool = False) -> DataFrame:
        """One scan over the given directories, with the mart's columns and types."""
        schema = self.spec.schema
        wanted = schema.names + ([BATCH] if keep_batch else []) + (["_metadata.file_path"] if keep_file else [])
        stored = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
        if not directories:
            return self.spark.createDataFrame([], stored).select(*wanted)
        reader = self.spark.read.schema(stored).option("basePath", self.data)
        return reader.parquet(*self._paths(directories)).select(*wanted)

    def _paths(self, directories) -> list[str]:
        return [f"{self.data}/{d.path}{name and '/'}{name}" for d in directories for name in d.files or ("",)]

    def listed(self, directories) -> DataFrame:
        """One row per data file: batch, day, file_name, file_path, length. No file is opened."""
        rows = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self._paths(directories))
        found = rows.select("length", "_metadata.file_path", "_metadata.file_name")
        named = F.regexp_extract("file_path", f"/{BATCH}=([^/]+)/", 1).alias(BATCH)
        day = F.regexp_extract("file_path", f"/{self.spec.partition}=([^/]+)/", 1) if self.spec.partition else F.lit(None)
        return found.select(named, day.cast("string").alias("day"), "file_name", "file_path", "length")

    def counted(self, directories) -> list[Directory]:
        """The directories with the row counts of the files that count, from Parquet footers alone."""
        if not directories:
            return []
        day = F.col(self.spec.partition).cast("string") if self.spec.partition else F.lit(None).cast("string")
        counts = self.scan(directories, keep_batch=True).groupBy(BATCH, day.alias("day")).count().collect()
        found = {(r[BATCH], r["day"] or (NULL_DAY if self.spec.partition else None)): r["count"] for r in counts}
        return [replace(d, rows=found.get((d.batch, d.day), 0)) for d in directories]

    def key_hashes(self, directories) -> DataFrame:
        """``key_hash`` of each row of the given directories, with its batch and date.

        A null key has a null hash. All directories must be ``hashed``.
        """
        parts = [T.StructField(BATCH, T.StringType())]
        if self.spec.partition:
            parts.append(self.spec.schema[self.spec.partition])
        stored = T.StructType([T.StructField(KEY_HASH, T.LongType()), *parts])
        if not directories:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", self.data).parquet(*self._paths(directories))

    def all_key_hashes(self, number: int) -> DataFrame | None:
        """The key hashes of a snapshot; None if some of its directories have none."""
        directories = self.snapshot(number).directories
        return self.key_hashes(directories) if all(d.hashed for d in directories) else None

    def read(self, number: int | None = None, window: DateWindow | None = None) -> DataFrame:
        """A pinned snapshot (default: the current one), optionally only a date window.

        A mart without a snapshot reads as empty; reading never writes.
        """
        snapshot = self.current() if number is None else self.snapshot(number)
        rows = self.scan(snapshot.within(window) if snapshot else ())
        return rows.where(window.covers(self.spec.partition)) if window else rows

    def write(self, df: DataFrame, arranged: bool = False) -> list[Directory]:
        """Write rows with their key hashes as a new batch. Nothing refers to it until a commit does.

        ``rebalance`` shuffles (by date, for a partitioned mart) and lets AQE merge
        what is small and split a date too large for one task, so neither many dates
        nor one huge date yields tiny files or a single long task. ``arranged`` rows are
        written as they are dealt out already.
        """
        require(df, self.spec.schema, self.spec.name)
        batch = uuid.uuid4().hex
        target = f"{self.data}/{BATCH}={batch}"
        day = self.spec.partition
        parts = [day] if day else []
        shaped = df if arranged else df.hint("rebalance", *parts)
        key = F.col(self.spec.key)
        hashed = shaped.withColumn(KEY_HASH, F.when(key.isNotNull(), F.xxhash64(key)))
        hashed.write.option("compression", "snappy").partitionBy(*parts).parquet(target)
        return [replace(d, hashed=True) for d in self._measure(batch)]

    def _measure(self, batch: str) -> list[Directory]:
        """Directories of a batch with row counts, from Parquet footers alone."""
        target = f"{self.data}/{BATCH}={batch}"
        rows = self.spark.read.schema(self.spec.schema).parquet(target)
        if not self.spec.partition:
            return [Directory(batch, rows.count())]
        per_day = rows.groupBy(F.col(self.spec.partition).cast("string").alias("day")).count()
        # At most one row per calendar date of the batch.
        return [
            Directory(batch, r["count"], r["day"] or NULL_DAY)
            for r in per_day.collect()
        ]
