"""Session helpers: recommended settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# For jobs that start their own session. All are runtime-adaptive: nothing here
# assumes a data size, and the library also runs under Spark's defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # A refresh has more generated stages than the default cache (100) keeps, so a long-lived
    # session would compile all of them again in every run.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call-site capture per expression
    "spark.ui.enabled": "false",
}


def session(name: str = "eventmart", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: executors on
    other hosts could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="eventmart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def workspace(spark: SparkSession, name: str) -> str:
    """A new, unused folder path below the shared folder."""
    return f"{shared_folder(spark)}/eventmart/{name}-{uuid.uuid4().hex}"



# Aim for shuffle partitions of about this size; AQE merges smaller ones.
SHUFFLE_BYTES = 128 << 20
_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def sized_shuffles(spark: SparkSession, shuffled_bytes: int, partition_bytes: int = SHUFFLE_BYTES):
    """Raise the number of shuffle partitions to fit the data while jobs run inside.

    AQE merges partitions that turn out small but cannot add any, so the session's
    number is only a floor. Actions must run inside; the old number is put back. It is a
    setting of the session, so jobs that run beside each other need sessions of their own
    (``spark.newSession()``).
    """
    before = spark.conf.get(_PARTITIONS)
    wanted = shuffled_bytes // partition_bytes
    spark.conf.set(_PARTITIONS, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


_ARROW = {
    T.StringType(): pa.string(),
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.BooleanType(): pa.bool_(),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few driver-made rows (check results, totals) as a local table in the plan.

    Through Arrow they need no job of their own; a list would become a pickled RDD.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else ((),) * len(schema)
    arrays = [pa.array(c, _ARROW[f.dataType]) for f, c in zip(schema, columns, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)
