"""Small control documents (manifests, refs, publications) on a Hadoop file system.

A document is created by an atomic rename that does not overwrite, as HDFS and local disks
have it. Object stores whose rename copies need a committer or a table service of their own:
there two writers may both believe that they created a document.

Only documents whose size does not grow with the row count pass through here; all
table data is read and written by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _open(spark: SparkSession, path: str):
    target = _hadoop(spark).Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder; empty if it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    found = (status.getPath().getName() for status in fs.listStatus(target))
    return sorted(name for name in found if not name.startswith((".", "_")))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data."""
    fs, target = _open(spark, path)
    fs.delete(target, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def count_and_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the data files in a folder."""
    fs, target = _open(spark, path)
    found = [s for s in fs.listStatus(target) if s.isFile() and not s.getPath().getName().startswith((".", "_"))]
    return len(found), sum(s.getLen() for s in found)


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute, URL-encoded form with scheme, as Spark reports it in ``_metadata.file_path``."""
    fs, target = _open(spark, path)
    return fs.makeQualified(target).toUri().toString()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, text: str, replace: bool) -> None:
    """Write aside, then rename: readers see the old document or the new one."""
    hadoop = _hadoop(spark)
    fs, target = _open(spark, path)
    aside = hadoop.Path(target.getParent(), f"_{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = hadoop.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE if replace else rename.NONE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a document; fails if the path is taken."""
    if exists(spark, path):
        raise FileExistsError(path)
    _publish(spark, path, text, replace=False)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    _publish(spark, path, text, replace=True)
