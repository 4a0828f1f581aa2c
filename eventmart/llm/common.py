"""What the operators share: text constants, quoted columns, intermediate tables."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.session import workspace

#: The white space of the contracts, as a regular expression and as plain characters.
WHITE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(rows: DataFrame) -> Column:
    """All columns of a row in one struct, so that helper columns cannot clash with them."""
    return F.struct(*[field(c) for c in rows.columns])


def unpacked(rows: DataFrame, name: str, added: dict[str, Column]) -> DataFrame:
    """The columns of struct ``name``, then the added ones; an added name replaces a column."""
    kept = [c for c in rows.schema[name].dataType.names if c not in added]
    return rows.select(*[field(name).getField(c).alias(c) for c in kept], *[v.alias(k) for k, v in added.items()])


def row_identity(doc_id: str, text: str) -> Column:
    """A 128-bit name of a row's id and text; rows repeated with both have the same."""
    own = F.coalesce(field(doc_id).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(own, F.lit(":"), F.coalesce(field(text).cast("string"), F.lit(""))).cast("binary")))


def written(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage, gives later joins true sizes, and fixes values that another run of the
    same plan might number differently. The files outlive lost executors; the folder is the
    one in ``spark.checkpoint.dir``, whose cleaning is up to its owner.
    """
    path = workspace(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether a document belongs to the part that no model learns from (a null id does not)."""
    return F.coalesce(F.crc32(field(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def runs_on_executors(module: str) -> None:
    """Send the module's functions along with the jobs: executors need no copy of the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
