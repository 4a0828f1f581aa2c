"""NDJSON sources: declared scans, partition pruning, landing and contract checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.timeparse import utc_millis
from eventmart.operators.models import PARSED, stage_events, stage_users
from eventmart.operators.windows import DateWindow
from eventmart.schemas import CORRUPT, DBL, RAW_EVENTS, RAW_USERS, STR
from eventmart.session import small_frame
from eventmart.storage import files

PARTITION = "event_date"
_STAGES = {"events": (stage_events, "event_timestamp"), "users": (stage_users, "created_at")}


class SourceRejected(ValueError):
    """Raw data that cannot be loaded at all (as opposed to failing a quality check)."""


def _scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, STR)])
    reader = spark.read.schema(kept).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def scan_events(spark: SparkSession, path: str) -> DataFrame:
    """All raw events; text that does not fit the schema is kept in ``_corrupt_record``."""
    return _scan(spark, path, RAW_EVENTS)


def scan_users(spark: SparkSession, path: str) -> DataFrame:
    return _scan(spark, path, RAW_USERS)


def is_partitioned(spark: SparkSession, path: str) -> bool:
    """Whether raw events lie in ``event_date=`` folders."""
    return any(name.startswith(f"{PARTITION}=") for name in files.names(spark, path))


def scan_events_window(spark: SparkSession, path: str, window) -> DataFrame:
    """Only the ``event_date=`` directories of a window.

    The key is declared a string: left to inference it would become a date, and the
    predicate a cast that the scan cannot use to skip directories.
    """
    window = DateWindow.parse(window)
    if not is_partitioned(spark, path):
        raise SourceRejected(f"{path} has no string partition key {PARTITION}")
    keyed = T.StructType([*RAW_EVENTS.fields, T.StructField(PARTITION, STR)])
    rows = _scan(spark, path, keyed)
    return rows.where(window.covers_text(PARTITION)) if window else rows


def append_events(events: DataFrame, path: str) -> None:
    """Add a batch of raw events under new file names; users are not touched."""
    events.select(*RAW_EVENTS.names).write.mode("append").json(path)


def replace_users(users: DataFrame, path: str) -> None:
    """Users are one current snapshot, so a new one replaces the old."""
    users.select(*RAW_USERS.names).write.mode("overwrite").json(path)


def _defects(kind: str) -> dict[str, Column]:
    """What makes a raw row impossible to load, as conditions."""
    # a scan that asks for the corrupt text alone is refused, so the key is looked at as well
    key = F.coalesce(F.length("event_id" if kind == "events" else "user_id"), F.lit(0)) >= 0
    found = {"corrupt": F.col(CORRUPT).isNotNull() & key}
    if kind == "events":
        found["not_a_number"] = F.isnan("amount")
        found["infinite"] = F.abs("amount") == float("inf")
    return found


def load_defects(raw: DataFrame, kind: str) -> DataFrame:
    """Rows by defect that keep a raw source from being loaded (zero counts included)."""
    seen = raw.agg(*[F.count_if(c).alias(name) for name, c in _defects(kind).items()])
    names = ", ".join(f"'{name}', {name}" for name in _defects(kind))
    stacked = seen.selectExpr(f"stack({len(_defects(kind))}, {names}) AS (defect, rows)")
    return stacked.select(F.lit(kind).alias("source"), "defect", "rows")


def land(raw: DataFrame, kind: str, target: str) -> DataFrame:
    """Parse raw rows once into a columnar staging copy and return its scan.

    JSON text is neither splittable by column nor vectorized, and the gates and the
    merge read staging several times; they read this copy. Rejects text that is no
    record of the schema and amounts that are no finite number.
    """
    stage, text = _STAGES[kind]
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    staged = stage(raw.withColumn(CORRUPT, corrupt), CORRUPT)
    seen = Observation()
    counted = [F.count_if(c).alias(name) for name, c in _defects(kind).items()]
    checked = staged.withColumn(PARSED, utc_millis(text)).observe(seen, *counted)
    landed = checked.drop(CORRUPT)
    landed.write.mode("overwrite").parquet(target)
    found = seen.get
    if any(found.values()):
        raise SourceRejected(f"{kind}: {found}")
    return raw.sparkSession.read.schema(landed.schema).parquet(target)


def schema_contract(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Inferred against declared types, one row per field of each source.

    Inference merges the types seen in all files (a distributed pass). A numeric
    amount may be inferred as any number; everything else must be text.
    """
    declared = {"events": RAW_EVENTS, "users": RAW_USERS}
    rows = []
    for source, path in paths.items():
        found = {f.name: f.dataType for f in spark.read.json(path).schema}
        found.pop(PARTITION, None)
        wanted = {f.name: f.dataType for f in declared[source]}
        for name in sorted(wanted.keys() | found.keys()):
            want, got = wanted.get(name), found.get(name)
            rows.append((source, name, _type(want), _type(got), _fit(want, got)))
    schema = "source string, field string, declared string, inferred string, status string"
    return small_frame(spark, rows, schema)


# What a JSON value is, by the start of its variant schema; numbers come as several types.
_KINDS = {"STRING": "text", "BOOLEAN": "boolean", "ARRAY": "list", "OBJECT": "record", "VOID": "null"}
_WANTED = {"string": "text", "double": "number"}


def field_types(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, field, kind, lines) of every field that a file's lines hold, null fields included.

    Every line is read as a variant, so no schema is assumed and files may differ. A kind is
    text, number, boolean, list, record, null or, if a file's lines differ, mixed. Text that is no JSON object
    counts under the field null.
    """
    rows = spark.read.option("recursiveFileLookup", "true").text(path).select("_metadata.file_path", F.try_parse_json("value").alias("v"))
    record = F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    whole = rows.where(record).select("file_path", "v").lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer()))
    broken = rows.where(~F.coalesce(record, F.lit(False))).select("file_path", F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))
    seen = whole.select("file_path", "key", "value").unionAll(broken)
    start = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kind = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), start), F.lit("number"))
    kinds = seen.select("file_path", F.col("key").alias("field"), F.when(F.col("key").isNotNull(), F.coalesce(F.when(F.col("value").isNull(), F.lit("null")), kind)).alias("kind"))
    # one row per file, field and kind, then per file and field
    counted = kinds.groupBy("file_path", "field", "kind").agg(F.count(F.lit(1)).alias("lines"))
    typed = F.when(F.col("kind") != "null", F.col("kind"))
    merged = F.when(F.count_distinct(typed) > 1, "mixed").otherwise(F.coalesce(F.max(typed), F.max("kind")))
    return counted.groupBy("file_path", "field").agg(merged.alias("kind"), F.sum("lines").alias("lines"))


def drift_by_file(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """What differs from the declared fields, by file: source, file_path, field, declared, found, status.

    A file without lines has no field and nothing to differ. A null value fits every field; status is
    drift (another kind), missing, extra, or broken (lines that are no JSON object).
    """
    declared = {"events": RAW_EVENTS, "users": RAW_USERS}
    found = None
    for source, path in paths.items():
        wanted = [(f.name, _WANTED[f.dataType.simpleString()]) for f in declared[source]]
        types = field_types(spark, path)
        listed = small_frame(spark, wanted, "field string, declared string")  # the declared fields
        files_seen = types.select("file_path").distinct().join(F.broadcast(listed))
        joined = files_seen.join(types, ["file_path", "field"], "full")
        status = (
            F.when(F.col("field").isNull(), "broken")
            .when(F.col("declared").isNull(), "extra")
            .when(F.col("kind").isNull(), "missing")
            .when(~F.col("kind").isin("null") & (F.col("kind") != F.col("declared")), "drift")
        )
        part = joined.select(F.lit(source).alias("source"), "file_path", "field", "declared", F.col("kind").alias("found"), status.alias("status"))
        part = part.where("status IS NOT NULL")
        found = part if found is None else found.unionByName(part)
    return found


def _type(dtype: T.DataType | None) -> str | None:
    return None if dtype is None else dtype.simpleString()


def _fit(want: T.DataType | None, got: T.DataType | None) -> str:
    if want is None:
        return "extra"
    if got is None:
        return "missing"
    if want == got or (want == DBL and isinstance(got, T.NumericType)):
        return "ok"
    return "drift"
