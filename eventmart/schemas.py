"""Declared schemas. Column names, order and types are part of the data contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STR, DBL, LONG = T.StringType(), T.DoubleType(), T.LongType()
NTZ, DATE = T.TimestampNTZType(), T.DateType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RAW_EVENTS = struct(
    ("event_id", STR),
    ("user_id", STR),
    ("event_type", STR),
    ("page", STR),
    ("timestamp", STR),
    ("session_id", STR),
    ("amount", DBL),
)
RAW_USERS = struct(
    ("user_id", STR),
    ("name", STR),
    ("email", STR),
    ("created_at", STR),
    ("country", STR),
)
CORRUPT = "_corrupt_record"

DIM_USERS = struct(
    ("user_id", STR),
    ("username", STR),
    ("email", STR),
    ("created_at", NTZ),
    ("country", STR),
)
FCT_EVENTS = struct(
    ("event_id", STR),
    ("user_id", STR),
    ("event_type", STR),
    ("event_timestamp", NTZ),
    ("event_date", DATE),
    ("session_id", STR),
    ("page", STR),
    ("amount", DBL),
    ("username", STR),
    ("user_email", STR),
    ("user_country", STR),
)

# The audit history's 28 columns, in order.
AUDIT = struct(
    ("id", STR),
    ("data_issue_id", STR),
    ("test_execution_id", STR),
    ("test_unique_id", STR),
    ("model_unique_id", STR),
    ("invocation_id", STR),
    ("detected_at", NTZ),
    ("created_at", NTZ),
    ("database_name", STR),
    ("schema_name", STR),
    ("table_name", STR),
    ("column_name", STR),
    ("test_type", STR),
    ("test_sub_type", STR),
    ("test_results_description", STR),
    ("owners", STR),
    ("tags", STR),
    ("test_results_query", STR),
    ("other", STR),
    ("test_name", STR),
    ("test_params", STR),
    ("severity", STR),
    ("status", STR),
    ("failures", LONG),
    ("test_short_name", STR),
    ("test_alias", STR),
    ("result_rows", STR),
    ("failed_row_count", LONG),
)

MANIFEST_FILE = struct(("path", STR), ("rows", LONG), ("sha256", STR))
MANIFEST = struct(
    ("format", STR),
    ("events", LONG),
    ("users", LONG),
    ("start_id", LONG),
    ("files", T.ArrayType(MANIFEST_FILE)),
    ("partitioned_by", T.ArrayType(STR)),
)

RUN_LOG = struct(
    ("query_id", STR),
    ("execution_id", STR),
    ("phase", STR),
    ("state", STR),
    ("bytes_scanned", LONG),
    ("engine_ms", LONG),
)

# The accepted event types.
EVENT_TYPES = ("page_view", "click", "purchase", "signup", "login", "logout")


@dataclass(frozen=True)
class MartSpec:
    name: str
    key: str
    schema: T.StructType
    partition: str | None = None


MARTS = {
    "dim_users": MartSpec("dim_users", "user_id", DIM_USERS),
    "fct_events": MartSpec("fct_events", "event_id", FCT_EVENTS, "event_date"),
}


class SchemaDrift(ValueError):
    """A DataFrame does not have the declared columns and types of its target."""


def require(df, schema: T.StructType, target: str):
    """Return ``df`` unchanged if its columns equal ``schema`` by order, name and type."""
    got = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if got != want:
        diff = sorted({str(x) for x in got} ^ {str(x) for x in want}) or "column order"
        raise SchemaDrift(f"{target}: schema differs from its contract: {diff}")
    return df
