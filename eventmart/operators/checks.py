"""Data-quality checks of the staging and mart layers: 35, or 37 for a date window.

A layer's checks run as one Spark job. All row-level checks of a table share one
scan and one aggregate; each uniqueness, relationship or cross-table check adds
one pre-aggregated shuffle. Every part yields ``(position, value)`` rows, so the
final step sums a few dozen rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators import models, reports
from eventmart.operators.windows import DateWindow
from eventmart.schemas import EVENT_TYPES
from eventmart.session import small_frame

# Tables, columns and kinds of the column checks, in audit order.
COLUMN_CHECKS = {
    "stg_raw_events": [
        ("event_id", "not_null"),
        ("event_id", "unique"),
        ("user_id", "not_null"),
        ("event_type", "not_null"),
        ("event_timestamp", "not_null"),
    ],
    "stg_raw_users": [
        ("user_id", "not_null"),
        ("user_id", "unique"),
        ("username", "not_null"),
        ("email", "not_null"),
        ("email", "unique"),
    ],
    "dim_users": [
        ("user_id", "not_null"),
        ("user_id", "unique"),
        ("username", "not_null"),
        ("email", "not_null"),
        ("email", "unique"),
        ("created_at", "not_null"),
    ],
    "fct_events": [
        ("event_id", "not_null"),
        ("event_id", "unique"),
        ("user_id", "not_null"),
        ("event_type", "not_null"),
        ("event_timestamp", "not_null"),
        ("event_date", "not_null"),
    ],
}
_TIME = "_check_time"  # a staged table's parsed time, see _with_time
LAYERS = {
    "staging": ("stg_raw_events", "stg_raw_users"),
    "marts": ("dim_users", "fct_events"),
}


@dataclass(frozen=True)
class Tables:
    """Inputs of the checks; the two marts may be absent for a full staging gate.

    ``fct_hashes`` (key_hash and event_date of every fact), if known, spare reading the
    keys of all facts.
    """

    stg_raw_events: DataFrame
    stg_raw_users: DataFrame
    dim_users: DataFrame | None = None
    fct_events: DataFrame | None = None
    fct_hashes: DataFrame | None = None


@dataclass(frozen=True)
class Check:
    """One check. Its failures are the sum of its parts' values, or 0/1 by ``verdict``.

    ``shared`` holds (table, SQL aggregate) pairs evaluated in that table's one scan;
    ``own`` builds a DataFrame with a single ``value``. ``joint`` names a function whose one
    row also has this value beside those of other checks, and the column; it is used if all
    of them can run. ``needs`` are the columns read, used to tell which checks a missing
    column breaks.
    """

    name: str
    model: str
    column: str
    kind: str
    shared: tuple[tuple[str, str], ...] = ()
    own: Callable[[Tables], DataFrame] | None = None
    joint: tuple[Callable[[Tables], DataFrame], str] | None = None
    verdict: str = "sum"  # sum | zero (fails if 0) | differs (fails unless 0)
    needs: tuple[tuple[str, str], ...] = ()


def checks_for(layer: str, window: DateWindow | None = None) -> list[Check]:
    if layer not in LAYERS:
        raise ValueError("layer must be staging or marts")
    staging = layer == "staging"
    checks: list[Check] = []
    for model in LAYERS[layer]:
        for column, kind in COLUMN_CHECKS[model]:
            checks.append(_not_null(model, column) if kind == "not_null" else _unique(model, column))
        if model.endswith("events"):
            checks.append(_accepted_types(model))
    if staging:
        checks += [
            _valid_time("valid_event_time", "stg_raw_events", "event_timestamp"),
            _valid_time("valid_user_time", "stg_raw_users", "created_at"),
            _nonempty("stg_raw_events"),
            _nonempty("stg_raw_users"),
        ]
        checks += [_relationship("stg_raw_events", "stg_raw_users"), _nonnegative("stg_raw_events")]
        if window:
            checks += [_key_date_stable(window), _profiles_unchanged()]
    else:
        checks += [_event_counts(window), _user_counts()]
        checks += [_relationship("fct_events", "dim_users", _facts_against_users), _nonnegative("fct_events")]
        checks.append(_attributes_match())
    return checks


# -- definitions -----------------------------------------------------------------


def _rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _row_check(name: str, model: str, column: str, kind: str, failing: str) -> Check:
    shared = ((model, f"count_if({failing})"),)
    return Check(name, model, column, kind, shared, needs=((model, column),))


def _not_null(model: str, column: str) -> Check:
    name = f"not_null_{model}_{column}"
    return _row_check(name, model, column, "not_null", f"{column} IS NULL")


def _key_hash(column: str) -> Column:
    """The hash that a mart keeps of a key (see ``Mart.key_hashes``)."""
    return F.when(F.col(column).isNotNull(), F.xxhash64(column))


def _nothing(tables: Tables) -> DataFrame:
    return small_frame(tables.stg_raw_events.sparkSession, [(0,)], "value long")


@cache
def _repeated_keys(model: str) -> Callable[[Tables], DataFrame]:
    """One row with the repeated values of every unique column: the table is read and shuffled once."""
    columns = [column for column, kind in COLUMN_CHECKS[model] if kind == "unique"]

    def repeated(tables: Tables) -> DataFrame:
        keys = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns]))
        per_key = getattr(tables, model).select(keys.alias("key")).groupBy("key.name", "key.value").count()
        return per_key.agg(*[F.count_if((F.col("name") == c) & (F.col("count") > 1)).alias(c) for c in columns])

    return repeated


def _unique(model: str, column: str) -> Check:
    def repeated_groups(tables: Tables) -> DataFrame:
        rows = getattr(tables, model)
        if model == "fct_events" and tables.fct_hashes is not None:
            # A key that occurs twice has a hash that does; keys are read only if there is one.
            twice = tables.fct_hashes.groupBy("key_hash").count().where("count > 1").select("key_hash")
            if twice.isEmpty():
                return _nothing(tables)
            rows = rows.join(twice, _key_hash(column).eqNullSafe(F.col("key_hash")), "left_semi")
        return rows.groupBy(column).count().selectExpr("count_if(count > 1) AS value")

    name = f"unique_{model}_{column}"
    together = (_repeated_keys(model), column)
    return Check(name, model, column, "unique", own=repeated_groups, joint=together, needs=((model, column),))


def _accepted_types(model: str) -> Check:
    accepted = ", ".join(f"'{kind}'" for kind in EVENT_TYPES)
    unknown = f"event_type NOT IN ({accepted})"
    return _row_check(f"accepted_values_{model}", model, "event_type", "accepted_values", unknown)


def _valid_time(name: str, model: str, column: str) -> Check:
    return _row_check(name, model, column, "timestamp", f"{_TIME} IS NULL")


def _nonempty(model: str) -> Check:
    return Check(f"nonempty_{model}", model, "", "nonempty", ((model, "count(*)"),), verdict="zero")


def _nonnegative(model: str) -> Check:
    name = f"nonnegative_amount_{model}"
    return _row_check(name, model, "amount", "nonnegative", "amount < 0")


def _facts_against_users(tables: Tables) -> DataFrame:
    """Facts without a user and facts with attributes of another time, in one row.

    A user's events carry few attribute combinations: these are counted, then joined.
    """
    stored = ("user_id", "username", "user_email", "user_country")
    combinations = tables.fct_events.groupBy(*stored).agg(_rows("n"))
    dim = tables.dim_users.select("user_id", F.struct("username", "email", "country").alias("_profile"))
    own = F.struct("username", F.col("user_email").alias("email"), F.col("user_country").alias("country"))
    known = F.col("_profile").isNotNull()
    return combinations.join(dim, "user_id", "left").agg(
        F.sum(F.when(~known, F.col("n"))).alias("orphaned"),
        F.sum(F.when(known & ~own.eqNullSafe(F.col("_profile")), F.col("n"))).alias("mismatched"),
    )


def _relationship(events: str, users: str, joint: Callable | None = None) -> Check:
    def orphaned_rows(tables: Tables) -> DataFrame:
        found = reports.orphans(getattr(tables, events), getattr(tables, users))
        return found.selectExpr("sum(events) AS value")

    needs = ((events, "user_id"), (users, "user_id"))
    name = f"relationships_{events}"
    together = (joint, "orphaned") if joint else None
    return Check(name, events, "user_id", "relationships", own=orphaned_rows, joint=together, needs=needs)


def _event_counts(window: DateWindow | None) -> Check:
    fact, staged = "count(*)", "-count(*)"
    needs: tuple[tuple[str, str], ...] = ()
    if window:
        fact = f"count_if({window.condition('event_date')})"
        staged = f"-count_if({window.condition(f'CAST({_TIME} AS DATE)')})"
        needs = (("fct_events", "event_date"), ("stg_raw_events", "event_timestamp"))
    shared = (("fct_events", fact), ("stg_raw_events", staged))
    name = "event_count_reconciliation"
    return Check(name, "fct_events", "event_id", "reconciliation", shared, verdict="differs", needs=needs)


def _user_counts() -> Check:
    shared = (("dim_users", "count(*)"), ("stg_raw_users", "-count(*)"))
    name = "user_count_reconciliation"
    return Check(name, "dim_users", "user_id", "reconciliation", shared, verdict="differs")


def _key_date_stable(window: DateWindow) -> Check:
    def moved(tables: Tables) -> DataFrame:
        # Only the replayed window is counted per key first: it is the small side,
        # and the fact history is then joined without a shuffle when it is broadcast.
        staged = models.in_window(tables.stg_raw_events, window)
        per_key = staged.groupBy("event_id").agg(_rows("n"))
        if tables.fct_hashes is not None:
            # Facts outside are read only if the hash of one of their keys is staged.
            hashes = per_key.select(_key_hash("event_id").alias("key_hash"))
            if tables.fct_hashes.where(~window.covers("event_date")).join(hashes, "key_hash", "left_semi").isEmpty():
                return _nothing(tables)
        outside = tables.fct_events.where(~window.covers("event_date")).select("event_id")
        return outside.join(per_key, "event_id").selectExpr("sum(n) AS value")

    needs = (
        ("stg_raw_events", "event_id"),
        ("stg_raw_events", "event_timestamp"),
        ("fct_events", "event_id"),
        ("fct_events", "event_date"),
    )
    name = "incremental_key_date_stable"
    return Check(name, "stg_raw_events", "event_id", "append_contract", own=moved, needs=needs)


def _profiles_unchanged() -> Check:
    def changed(tables: Tables) -> DataFrame:
        staged = models.dim_users(tables.stg_raw_users)
        return reports.profile_changes(tables.dim_users, staged).agg(_rows("value"))

    columns = ("user_id", "username", "email", "created_at", "country")
    needs = tuple((t, c) for t in ("stg_raw_users", "dim_users") for c in columns)
    name = "incremental_profiles_unchanged"
    return Check(name, "stg_raw_users", "user_id", "profile_contract", own=changed, needs=needs)


def _attributes_match() -> Check:
    def differing(tables: Tables) -> DataFrame:
        # A user's events carry few attribute combinations: count those, then join.
        stored = ("user_id", "username", "user_email", "user_country")
        per_combination = tables.fct_events.groupBy(*stored).agg(_rows("n"))
        found = reports.enrichment_mismatches(per_combination, tables.dim_users, "n")
        return found.selectExpr("sum(n) AS value")

    facts = ("user_id", "username", "user_email", "user_country")
    dims = ("user_id", "username", "email", "country")
    needs = tuple(("fct_events", c) for c in facts) + tuple(("dim_users", c) for c in dims)
    name = "event_attributes_match_users"
    together = (_facts_against_users, "mismatched")
    return Check(name, "fct_events", "user_id", "enrichment", own=differing, joint=together, needs=needs)


# -- evaluation ------------------------------------------------------------------

_TEXT_TIME = {"stg_raw_events": "event_timestamp", "stg_raw_users": "created_at"}


def _missing(check: Check, tables: Tables) -> list[str]:
    gone = []
    for model, column in check.needs:
        table = getattr(tables, model)
        if table is None or column not in table.columns:
            gone.append(f"{model}.{column}")
    gone += [model for model, _ in check.shared if getattr(tables, model) is None]
    return gone


def _with_time(tables: Tables, model: str) -> DataFrame:
    """The table with its parsed time under the name the checks use, if it has one."""
    table = getattr(tables, model)
    text = _TEXT_TIME.get(model)
    if text is None or text not in table.columns:
        return table
    return table.withColumn(_TIME, models.parsed_time(table, text))


def _shared_values(tables: Tables, model: str, parts: list[tuple[int, str]]) -> DataFrame:
    wide = _with_time(tables, model).selectExpr(*[f"{v} AS v{i}" for i, (_, v) in enumerate(parts)])
    rows = ", ".join(f"{position}, v{i}" for i, (position, _) in enumerate(parts))
    return wide.selectExpr(f"stack({len(parts)}, {rows}) AS (position, value)")


def _values(tables: Tables, numbered: list[tuple[int, Check]]) -> DataFrame | None:
    """(position, value) rows of all given checks."""
    shared: dict[str, list[tuple[int, str]]] = {}
    parts: list[DataFrame] = []
    joint: dict[Callable, list[tuple[int, str]]] = {}
    for position, check in numbered:
        if check.joint:
            joint.setdefault(check.joint[0], []).append((position, check.joint[1]))
    joint = {build: found for build, found in joint.items() if len(found) > 1}
    for build, found in joint.items():
        rows = ", ".join(f"{position}, {column}" for position, column in found)
        parts.append(build(tables).selectExpr(f"stack({len(found)}, {rows}) AS (position, value)"))
    for position, check in numbered:
        for model, value in check.shared:
            shared.setdefault(model, []).append((position, value))
        if check.own and not (check.joint and check.joint[0] in joint):
            parts.append(check.own(tables).selectExpr(f"{position} AS position", "value"))
    parts += [_shared_values(tables, model, found) for model, found in shared.items()]
    return reduce(DataFrame.unionAll, parts) if parts else None


def _measured(tables: Tables, checks: list[Check]) -> DataFrame:
    """(position, failures, status, error) of each check; lazy, one job when read.

    A check whose columns are missing gets status ``error`` and 0 failures; the
    others still run. Status, not the count, tells whether a check passed.
    """
    spark = tables.stg_raw_events.sparkSession
    broken = {i: gone for i, c in enumerate(checks) if (gone := _missing(c, tables))}
    values = _values(tables, [(i, c) for i, c in enumerate(checks) if i not in broken])
    if values is None:
        values = small_frame(spark, [], "position int, value long")

    def positions(verdict: str) -> str:
        return ", ".join(str(i) for i, c in enumerate(checks) if c.verdict == verdict) or "NULL"

    failures = f"""CASE WHEN position IN ({positions("zero")}) THEN CAST(total = 0 AS LONG)
                        WHEN position IN ({positions("differs")}) THEN CAST(total <> 0 AS LONG)
                        ELSE total END AS failures"""
    totals = values.groupBy("position").agg(F.expr("coalesce(sum(value), 0) AS total"))
    results = totals.selectExpr("position", failures).selectExpr(
        "*", "IF(failures = 0, 'pass', 'fail') AS status", "CAST(NULL AS STRING) AS error"
    )
    if broken:
        rows = [(i, 0, "error", "missing " + ", ".join(gone)) for i, gone in broken.items()]
        schema = "position int, failures long, status string, error string"
        results = results.unionAll(small_frame(spark, rows, schema))
    return results


def check_results(tables: Tables, layer: str, window: DateWindow | None = None) -> DataFrame:
    """All checks of a layer as named rows."""
    checks = checks_for(layer, window)
    rows = [(i, c.name, c.model, c.column, c.kind) for i, c in enumerate(checks)]
    schema = "position int, test_name string, model string, column_name string, kind string"
    labels = small_frame(tables.stg_raw_events.sparkSession, rows, schema)
    return labels.join(_measured(tables, checks), "position")


def gate_summary(results: DataFrame) -> DataFrame:
    def how_many(status: str, name: str) -> Column:
        return F.count_if(F.col("status") == status).alias(name)

    return results.agg(
        F.count(F.lit(1)).alias("total"),
        how_many("pass", "passed"),
        how_many("fail", "failed"),
        how_many("error", "errors"),
    )


def run_checks(tables: Tables, layer: str, window: DateWindow | None = None) -> list[dict]:
    """Results of a layer on the driver (at most 37 rows), in audit order.

    The checks share one job. If that job fails, its halves run apart, and so on down to the
    broken ones, which alone are reported as errors: a few jobs for each of them. A check without
    a result is an error, never zero failures.
    """
    checks = checks_for(layer, window)
    found = _isolated(tables, list(enumerate(checks)))
    lost = {"failures": 0, "status": "error", "error": "no result"}
    results = []
    for position, check in enumerate(checks):
        outcome = found.get(position, lost)
        result = {"name": check.name, "model": check.model, "column": check.column}
        result |= {"kind": check.kind, "failures": outcome["failures"], "status": outcome["status"]}
        if outcome["error"]:
            result["error"] = outcome["error"]
        results.append(result)
    return results


def _isolated(tables: Tables, numbered: list[tuple[int, Check]]) -> dict[int, dict]:
    """Results by position; checks that cannot be evaluated have the reason."""
    try:
        found = _collected(_measured(tables, [check for _, check in numbered]))
        return {numbered[k][0]: outcome for k, outcome in found.items()}
    except Exception as reason:  # noqa: BLE001 - any engine error must end up in the audit
        if len(numbered) == 1:
            return {numbered[0][0]: {"failures": 0, "status": "error", "error": str(reason)}}
    half = len(numbered) // 2
    return _isolated(tables, numbered[:half]) | _isolated(tables, numbered[half:])


def _collected(results: DataFrame) -> dict[int, dict]:
    return {r["position"]: r.asDict() for r in results.collect()}


def summarize(results: list[dict]) -> dict[str, int]:
    states = [r["status"] for r in results]
    counts = {"passed": "pass", "failed": "fail", "errors": "error"}
    return {"total": len(states)} | {k: states.count(v) for k, v in counts.items()}
