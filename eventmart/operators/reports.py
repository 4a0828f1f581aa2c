"""Analytics over the marts, the audit history and run logs.

Row-producing parts stay unsorted until the last step; only the small, grouped
result is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import totals
from eventmart.operators.windows import DateWindow
from eventmart.schemas import RUN_LOG


# Amounts are added up exactly (see ``functions.totals``): a total depends neither on the order
# of its rows nor on how they were grouped before.


def summary_by_type(facts: DataFrame, scale: int = 2) -> DataFrame:
    """Events and total amount, rounded half up to ``scale`` decimal places, per type."""
    return totals.totals(facts, "amount", ["event_type"], scale).orderBy("event_type")


def daily_by_type(facts: DataFrame, window: DateWindow | None = None) -> DataFrame:
    rows = facts.where(window.covers("event_date")) if window else facts
    by = ["event_date", "event_type"]
    return totals.totals(rows, "amount", by).orderBy(*by)


def daily_by_country(facts: DataFrame, users: DataFrame) -> DataFrame:
    """Events per date and country of the user's dimension row (inner join).

    Facts are first reduced to a few rows per date and user, so the join shuffles
    neither every event nor a single busy user's events to one task.
    """
    countries = users.select("user_id", "country")
    by = ["event_date", "country"]
    per_user = totals.added(totals.digits(facts, "amount", ["event_date", "user_id"]), ["event_date", "user_id"])
    return totals.put_together(totals.added(per_user.join(countries, "user_id"), by), by).orderBy(*by)


# -- audit history ---------------------------------------------------------------


def audit_status_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("tests"))


def failed_checks(audit: DataFrame, invocation: str, names: list[str] | None = None) -> DataFrame:
    """How many distinct checks (of ``names``) failed in one invocation."""
    rows = audit.where(
        (F.col("invocation_id") == invocation) & (F.col("status") == "fail") & (F.col("failures") > 0)
    )
    if names is not None:
        rows = rows.where(F.col("test_name").isin(*names))
    return rows.agg(F.count_distinct("test_name").alias("failed_checks"))


# -- rows behind a failure -------------------------------------------------------


def orphans(events: DataFrame, users: DataFrame) -> DataFrame:
    """User ids of events that have no user, with their event counts (null included).

    Events are counted per user before the anti join, so it sees one row per user.
    """
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return per_user.join(users.select("user_id"), "user_id", "left_anti")


def negative_amounts(events: DataFrame) -> DataFrame:
    return events.where(F.col("amount") < 0).select("event_id", "amount")


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    counted = rows.groupBy(F.col(key).alias("key_value")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def enrichment_mismatches(facts: DataFrame, users: DataFrame, *carried: str) -> DataFrame:
    """Facts whose stored user attributes differ from the dimension, nulls being equal."""
    stored = F.struct(
        F.col("username"), F.col("user_email").alias("email"), F.col("user_country").alias("country")
    )
    dim = users.select("user_id", F.struct("username", "email", "country").alias("_profile"))
    differing = facts.join(dim, "user_id").where(~stored.eqNullSafe(F.col("_profile")))
    return differing.select(*carried, "user_id", "username", "user_email", "user_country")


def key_date_moves(staged: DataFrame, facts: DataFrame, window: DateWindow) -> DataFrame:
    """Staged events of the window whose fact row lies on a date outside it.

    ``staged`` is already cut to the window and typed; ``NOT BETWEEN`` on the
    partition column keeps the window's own fact partitions unread.
    """
    outside = facts.where(~window.covers("event_date")).select(
        "event_id", F.col("event_date").alias("fact_date")
    )
    moved = staged.select("event_id", F.col("event_date").alias("staged_date"))
    return moved.join(outside, "event_id")


def profile_changes(dim: DataFrame, staged: DataFrame) -> DataFrame:
    """Dimension rows whose staged profile is missing or differs; new users are fine.

    ``staged`` has the dimension's columns and types (``models.dim_users``).
    """
    profile = F.struct("username", "email", "created_at", "country")
    old = dim.select("user_id", profile.alias("old"))
    new = staged.select("user_id", profile.alias("new"))
    joined = old.join(new, "user_id", "left")
    changed = joined.where(F.col("new").isNull() | ~F.col("old").eqNullSafe(F.col("new")))
    kind = F.when(F.col("new").isNull(), "missing").otherwise("changed")
    return changed.select("user_id", kind.alias("change"))


def nonempty(sources: dict[str, DataFrame]) -> DataFrame:
    """One row per empty source."""
    found = None
    for name, rows in sources.items():
        empty = rows.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
        part = empty.select(F.lit(name).alias("source"))
        found = part if found is None else found.unionByName(part)
    return found


def source_freshness(sources: dict[str, tuple[DataFrame, Column]], as_of: str) -> DataFrame:
    """Age of each source's newest time at ``as_of``: warn over 24 h, error over 48 h."""
    now = F.lit(as_of).cast("timestamp_ntz")
    found = None
    for name, (rows, when) in sources.items():
        part = rows.agg(F.max(when).alias("newest")).select(F.lit(name).alias("source"), "newest")
        found = part if found is None else found.unionByName(part)
    seconds = F.timestamp_diff("SECOND", F.col("newest"), now)
    status = (
        F.when(F.col("newest").isNull() | (seconds > 48 * 3600), "error")
        .when(seconds > 24 * 3600, "warn")
        .otherwise("pass")
    )
    return found.select("source", "newest", seconds.alias("age_seconds"), status.alias("status"))


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two tables, with that difference.

    Equal to EXCEPT ALL in both directions at the price of one aggregation.
    """
    names = left.columns
    signed = left.select(*names, F.lit(1).alias("_n")).unionAll(
        right.select(*names, F.lit(-1).alias("_n"))
    )
    return signed.groupBy(*names).agg(F.sum("_n").alias("copies")).where("copies <> 0")


# Fingerprints are kept of so many parts of a table.
PARTS = 1024


def differing_parts(left: DataFrame, right: DataFrame, parts: int = PARTS) -> tuple[Column, list[int]]:
    """The part of a row as an expression, and the parts whose order-free fingerprints differ.

    A fingerprint is the number of rows and the sums of two 64-bit hashes of them. Each task
    adds up its own rows, so only ``parts`` rows per task are exchanged. Nulls count by their place.
    """
    columns = [F.col(f"`{c}`") for c in left.columns]
    marked = [*columns, *[c.isNull() for c in columns]]
    part = F.pmod(F.xxhash64(*marked), F.lit(parts))
    values = [F.xxhash64(F.lit(seed), *marked).cast("decimal(20, 0)") for seed in (1, 2)]

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(part.alias("part"), F.lit(sign).alias("n"), *[(v * sign).alias(f"h{i}") for i, v in enumerate(values)])

    both = signed(left, 1).unionAll(signed(right.select(*left.columns), -1))
    sums = both.groupBy("part").agg(F.sum("n").alias("n"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1"))
    found = sums.where("n <> 0 OR h0 <> 0 OR h1 <> 0").select("part").collect()  # at most ``parts`` rows
    return part, sorted(r["part"] for r in found)


def changed_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """``table_diff`` of only those parts of the tables whose fingerprints differ.

    Equal tables exchange no rows. Differing tables are read twice.
    """
    part, found = differing_parts(left, right)
    names = left.columns
    return table_diff(left.where(part.isin(found)), right.select(*names).where(part.isin(found)))


# -- run logs --------------------------------------------------------------------


def run_queries(lines: DataFrame, run_id: str | None = None) -> DataFrame:
    """One row per run and query from log lines (column ``value``, one message per line).

    A run's submissions name its queries; the statistics of a query belong to it by its id
    alone, whichever run their lines name. A query without statistics has state null. Text
    that is no JSON object is skipped.
    """
    message = lines.select(F.from_json("value", RUN_LOG).alias("m")).select("m.*").where("query_id <> ''")
    # One pass over the log: one row per query and run, where statistics lines that name no
    # run form a row of their own, then the statistics of a query are given to its runs.
    per_query = message.groupBy("query_id", "execution_id").agg(
        F.max("bytes_scanned").alias("bytes_scanned"),
        F.max("engine_ms").alias("engine_ms"),
        F.max("state").alias("state"),
        F.max(F.col("state") == "SUCCEEDED").alias("succeeded"),
        F.max(F.col("phase").isNotNull()).alias("submitted"),
    )
    query = Window.partitionBy("query_id")
    statistics = [F.max(c).over(query).alias(c) for c in ("bytes_scanned", "engine_ms", "state", "succeeded")]
    rows = per_query.select("execution_id", "query_id", "submitted", *statistics)
    rows = rows.where("execution_id IS NOT NULL AND submitted")
    if run_id is not None:
        rows = rows.where(F.col("execution_id") == run_id)
    state = F.when(F.col("succeeded"), "SUCCEEDED").otherwise(F.col("state"))
    return rows.select("execution_id", "query_id", state.alias("state"), "bytes_scanned", "engine_ms")


def run_scan_metrics(
    lines: DataFrame,
    runs: DataFrame,
    run_id: str | None = None,
    usd_per_tb: float = 5.0,
) -> DataFrame:
    """Scan totals per run: its distinct queries, failed ones included, and their statistics.

    ``runs`` holds execution_id, duration_seconds and input_events. Raises if a run named
    no query. Cost and rate are not rounded.
    """
    if usd_per_tb < 0:
        raise ValueError("rate must not be negative")
    wanted = runs if run_id is None else runs.where(F.col("execution_id") == run_id)
    totals = run_queries(lines, run_id).groupBy("execution_id").agg(
        F.count(F.lit(1)).alias("query_count"),
        F.count_if(F.coalesce(F.col("state") != "SUCCEEDED", F.lit(True))).alias("failed_queries"),
        F.coalesce(F.sum("bytes_scanned"), F.lit(0)).alias("bytes_scanned"),
        F.coalesce(F.sum("engine_ms"), F.lit(0)).alias("engine_ms"),
    )
    checked = F.when(F.col("query_count").isNull(), F.raise_error(F.lit("a run has no queries")))
    rate = F.try_divide(F.col("input_events"), F.col("duration_seconds"))
    return wanted.join(totals, "execution_id", "left").select(
        "execution_id",
        checked.otherwise(F.col("query_count")).alias("query_count"),
        "failed_queries",
        "bytes_scanned",
        "engine_ms",
        (F.col("bytes_scanned") / 1e12 * usd_per_tb).alias("scan_usd"),
        rate.alias("events_per_second"),
    )
