"""Staging views and mart models, as DataFrame code and as Spark SQL text.

Both forms define the same models; ``plans.acceptance.model_parity`` compares their
results. Staging only renames: invalid rows stay visible to the quality gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.names import identifier
from eventmart.functions.timeparse import SQL_FUNCTION, utc_millis
from eventmart.operators.windows import DateWindow
from eventmart.schemas import FCT_EVENTS

# A landed staging copy carries the parsed time, so that text is parsed once per run.
PARSED = "_parsed_time"


def stage_events(raw: DataFrame, *extra: str) -> DataFrame:
    return raw.select(
        "event_id",
        "user_id",
        "event_type",
        "page",
        F.col("timestamp").alias("event_timestamp"),
        "session_id",
        "amount",
        *extra,
    )


def stage_users(raw: DataFrame, *extra: str) -> DataFrame:
    username = F.col("name").alias("username")
    return raw.select("user_id", username, "email", "created_at", "country", *extra)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(identifier(name))


def parsed_time(staged: DataFrame, text: str) -> Column:
    """UTC time of a staged row: the landed copy's parsed column, or parsed here."""
    return F.col(PARSED) if PARSED in staged.columns else utc_millis(text)


def in_window(staged_events: DataFrame, window: DateWindow | None) -> DataFrame:
    """Staged events whose UTC date lies in the window; all of them without one."""
    if window is None:
        return staged_events
    day = parsed_time(staged_events, "event_timestamp").cast("date")
    # A stored time takes the range predicate, which reaches the Parquet scan.
    chosen = window.covers if PARSED in staged_events.columns else window.contains
    return staged_events.where(chosen(day))


def dim_users(staged_users: DataFrame) -> DataFrame:
    created = parsed_time(staged_users, "created_at").alias("created_at")
    return staged_users.select("user_id", "username", "email", created, "country")


def typed_events(staged_events: DataFrame) -> DataFrame:
    """Events with their UTC time and date, before user attributes are attached.

    Reports that use no user attribute read this and so need no join.
    """
    when = parsed_time(staged_events, "event_timestamp")
    return staged_events.select(
        "event_id",
        "user_id",
        "event_type",
        when.alias("event_timestamp"),
        when.cast("date").alias("event_date"),
        "session_id",
        "page",
        "amount",
    )


def user_attributes(staged_users: DataFrame) -> DataFrame:
    """The user side of the enrichment join."""
    return staged_users.select(
        F.col("user_id").alias("_user"),
        "username",
        F.col("email").alias("user_email"),
        F.col("country").alias("user_country"),
    )


def fct_events(
    staged_events: DataFrame, staged_users: DataFrame, window: DateWindow | None = None
) -> DataFrame:
    """Events with the attributes of their user; an unknown user leaves them null.

    The join side is left to Catalyst: users are broadcast when their size is
    below the session's threshold, otherwise sort-merge joined, where AQE splits a
    user_id partition that holds far more events than the others.
    """
    events = typed_events(in_window(staged_events, window))
    joined = events.join(user_attributes(staged_users), F.col("user_id") == F.col("_user"), "left")
    return joined.select(*FCT_EVENTS.names)


# -- the same models as Spark SQL ------------------------------------------------

SQL_MODELS = {
    "stg_raw_events": """
        SELECT event_id, user_id, event_type, page, timestamp AS event_timestamp, session_id, amount
        FROM {raw_events}""",
    "stg_raw_users": """
        SELECT user_id, name AS username, email, created_at, country
        FROM {raw_users}""",
    "dim_users": """
        SELECT user_id, username, email, utc_millis(created_at) AS created_at, country
        FROM {stg_raw_users}""",
    "fct_events": """
        WITH timed AS (SELECT *, utc_millis(event_timestamp) AS at_utc FROM {stg_raw_events})
        SELECT t.event_id, t.user_id, t.event_type, t.at_utc AS event_timestamp,
               CAST(t.at_utc AS DATE) AS event_date, t.session_id, t.page, t.amount,
               p.username, p.email AS user_email, p.country AS user_country
        FROM timed t LEFT OUTER JOIN {stg_raw_users} p ON p.user_id = t.user_id""",
}


def sql_models(raw_events: DataFrame, raw_users: DataFrame) -> dict[str, DataFrame]:
    spark = raw_events.sparkSession
    spark.sql(SQL_FUNCTION)
    made = {"raw_events": raw_events, "raw_users": raw_users}
    for name, text in SQL_MODELS.items():
        inputs = {k: v for k, v in made.items() if "{" + k + "}" in text}
        made[name] = spark.sql(text, **inputs)
    return {name: made[name] for name in SQL_MODELS}


def frame_models(raw_events: DataFrame, raw_users: DataFrame) -> dict[str, DataFrame]:
    events, users = stage_events(raw_events), stage_users(raw_users)
    return {
        "stg_raw_events": events,
        "stg_raw_users": users,
        "dim_users": dim_users(users),
        "fct_events": fct_events(events, users),
    }
