"""The registered queries as DuckDB SQL over the driver's tables.

Each text starts from the tables alone; none depends on what the engine computed.
"""

from __future__ import annotations

WINDOW = "BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"
NEXT_WINDOW = "BETWEEN DATE '2024-01-20' AND DATE '2024-01-25'"
FIRST_LOAD = "BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'"

_ISO = "replace(CAST({ts} AS VARCHAR), ' ', 'T') || '+00:00'"
_MAPPED = "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'logout' ELSE event_type END"
_K = "json_extract_string(props, '$.k')"
_MAIL = "lower(replace(c_name, '#', '.')) || '@example.com'"


def _events(name: str, where: str = "true", **replaced: str) -> str:
    """CTE of staged events; ``at`` is their parsed time."""
    columns = {
        "event_id": "CAST(event_id AS VARCHAR)",
        "user_id": "CAST(user_id AS VARCHAR)",
        "event_type": _MAPPED,
        "page": f"'/products/' || {_K}",
        "event_timestamp": _ISO.format(ts="ts"),
        "session_id": "CAST(event_id // 8 AS VARCHAR)",
        "amount": "value",
        "at": "date_trunc('millisecond', ts)",
    } | replaced
    chosen = ", ".join(f'{text} AS "{column}"' for column, text in columns.items())
    return f"{name} AS (SELECT {chosen} FROM events WHERE {where})"


def _users(name: str, where: str = "true", **replaced: str) -> str:
    columns = {
        "user_id": "CAST(c_custkey AS VARCHAR)",
        "username": "c_name",
        "email": _MAIL,
        "created_text": "'2024-01-01T00:00:00+00:00'",
        "created_at": "TIMESTAMP '2024-01-01 00:00:00'",
        "country": "n_name",
    } | replaced
    chosen = ", ".join(f"{text} AS {column}" for column, text in columns.items())
    return (
        f"{name} AS (SELECT {chosen} FROM customer "
        f"LEFT JOIN nation ON n_nationkey = c_nationkey WHERE {where})"
    )


EV, US = _events("ev"), _users("us")
DIRTY_EV = _events(
    "dirty_ev",
    event_type=f"CASE WHEN {_K} <> '0' THEN event_type END",
    user_id=f"CASE WHEN {_K} = '1' THEN 'missing' WHEN {_K} <> '2' THEN CAST(user_id AS VARCHAR) END",
    event_timestamp=f"CASE WHEN {_K} = '3' THEN 'invalid' WHEN {_K} <> '4' THEN {_ISO.format(ts='ts')} END",
    at=f"CASE WHEN {_K} NOT IN ('3', '4') THEN date_trunc('millisecond', ts) END",
    event_id=f"CASE WHEN {_K} = '6' THEN 'twin-' || user_id WHEN {_K} <> '5' THEN CAST(event_id AS VARCHAR) END",
    amount=f"CASE WHEN {_K} = '7' THEN -value ELSE value END",
)
DIRTY_US = _users(
    "dirty_us",
    user_id="CASE WHEN c_acctbal BETWEEN 8000 AND 9000 THEN 'twin-' || c_nationkey "
    "WHEN c_acctbal BETWEEN 7900 AND 7999 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END",
    username="CASE WHEN c_acctbal NOT BETWEEN 7000 AND 7500 THEN c_name END",
    email="CASE WHEN c_acctbal < 0 THEN 'shared-' || c_nationkey || '@example.com' "
    f"WHEN c_acctbal NOT BETWEEN 6000 AND 6500 THEN {_MAIL} END",
    created_text="CASE WHEN c_acctbal BETWEEN 5000 AND 5500 THEN 'never' ELSE '2024-01-01T00:00:00Z' END",
    created_at="CASE WHEN c_acctbal NOT BETWEEN 5000 AND 5500 THEN TIMESTAMP '2024-01-01 00:00:00' END",
)
_SHIFTED = "CASE WHEN event_type = 'signup' THEN ts + INTERVAL 1 DAY ELSE ts END"
CHANGED_EV = _events(
    "changed_ev",
    "event_type <> 'error'",
    amount="CASE WHEN event_type = 'click' THEN value * 2 ELSE value END",
    event_timestamp=_ISO.format(ts=f"({_SHIFTED})"),
    at=f"date_trunc('millisecond', {_SHIFTED})",
)
CHANGED_US = _users(
    "changed_us",
    "c_mktsegment <> 'FURNITURE'",
    username="CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' Jr' ELSE c_name END",
    country="CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name END",
)

MILLS_EV = _events("mills_ev", amount="CAST(CAST(value AS DECIMAL(18, 2)) + CAST(0.005 AS DECIMAL(4, 3)) AS DOUBLE)")
DOUBLED_EV = _events("doubled_ev", amount="CASE WHEN event_type = 'click' THEN value * 2 ELSE value END")

_FACT_COLUMNS = (
    "e.event_id, e.user_id, e.event_type, e.at AS event_timestamp, CAST(e.at AS DATE) AS event_date, "
    "e.session_id, e.page, e.amount, u.username, u.email AS user_email, u.country AS user_country"
)


def _fact(name: str, events: str, users: str, where: str = "true") -> str:
    return (
        f"{name} AS (SELECT {_FACT_COLUMNS} FROM {events} e "
        f"LEFT JOIN {users} u ON e.user_id = u.user_id WHERE {where})"
    )


FACT = _fact("fact", "ev", "us")
CHANGED_FACT = _fact("changed_fact", "changed_ev", "changed_us")
_STAGED_EVENT = "event_id, user_id, event_type, page, event_timestamp, session_id, amount"
_DIM = "user_id, username, email, created_at, country"
_EXACT = "CAST(round(sum(CAST(amount AS DECIMAL(38, 6))), 2) AS DOUBLE)"
_TOTALS = f"CAST(count(*) AS BIGINT) AS events, {_EXACT} AS amount"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _upserted(source: str, target: str, key: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM {source} UNION ALL SELECT {columns} FROM {target} t "
        f"WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.{key} = t.{key})"
    )


# -- quality checks --------------------------------------------------------------

_TYPES = "('page_view', 'click', 'purchase', 'signup', 'login', 'logout')"


def _count(table: str, where: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def _repeats(table: str, column: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column} HAVING count(*) > 1))"
    )


def _not_null_and_unique(model: str, table: str, columns: list[tuple[str, bool]]) -> list[tuple]:
    rows = []
    for column, unique in columns:
        rows.append((f"not_null_{model}_{column}", model, column, "not_null", _count(table, f"{column} IS NULL")))
        if unique:
            rows.append((f"unique_{model}_{column}", model, column, "unique", _repeats(table, column)))
    return rows


def _accepted(model: str, table: str) -> tuple:
    failing = _count(table, f"event_type NOT IN {_TYPES}")
    return (f"accepted_values_{model}", model, "event_type", "accepted_values", failing)


def _orphans(model: str, events: str, users: str) -> tuple:
    failing = (
        f"(SELECT count(*) FROM {events} e LEFT JOIN {users} u ON e.user_id = u.user_id "
        "WHERE u.user_id IS NULL)"
    )
    return (f"relationships_{model}", model, "user_id", "relationships", failing)


def _negative(model: str, table: str) -> tuple:
    return (f"nonnegative_amount_{model}", model, "amount", "nonnegative", _count(table, "amount < 0"))


def _staging_checks(events: str, users: str) -> list[tuple]:
    ev, us = "stg_raw_events", "stg_raw_users"
    return [
        *_not_null_and_unique(
            ev, events, [("event_id", True), ("user_id", False), ("event_type", False), ("event_timestamp", False)]
        ),
        _accepted(ev, events),
        *_not_null_and_unique(us, users, [("user_id", True), ("username", False), ("email", True)]),
        ("valid_event_time", ev, "event_timestamp", "timestamp", _count(events, '"at" IS NULL')),
        ("valid_user_time", us, "created_at", "timestamp", _count(users, "created_at IS NULL")),
        (f"nonempty_{ev}", ev, "", "nonempty", f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {events})"),
        (f"nonempty_{us}", us, "", "nonempty", f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {users})"),
        _orphans(ev, events, users),
        _negative(ev, events),
    ]


def _staging_window_checks(events: str, users: str, fact: str, dim: str) -> list[tuple]:
    moved = (
        f'(SELECT count(*) FROM {events} s JOIN {fact} f ON s.event_id = f.event_id '
        f'WHERE CAST(s."at" AS DATE) {WINDOW} AND NOT (f.event_date {WINDOW}))'
    )
    changed = (
        f"(SELECT count(*) FROM {dim} d LEFT JOIN {users} u ON d.user_id = u.user_id "
        "WHERE u.user_id IS NULL OR d.username IS DISTINCT FROM u.username "
        "OR d.email IS DISTINCT FROM u.email OR d.country IS DISTINCT FROM u.country "
        "OR d.created_at IS DISTINCT FROM u.created_at)"
    )
    return _staging_checks(events, users) + [
        ("incremental_key_date_stable", "stg_raw_events", "event_id", "append_contract", moved),
        ("incremental_profiles_unchanged", "stg_raw_users", "user_id", "profile_contract", changed),
    ]


def _mart_checks(events: str, users: str, fact: str, dim: str, windowed: bool = False) -> list[tuple]:
    fact_rows = _count(fact, f"event_date {WINDOW}" if windowed else "true")
    staged_rows = _count(events, f'CAST("at" AS DATE) {WINDOW}' if windowed else "true")
    mismatched = (
        f"(SELECT count(*) FROM {fact} f JOIN {dim} d ON f.user_id = d.user_id "
        "WHERE f.username IS DISTINCT FROM d.username OR f.user_email IS DISTINCT FROM d.email "
        "OR f.user_country IS DISTINCT FROM d.country)"
    )

    def differ(left: str, right: str) -> str:
        return f"(SELECT CASE WHEN {left} <> {right} THEN 1 ELSE 0 END)"

    return [
        *_not_null_and_unique(
            "dim_users", dim, [("user_id", True), ("username", False), ("email", True), ("created_at", False)]
        ),
        *_not_null_and_unique(
            "fct_events",
            fact,
            [
                ("event_id", True),
                ("user_id", False),
                ("event_type", False),
                ("event_timestamp", False),
                ("event_date", False),
            ],
        ),
        _accepted("fct_events", fact),
        ("event_count_reconciliation", "fct_events", "event_id", "reconciliation", differ(fact_rows, staged_rows)),
        (
            "user_count_reconciliation",
            "dim_users",
            "user_id",
            "reconciliation",
            differ(_count(dim, "true"), _count(users, "true")),
        ),
        _orphans("fct_events", fact, dim),
        _negative("fct_events", fact),
        ("event_attributes_match_users", "fct_events", "user_id", "enrichment", mismatched),
    ]


def _results(rows: list[tuple]) -> str:
    parts = [
        f"SELECT '{name}' AS test_name, '{model}' AS model, '{column}' AS column_name, "
        f"'{kind}' AS kind, CAST({failing} AS BIGINT) AS failures"
        for name, model, column, kind, failing in rows
    ]
    union = "\nUNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({union}) c"


_DIRTY_STAGING = _with(DIRTY_EV, DIRTY_US) + _results(_staging_checks("dirty_ev", "dirty_us"))
_MART_CTES = _with(
    EV,
    US,
    DIRTY_EV,
    DIRTY_US,
    _fact("bad_fact", "dirty_ev", "us", "e.event_type <> 'error' OR e.event_type IS NULL"),
)
_BAD_MARTS = _MART_CTES + _results(_mart_checks("ev", "us", "bad_fact", "dirty_us"))


def _by_country(events: str, *ctes: str) -> str:
    return (
        _with(US, *ctes)
        + f'SELECT CAST(e."at" AS DATE) AS event_date, u.country, {_TOTALS} '
        + f"FROM {events} e JOIN us u ON e.user_id = u.user_id GROUP BY 1, 2"
    )


_BY_COUNTRY = _by_country("ev", EV)
_BY_COUNTRY_MILLS = _by_country("mills_ev", MILLS_EV)
_N = "(SELECT count(*) FROM events)"
_M = "(SELECT count(*) FROM customer)"


ORACLE = {
    "stg_raw_events": _with(EV) + f"SELECT {_STAGED_EVENT} FROM ev",
    "stg_raw_users": _with(US) + "SELECT user_id, username, email, created_text AS created_at, country FROM us",
    "raw_events_scan": _with(EV) + f"SELECT {_STAGED_EVENT} FROM ev",
    "raw_users_scan": _with(US) + "SELECT user_id, username, email, created_text AS created_at, country FROM us",
    "events_pruned_scan": _with(EV)
    + f"SELECT {_STAGED_EVENT}, strftime(\"at\", '%Y-%m-%d') AS event_date FROM ev "
    + f'WHERE CAST("at" AS DATE) {WINDOW}',
    "raw_load_defects": f"""
        SELECT 'events' AS source, 'corrupt' AS defect, CAST(count(*) AS BIGINT) AS rows FROM events WHERE {_K} = '6'
        UNION ALL SELECT 'events', 'not_a_number', count(*) FROM events WHERE {_K} IN ('1', '5')
        UNION ALL SELECT 'events', 'infinite', count(*) FROM events WHERE {_K} IN ('2', '3', '4')
        UNION ALL SELECT 'users', 'corrupt', count(*) FROM customer WHERE c_name IS NULL AND c_name IS NOT NULL""",
    "manifest_audit": """
        SELECT 'events' AS kind, CAST(count(event_id) AS BIGINT) AS declared,
               CAST(count(ts) AS BIGINT) AS listed_rows, CAST(count(event_type) AS BIGINT) AS found_rows,
               CAST(0 AS BIGINT) AS bad_files, CAST(0 AS BIGINT) AS unlisted_files FROM events
        UNION ALL SELECT 'users', count(c_custkey), count(c_name), count(c_nationkey), 0, 0 FROM customer""",
    "manifest_findings": """
        WITH days AS (
            SELECT 'events' AS kind, strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 2
            UNION ALL SELECT 'users', NULL, count(*) FROM customer
        )
        SELECT kind, day, CASE day WHEN '2024-01-10' THEN 'rows' WHEN '2024-01-11' THEN 'checksum'
                                   WHEN '2024-01-12' THEN 'missing' ELSE 'ok' END AS status,
               CASE day WHEN '2024-01-10' THEN 2 * n ELSE n END AS listed_rows,
               CASE WHEN day IS DISTINCT FROM '2024-01-12' THEN n END AS found_rows
        FROM days
        UNION ALL SELECT kind, day, 'unlisted', NULL, n FROM days WHERE day = '2024-01-12'""",
    "schema_contract": """
        SELECT * FROM (VALUES
          ('events', 'amount', 'double', 'double', 'ok'),
          ('events', 'event_id', 'string', 'string', 'ok'),
          ('events', 'event_type', 'string', 'string', 'ok'),
          ('events', 'page', 'string', 'string', 'ok'),
          ('events', 'session_id', 'string', 'string', 'ok'),
          ('events', 'timestamp', 'string', 'string', 'ok'),
          ('events', 'user_id', 'string', 'string', 'ok'),
          ('users', 'country', 'string', 'string', 'ok'),
          ('users', 'created_at', 'string', 'string', 'ok'),
          ('users', 'email', 'string', 'string', 'ok'),
          ('users', 'name', 'string', 'string', 'ok'),
          ('users', 'user_id', 'string', 'string', 'ok')
        ) AS v(source, field, declared, inferred, status)""",
    "schema_drift": """
        SELECT * FROM (VALUES
          ('events', 'amount', 'double', 'string', 'drift'),
          ('events', 'channel', NULL, 'string', 'extra'),
          ('events', 'event_id', 'string', 'string', 'ok'),
          ('events', 'event_type', 'string', 'string', 'ok'),
          ('events', 'page', 'string', NULL, 'missing'),
          ('events', 'session_id', 'string', 'string', 'ok'),
          ('events', 'timestamp', 'string', 'string', 'ok'),
          ('events', 'user_id', 'string', 'string', 'ok'),
          ('users', 'country', 'string', 'string', 'ok'),
          ('users', 'created_at', 'string', 'bigint', 'drift'),
          ('users', 'email', 'string', 'string', 'ok'),
          ('users', 'name', 'string', 'string', 'ok'),
          ('users', 'user_id', 'string', 'string', 'ok')
        ) AS v(source, field, declared, inferred, status)""",
    "schema_drift_by_file": _with(EV)
    + f"""SELECT 'events' AS source, field, declared, found, status,
               (SELECT count(DISTINCT CAST("at" AS DATE)) FROM ev WHERE CAST("at" AS DATE) {WINDOW}) AS files
        FROM (VALUES ('amount', 'number', 'text', 'drift'), ('page', 'text', NULL, 'missing'),
                     ('channel', NULL, 'text', 'extra')) AS v(field, declared, found, status)
        UNION ALL SELECT 'users', 'created_at', 'text', 'number', 'drift', 1""",
    "refused_writes": f"""
        SELECT change, true AS refused, {_N} AS rows, (SELECT count(DISTINCT event_id) FROM events) AS keys
        FROM (VALUES ('type changed'), ('column gone'), ('column added')) AS v(change)""",
    "batch_append": _with(EV) + "SELECT event_id, user_id, event_type, page, amount FROM ev",
    "dim_users": _with(US) + f"SELECT {_DIM} FROM us",
    "fct_events": _with(EV, US, FACT) + "SELECT * FROM fact",
    "fct_events_window": _with(EV, US, FACT) + f"SELECT * FROM fact WHERE event_date {WINDOW}",
    "fact_window_scan": _with(EV, US, FACT) + f"SELECT * FROM fact WHERE event_date {WINDOW}",
    "bootstrap_empty": f"""
        SELECT CAST(1 AS BIGINT) AS snapshot_id, CAST(NULL AS BIGINT) AS parent_id, CAST(0 AS BIGINT) AS rows
        UNION ALL SELECT 2, 1, {_N}""",
    "compacted_fact": _with(
        EV,
        US,
        CHANGED_EV,
        CHANGED_US,
        FACT,
        CHANGED_FACT,
        f"source AS (SELECT * FROM fact WHERE event_date {WINDOW})",
    )
    + _upserted("source", "changed_fact", "event_id"),
    "time_travel_read": _with(EV, US, FACT) + f"SELECT * FROM fact WHERE event_date {FIRST_LOAD}",
    "merge_dim_users": _with(US, CHANGED_US) + _upserted("changed_us", "us", "user_id", _DIM),
    "merge_fct_full": _with(
        EV,
        US,
        CHANGED_EV,
        CHANGED_US,
        FACT,
        CHANGED_FACT,
        f"old AS (SELECT * FROM fact WHERE event_date {FIRST_LOAD})",
    )
    + _upserted("changed_fact", "old", "event_id"),
    "merge_fct_window": _with(
        EV,
        US,
        CHANGED_EV,
        CHANGED_US,
        FACT,
        CHANGED_FACT,
        f"source AS (SELECT * FROM changed_fact WHERE event_date {WINDOW})",
    )
    + _upserted("source", "fact", "event_id"),
    "replay_diff": f"""
        SELECT 'dim_users' AS name, CAST({_M} AS BIGINT) AS rows, CAST(0 AS BIGINT) AS differences
        UNION ALL SELECT 'fct_events', {_N}, 0""",
    "late_arrival_replay": _with(EV)
    + f'SELECT CAST("at" AS DATE) AS event_date, event_type, {_TOTALS} FROM ev '
    + f"WHERE event_type <> 'purchase' OR CAST(\"at\" AS DATE) {WINDOW} "
    + f'OR CAST("at" AS DATE) {NEXT_WINDOW} GROUP BY 1, 2',
    "gated_refresh": f"""
        SELECT 'dim_users' AS mart, CAST({_M} AS BIGINT) AS rows_before,
               CAST({_M} AS BIGINT) AS rows_after, true AS blocked
        UNION ALL SELECT 'fct_events', {_N}, {_N}, true""",
    "partial_failure_drill": _BY_COUNTRY,
    "summary_by_type": _with(EV) + f"SELECT event_type, {_TOTALS} FROM ev GROUP BY 1",
    "summary_by_type_extremes": """
        WITH ev AS (
            SELECT CASE event_type WHEN 'view' THEN 'page_view' WHEN 'error' THEN 'logout' ELSE event_type END AS event_type,
                   event_id, value FROM events
        ), sums AS (
            SELECT event_type, count(*) AS n, count(*) FILTER (WHERE event_id % 2 = 0) AS evens,
                   sum(CAST(value AS DECIMAL(38, 9))) AS total FROM ev GROUP BY 1
        )
        SELECT event_type, CAST(CASE event_type WHEN 'purchase' THEN 3 * n ELSE n END AS BIGINT) AS events,
               CASE event_type WHEN 'signup' THEN CAST(n * CAST('0.0000004' AS DECIMAL(10, 9)) AS DOUBLE)
                               WHEN 'click' THEN CAST((2 * evens - n) || 'e300' AS DOUBLE)
                               ELSE CAST(total AS DOUBLE) END AS amount
        FROM sums""",
    "daily_by_type": _with(EV)
    + f'SELECT CAST("at" AS DATE) AS event_date, event_type, {_TOTALS} FROM ev '
    + f'WHERE CAST("at" AS DATE) {WINDOW} GROUP BY 1, 2',
    "daily_by_country": _BY_COUNTRY,
    "daily_by_country_mills": _BY_COUNTRY_MILLS,
    "published_daily_by_country": _BY_COUNTRY,
    "published_daily_by_country_mills": _BY_COUNTRY_MILLS,
    "orphan_users": _with(DIRTY_EV, US)
    + "SELECT e.user_id, CAST(count(*) AS BIGINT) AS events FROM dirty_ev e "
    + "LEFT JOIN us u ON e.user_id = u.user_id WHERE u.user_id IS NULL GROUP BY 1",
    "negative_amounts": _with(DIRTY_EV) + "SELECT event_id, amount FROM dirty_ev WHERE amount < 0",
    "duplicate_keys": _with(DIRTY_EV, DIRTY_US)
    + "\nUNION ALL ".join(
        f"SELECT '{key}' AS key, {key} AS key_value, CAST(count(*) AS BIGINT) AS rows "
        f"FROM {table} GROUP BY {key} HAVING count(*) > 1"
        for key, table in (("event_id", "dirty_ev"), ("user_id", "dirty_us"), ("email", "dirty_us"))
    ),
    "enrichment_mismatches": _with(EV, US, CHANGED_US, FACT)
    + """SELECT f.event_id, f.user_id, f.username, f.user_email, f.user_country
         FROM fact f JOIN changed_us d ON f.user_id = d.user_id
         WHERE f.username IS DISTINCT FROM d.username OR f.user_email IS DISTINCT FROM d.email
            OR f.user_country IS DISTINCT FROM d.country""",
    "key_date_moves": _with(EV, US, CHANGED_EV, FACT)
    + f"""SELECT s.event_id, CAST(s."at" AS DATE) AS staged_date, f.event_date AS fact_date
          FROM changed_ev s JOIN fact f ON s.event_id = f.event_id
          WHERE CAST(s."at" AS DATE) {WINDOW} AND NOT (f.event_date {WINDOW})""",
    "profile_changes": _with(US, CHANGED_US)
    + """SELECT d.user_id, CASE WHEN u.user_id IS NULL THEN 'missing' ELSE 'changed' END AS change
         FROM us d LEFT JOIN changed_us u ON d.user_id = u.user_id
         WHERE u.user_id IS NULL OR d.username IS DISTINCT FROM u.username
            OR d.email IS DISTINCT FROM u.email OR d.country IS DISTINCT FROM u.country
            OR d.created_at IS DISTINCT FROM u.created_at""",
    "nonempty_sources": """
        SELECT 'events' AS source FROM events HAVING count(*) = 0
        UNION ALL SELECT 'users' FROM customer HAVING count(*) = 0
        UNION ALL SELECT 'pruned_events' FROM events
                  WHERE CAST(ts AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-01-31' HAVING count(*) = 0""",
    "source_freshness": _with(EV, US)
    + """SELECT source, newest, age_seconds,
                CASE WHEN newest IS NULL OR age_seconds > 172800 THEN 'error'
                     WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
         FROM (SELECT source, newest,
                      CAST(date_sub('second', newest, TIMESTAMP '2024-02-01 06:00:00') AS BIGINT) AS age_seconds
               FROM (SELECT 'events' AS source, max("at") AS newest FROM ev
                     UNION ALL SELECT 'users', max(created_at) FROM us))""",
    "run_scan_metrics": f"""
        SELECT 'run-' || user_id AS execution_id, CAST(count(*) AS BIGINT) AS query_count,
               CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS failed_queries,
               CAST(coalesce(sum(bytes) FILTER (event_type <> 'error'), 0) AS BIGINT) AS bytes_scanned,
               CAST(coalesce(sum(ms) FILTER (event_type <> 'error'), 0) AS BIGINT) AS engine_ms,
               round(coalesce(sum(bytes) FILTER (event_type <> 'error'), 0) / 1e12 * 5.0, 12) AS scan_usd,
               round(CASE WHEN date_sub('second', min(ts), max(ts)) <> 0
                     THEN CAST(count(*) AS DOUBLE) / date_sub('second', min(ts), max(ts)) END, 3)
                 AS events_per_second
        FROM (SELECT *, CAST(round(value * 1000000) AS BIGINT) AS bytes, CAST({_K} AS BIGINT) AS ms FROM events)
        GROUP BY user_id""",
    "run_queries": f"""
        SELECT 'run-' || user_id AS execution_id, 'q-' || event_id AS query_id,
               CASE WHEN event_type <> 'error' THEN 'SUCCEEDED' END AS state,
               CASE WHEN event_type <> 'error' THEN CAST(round(value * 1000000) AS BIGINT) END AS bytes_scanned,
               CASE WHEN event_type <> 'error' THEN CAST({_K} AS BIGINT) END AS engine_ms
        FROM events""",
    "quality_staging": _DIRTY_STAGING,
    "quality_staging_empty": _with(
        "no_ev AS (SELECT * FROM ev WHERE event_type = 'never')", "no_us AS (SELECT * FROM us WHERE length(user_id) = 0)"
    ).replace("WITH ", f"WITH {EV}, {US}, ", 1)
    + _results(_staging_checks("no_ev", "no_us")),
    "quality_marts": _BAD_MARTS,
    "quality_staging_window": _with(EV, US, CHANGED_EV, CHANGED_US, FACT)
    + _results(_staging_window_checks("changed_ev", "changed_us", "fact", "us")),
    "quality_marts_window": _with(EV, US, CHANGED_EV, CHANGED_US, FACT)
    + _results(_mart_checks("changed_ev", "changed_us", "fact", "us", windowed=True)),
    "count_reconciliation": f"SELECT test_name, failures, status FROM ({_BAD_MARTS}) WHERE kind = 'reconciliation'",
    "gate_summary": f"""
        SELECT CAST(count(*) AS BIGINT) AS total,
               CAST(count(*) FILTER (status = 'pass') AS BIGINT) AS passed,
               CAST(count(*) FILTER (status = 'fail') AS BIGINT) AS failed, CAST(0 AS BIGINT) AS errors
        FROM ({_DIRTY_STAGING})""",
    "audit_status_counts": f"""
        SELECT status, CAST(sum(n) AS BIGINT) AS tests
        FROM (SELECT status, count(*) AS n FROM ({_DIRTY_STAGING}) GROUP BY 1
              UNION ALL SELECT 'pass', 35) GROUP BY 1""",
    "audit_failed_checks": f"""
        SELECT CAST(count(DISTINCT test_name) AS BIGINT) AS failed_checks FROM ({_DIRTY_STAGING})
        WHERE status = 'fail' AND failures > 0
          AND test_name IN ('relationships_stg_raw_events', 'nonnegative_amount_stg_raw_events')""",
    "snapshot_log": f"""
        SELECT mart, CAST(id AS BIGINT) AS snapshot_id,
               CAST(CASE WHEN id > 1 THEN id - 1 END AS BIGINT) AS parent_id,
               CAST(CASE WHEN id = 1 THEN 0 WHEN mart = 'dim_users' THEN {_M} ELSE {_N} END AS BIGINT) AS rows,
               id = 3 AS is_current
        FROM (VALUES ('dim_users'), ('fct_events')) m(mart), (VALUES (1), (2), (3)) s(id)""",
    "publish_cycle": f"""
        SELECT run AS execution_id, sha256(run) AS revision, start AS window_start,
               CAST(18 AS BIGINT) AS checks, CAST(18 AS BIGINT) AS passed,
               CAST({_M} AS BIGINT) AS users, CAST({_N} AS BIGINT) AS events
        FROM (VALUES ('full', NULL), ('replay', '2024-01-10')) r(run, start)""",
    "published_count_check": """
        SELECT 'events' AS kind, CAST(count(event_id) AS BIGINT) AS expected,
               CAST(count(DISTINCT event_id) AS BIGINT) AS found, true AS matches FROM events
        UNION ALL SELECT 'users', count(c_custkey), count(DISTINCT c_custkey), true FROM customer""",
    "partitioned_refresh": _by_country(
        "both_ev",
        EV,
        DOUBLED_EV,
        f'both_ev AS (SELECT * FROM ev WHERE NOT (CAST("at" AS DATE) {WINDOW}) '
        f'UNION ALL SELECT * FROM doubled_ev WHERE CAST("at" AS DATE) {WINDOW})',
    ),
    "failure_drill_audit": f"""
        SELECT 'staging' AS layer, CAST(2 AS BIGINT) AS failed_checks, true AS publication_unchanged,
               true AS marts_unchanged, CAST({_N} AS BIGINT) AS recovered_events""",
    "model_parity": f"""
        SELECT name, CAST(n AS BIGINT) AS rows, CAST(0 AS BIGINT) AS differences
        FROM (SELECT 'stg_raw_events' AS name, {_N} AS n UNION ALL SELECT 'stg_raw_users', {_M}
              UNION ALL SELECT 'dim_users', {_M} UNION ALL SELECT 'fct_events', {_N})""",
}
