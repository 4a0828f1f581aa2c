import pytest
from pyspark.sql import functions as F

from eventmart.operators import checks, models
from eventmart.operators.windows import DateWindow
from eventmart.sources import generate

DAY = DateWindow.parse({"start": "2024-01-01", "end": "2024-01-01"})
NEXT = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-02"})
FIRST = "event_id = 'e00000000000001'"
TWO = "event_id IN ('e00000000000001', 'e00000000000002')"
USER = "user_id = 'u0000000001'"


def _set(column, value, where):
    return lambda df: df.withColumn(column, F.when(F.expr(where), F.lit(value)).otherwise(F.col(column)))


def _both(*steps):
    def apply(df):
        for step in steps:
            df = step(df)
        return df

    return apply


def _failed(results):
    assert {r["status"] for r in results} <= {"pass", "fail"}
    return {r["name"]: r["failures"] for r in results if r["status"] == "fail"}


@pytest.fixture(scope="module")
def clean(spark):
    events = models.stage_events(generate.events_frame(spark, 24, 6)).cache()
    users = models.stage_users(generate.users_frame(spark, 6)).cache()
    facts, dim = models.fct_events(events, users).cache(), models.dim_users(users).cache()
    return checks.Tables(events, users, dim, facts)


def _staging(tables, window=None, events=None, users=None):
    changed = checks.Tables(
        events(tables.stg_raw_events) if events else tables.stg_raw_events,
        users(tables.stg_raw_users) if users else tables.stg_raw_users,
        tables.dim_users,
        tables.fct_events,
    )
    return _failed(checks.run_checks(changed, "staging", window))


def _marts(tables, window=None, facts=None, dim=None):
    changed = checks.Tables(
        tables.stg_raw_events,
        tables.stg_raw_users,
        dim(tables.dim_users) if dim else tables.dim_users,
        facts(tables.fct_events) if facts else tables.fct_events,
    )
    return _failed(checks.run_checks(changed, "marts", window))


@pytest.mark.parametrize(
    "layer,window,count", [("staging", None, 17), ("staging", DAY, 19), ("marts", None, 18), ("marts", DAY, 18)]
)
def test_clean_data_passes_all(clean, layer, window, count):
    results = checks.run_checks(clean, layer, window)
    assert len({r["name"] for r in results}) == count
    assert checks.summarize(results) == {"total": count, "passed": count, "failed": 0, "errors": 0}


EV, US = "stg_raw_events", "stg_raw_users"
COPY = lambda df: df.unionAll(df.where(FIRST))
COPY_USER = lambda df: df.unionAll(df.where(USER))


@pytest.mark.parametrize(
    "events,users,expected",
    [
        (COPY, None, {f"unique_{EV}_event_id": 1}),
        (_set("user_id", "missing", FIRST), None, {f"relationships_{EV}": 1}),
        (_set("amount", -1.0, FIRST), None, {f"nonnegative_amount_{EV}": 1}),
        (_set("amount", None, FIRST), None, {}),
        (_set("event_timestamp", "invalid", FIRST), None, {"valid_event_time": 1}),
        (_set("event_type", "unknown", FIRST), None, {f"accepted_values_{EV}": 1}),
        (
            _both(_set("user_id", "missing", FIRST), _set("amount", -1.0, FIRST)),
            None,
            {f"relationships_{EV}": 1, f"nonnegative_amount_{EV}": 1},
        ),
        (_set("event_id", None, FIRST), None, {f"not_null_{EV}_event_id": 1}),
        (
            _set("event_id", None, TWO),
            None,
            {f"not_null_{EV}_event_id": 2, f"unique_{EV}_event_id": 1},
        ),
        (_set("user_id", None, FIRST), None, {f"not_null_{EV}_user_id": 1, f"relationships_{EV}": 1}),
        (_set("event_type", None, FIRST), None, {f"not_null_{EV}_event_type": 1}),
        (
            _set("event_timestamp", None, FIRST),
            None,
            {f"not_null_{EV}_event_timestamp": 1, "valid_event_time": 1},
        ),
        (lambda df: df.where("false"), None, {f"nonempty_{EV}": 1}),
        (None, lambda df: df.where("false"), {f"nonempty_{US}": 1, f"relationships_{EV}": 24}),
        (None, COPY_USER, {f"unique_{US}_user_id": 1, f"unique_{US}_email": 1}),
        (None, _set("username", None, USER), {f"not_null_{US}_username": 1}),
        (None, _set("email", None, USER), {f"not_null_{US}_email": 1}),
        (None, _set("email", "user2@example.com", USER), {f"unique_{US}_email": 1}),
        (None, _set("created_at", "never", USER), {"valid_user_time": 1}),
        (None, _set("country", None, USER), {}),
        (None, _set("user_id", None, USER), {f"not_null_{US}_user_id": 1, f"relationships_{EV}": 4}),
    ],
)
def test_one_staging_defect(clean, events, users, expected):
    assert _staging(clean, None, events, users) == expected


@pytest.mark.parametrize(
    "users,expected",
    [
        (_set("username", "renamed", USER), 1),
        (_set("country", None, USER), 1),
        (_set("created_at", "2024-01-01T00:00:00.001Z", USER), 1),
        (lambda df: df.unionAll(df.where(USER).selectExpr("'u9'", "'n'", "'e9'", "created_at", "country")), 0),
    ],
)
def test_profiles_are_fixed_in_a_window(clean, users, expected):
    found = _staging(clean, DAY, users=users)
    assert found == ({"incremental_profiles_unchanged": 1} if expected else {})


def test_null_country_on_both_sides_is_no_change(clean):
    blank = _set("country", None, USER)
    tables = checks.Tables(
        clean.stg_raw_events,
        blank(clean.stg_raw_users),
        blank(clean.dim_users),
        _set("user_country", None, USER)(clean.fct_events),
    )
    assert _failed(checks.run_checks(tables, "staging", DAY)) == {}
    assert _failed(checks.run_checks(tables, "marts", DAY)) == {}


def test_key_that_moves_into_the_window(clean):
    moved = _set("event_timestamp", "2024-01-02T00:00:00Z", FIRST)
    assert _staging(clean, NEXT, events=moved) == {"incremental_key_date_stable": 1}
    assert _staging(clean, DAY, events=moved) == {}


FACT, DIM = "fct_events", "dim_users"


@pytest.mark.parametrize(
    "facts,dim,expected",
    [
        (COPY, None, {f"unique_{FACT}_event_id": 1, "event_count_reconciliation": 1}),
        (lambda df: df.where(f"NOT ({FIRST})"), None, {"event_count_reconciliation": 1}),
        (_set("event_id", None, FIRST), None, {f"not_null_{FACT}_event_id": 1}),
        (_set("user_id", None, FIRST), None, {f"not_null_{FACT}_user_id": 1, f"relationships_{FACT}": 1}),
        (_set("user_id", "missing", FIRST), None, {f"relationships_{FACT}": 1}),
        (_set("event_type", None, FIRST), None, {f"not_null_{FACT}_event_type": 1}),
        (_set("event_type", "unknown", FIRST), None, {f"accepted_values_{FACT}": 1}),
        (_set("event_timestamp", None, FIRST), None, {f"not_null_{FACT}_event_timestamp": 1}),
        (_set("event_date", None, FIRST), None, {f"not_null_{FACT}_event_date": 1}),
        (_set("amount", -0.5, TWO), None, {f"nonnegative_amount_{FACT}": 2}),
        (_set("username", "other", FIRST), None, {"event_attributes_match_users": 1}),
        (_set("user_country", None, FIRST), None, {"event_attributes_match_users": 1}),
        (None, _set("email", "moved@example.com", USER), {"event_attributes_match_users": 4}),
        (None, _set("created_at", None, USER), {f"not_null_{DIM}_created_at": 1}),
        (
            None,
            COPY_USER,
            {f"unique_{DIM}_user_id": 1, f"unique_{DIM}_email": 1, "user_count_reconciliation": 1},
        ),
        (
            None,
            _set("user_id", None, USER),
            {f"not_null_{DIM}_user_id": 1, f"relationships_{FACT}": 4},
        ),
        (
            None,
            _set("username", None, USER),
            {f"not_null_{DIM}_username": 1, "event_attributes_match_users": 4},
        ),
        (None, _set("email", None, USER), {f"not_null_{DIM}_email": 1, "event_attributes_match_users": 4}),
    ],
)
def test_one_mart_defect(clean, facts, dim, expected):
    assert _marts(clean, None, facts, dim) == expected


def test_window_reconciles_only_its_dates(clean):
    moved = lambda df: df.where(f"NOT ({FIRST})")
    assert _marts(clean, DAY, facts=moved) == {"event_count_reconciliation": 1}
    assert _marts(clean, NEXT, facts=moved) == {}


def test_missing_column_breaks_only_its_checks(clean):
    tables = checks.Tables(clean.stg_raw_events.drop("amount", "event_timestamp"), clean.stg_raw_users)
    results = checks.run_checks(tables, "staging")
    broken = {r["name"] for r in results if r["status"] == "error"}
    assert broken == {
        f"nonnegative_amount_{EV}",
        "valid_event_time",
        f"not_null_{EV}_event_timestamp",
    }
    assert all(r["failures"] == 0 for r in results)
    assert checks.summarize(results) == {"total": 17, "passed": 14, "failed": 0, "errors": 3}


def test_runtime_error_breaks_only_its_checks(clean):
    exploding = F.when(F.expr(FIRST), F.raise_error(F.lit("boom"))).otherwise(F.col("amount"))
    tables = checks.Tables(
        clean.stg_raw_events.withColumn("amount", exploding.cast("double")), clean.stg_raw_users
    )
    results = checks.run_checks(tables, "staging")
    broken = {r["name"]: r["error"] for r in results if r["status"] == "error"}
    assert set(broken) == {f"nonnegative_amount_{EV}"} and "boom" in broken.popitem()[1]


def test_absent_marts_are_errors_in_a_window(clean):
    tables = checks.Tables(clean.stg_raw_events, clean.stg_raw_users)
    results = checks.run_checks(tables, "staging", DAY)
    broken = {r["name"] for r in results if r["status"] == "error"}
    assert broken == {"incremental_key_date_stable", "incremental_profiles_unchanged"}


def test_result_rows_equal_the_driver_results(clean):
    shown = checks.check_results(clean, "staging").orderBy("position").collect()
    results = checks.run_checks(clean, "staging")
    assert [(r.test_name, r.model, r.column_name, r.kind, r.failures, r.status) for r in shown] == [
        (r["name"], r["model"], r["column"], r["kind"], r["failures"], r["status"]) for r in results
    ]


def test_unknown_layer():
    with pytest.raises(ValueError):
        checks.checks_for("raw")


# -- uniqueness from one pass and from key hashes ---------------------------------


def test_unique_keys_of_a_table_share_one_pass(clean, spark):
    twice = clean.stg_raw_users.unionAll(clean.stg_raw_users.where(USER))
    changed = checks.Tables(clean.stg_raw_events, twice.withColumn("email", F.lit("same")))
    failed = _failed(checks.run_checks(changed, "staging"))
    assert (failed["unique_stg_raw_users_user_id"], failed["unique_stg_raw_users_email"]) == (1, 1)
    users = changed.stg_raw_users.repartition(3)
    one = checks._repeated_keys("stg_raw_users")(checks.Tables(clean.stg_raw_events, users))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and plan.count("Generate explode(") == 1
    assert one.collect()[0].asDict() == {"user_id": 1, "email": 1}


def _hashed(tables, **replaced):
    facts = replaced.get("facts", tables.fct_events)
    hashes = facts.select(checks._key_hash("event_id").alias("key_hash"), "event_date")
    return checks.Tables(tables.stg_raw_events, tables.stg_raw_users, tables.dim_users, facts, hashes)


def test_key_hashes_find_the_same_repeated_facts(clean):
    again = clean.fct_events.unionAll(clean.fct_events.where(TWO))
    nulls = again.unionAll(clean.fct_events.limit(3).withColumn("event_id", F.lit(None).cast("string")))
    for facts, repeated in ((clean.fct_events, None), (again, 2), (nulls, 3)):
        failed = _failed(checks.run_checks(_hashed(clean, facts=facts), "marts"))
        assert failed.get("unique_fct_events_event_id") == repeated


def test_equal_hashes_of_different_keys_are_no_failure(clean, spark):
    tables = _hashed(clean)
    same = tables.fct_hashes.withColumn("key_hash", F.lit(7).cast("long"))
    changed = checks.Tables(*[getattr(tables, n) for n in ("stg_raw_events", "stg_raw_users", "dim_users", "fct_events")], same)
    assert "unique_fct_events_event_id" not in _failed(checks.run_checks(changed, "marts"))


def test_moved_keys_are_found_through_hashes(clean):
    moved = clean.fct_events.withColumn("event_date", F.when(F.expr(FIRST), F.expr("date_add(event_date, 9)")).otherwise(F.col("event_date")))
    assert _failed(checks.run_checks(_hashed(clean, facts=moved), "staging", DAY)).get("incremental_key_date_stable") == 1
    assert "incremental_key_date_stable" not in _failed(checks.run_checks(_hashed(clean), "staging", DAY))


def test_facts_without_a_repeated_hash_are_not_read_for_uniqueness(clean, spark):
    unread = clean.fct_events.withColumn("event_id", F.raise_error(F.lit("read")).cast("string"))
    tables = _hashed(clean)
    tables = checks.Tables(tables.stg_raw_events, tables.stg_raw_users, tables.dim_users, unread, tables.fct_hashes)
    check = next(c for c in checks.checks_for("marts") if c.name == "unique_fct_events_event_id")
    assert check.own(tables).collect()[0]["value"] == 0


def test_a_broken_check_is_found_by_halves(clean, monkeypatch):
    exploding = F.when(F.expr(FIRST), F.raise_error(F.lit("boom"))).otherwise(F.col("amount"))
    tables = checks.Tables(clean.stg_raw_events.withColumn("amount", exploding), clean.stg_raw_users)
    jobs, collected = [], checks._collected
    monkeypatch.setattr(checks, "_collected", lambda rows: jobs.append(1) or collected(rows))
    results = checks.run_checks(tables, "staging")
    assert [r["name"] for r in results if r["status"] != "pass"] == ["nonnegative_amount_stg_raw_events"]
    assert len(jobs) <= 1 + 2 * 5  # 17 checks
