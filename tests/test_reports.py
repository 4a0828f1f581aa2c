import json
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.utils import CapturedException

from eventmart.operators import models, reports
from eventmart.operators.windows import DateWindow
from eventmart.plans import acceptance
from eventmart.sources import generate


@pytest.fixture(scope="module")
def marts(spark):
    events = models.stage_events(generate.events_frame(spark, 200_000, 50))
    users = models.stage_users(generate.users_frame(spark, 50))
    return models.typed_events(events), models.dim_users(users)


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_country_report_does_not_depend_on_broadcasts(marts, conf, limit):
    """Amounts of three decimals: totals are exact, however the rows are joined and grouped."""
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    facts, users = marts
    # One user holds a third of all events.
    number = F.substring("event_id", 2, 20).cast("long")
    hot = F.when(number % 3 == 0, "u0000000001").otherwise(F.col("user_id"))
    mills = (number % 100_000).cast("decimal(18, 3)") / 1000 + F.lit(0.005).cast("decimal(4, 3)")
    skewed = facts.withColumns({"user_id": hot, "amount": mills.cast("double")})
    rows = reports.daily_by_country(skewed, users).collect()
    assert sum(r.events for r in rows) == 200_000
    assert [(r.event_date, r.country) for r in rows] == sorted((r.event_date, r.country) for r in rows)
    plain = skewed.join(users.select("user_id", "country"), "user_id").select("event_date", "country", "amount")
    want: dict = {}
    for day, country, amount in plain.collect():
        want[day, country] = want.get((day, country), 0) + Decimal(repr(amount))
    cents = {key: float(total.quantize(Decimal("0.01"), ROUND_HALF_UP)) for key, total in want.items()}
    assert {(r.event_date, r.country): r.amount for r in rows} == cents


def test_daily_by_type_window(marts):
    facts, _ = marts
    window = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-02"})
    rows = reports.daily_by_type(facts, window).collect()
    assert {r.event_date for r in rows} == {date(2024, 1, 2)}
    assert sum(r.events for r in rows) == 86_400


def test_orphans_count_null_users(spark):
    events = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "user_id string")
    users = spark.createDataFrame([("b",), (None,)], "user_id string")
    assert rows_of(reports.orphans(events, users)) == [("a", 2), (None, 2)]


def test_table_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    assert rows_of(reports.table_diff(left, right)) == [(1, None, 1), (3, "y", -1)]
    assert reports.table_diff(left, left).isEmpty()


def test_parity_finds_a_changed_definition(spark, monkeypatch):
    events, users = generate.events_frame(spark, 24, 6), generate.users_frame(spark, 6)
    assert all(r.differences == 0 and r.rows > 0 for r in acceptance.model_parity(events, users).collect())
    text = models.SQL_MODELS["stg_raw_users"].replace("name AS username", "email AS username")
    monkeypatch.setitem(models.SQL_MODELS, "stg_raw_users", text)
    found = {r.name: r.differences for r in acceptance.model_parity(events, users).collect()}
    assert found["stg_raw_users"] > 0 and found["dim_users"] > 0 and found["fct_events"] > 0
    assert found["stg_raw_events"] == 0


@pytest.mark.parametrize(
    "as_of,events,users",
    [
        ("2024-01-01 12:00:00", "pass", "pass"),
        ("2024-01-02 00:00:01", "pass", "warn"),
        ("2024-01-03 00:00:24", "warn", "error"),
        ("2024-01-03 00:00:25", "error", "error"),
    ],
)
def test_freshness_limits(sample_events, sample_users, as_of, events, users):
    staged, people = models.stage_events(sample_events), models.stage_users(sample_users)
    times = {
        "events": (staged, models.parsed_time(staged, "event_timestamp")),
        "users": (people, models.parsed_time(people, "created_at")),
    }
    found = {r.source: r.status for r in reports.source_freshness(times, as_of).collect()}
    assert found == {"events": events, "users": users}


def test_empty_source_is_not_fresh(sample_events):
    none = models.stage_events(sample_events).where("false")
    row = reports.source_freshness({"e": (none, models.parsed_time(none, "event_timestamp"))}, "2024-01-01").first()
    assert (row.newest, row.status) == (None, "error")


def test_nonempty(sample_events):
    found = reports.nonempty({"full": sample_events, "none": sample_events.where("false")})
    assert [r.source for r in found.collect()] == ["none"]


# -- run logs --------------------------------------------------------------------

LINES = [
    {"query_id": "q1", "execution_id": "mine", "phase": "submitted"},
    {"query_id": "q1", "execution_id": "mine", "phase": "submitted"},
    {"query_id": "q1", "state": "SUCCEEDED", "bytes_scanned": 2_000_000_000, "engine_ms": 7},
    {"query_id": "q2", "execution_id": "mine", "phase": "submitted"},
    {"query_id": "q2", "state": "FAILED"},
    {"query_id": "q3", "execution_id": "mine", "phase": "submitted"},
    {"query_id": "x", "execution_id": "other", "phase": "submitted"},
    {"query_id": "x", "state": "SUCCEEDED", "bytes_scanned": 99, "engine_ms": 1},
    {"execution_id": "mine", "published_revision": "r"},
    {"query_id": None, "execution_id": "mine"},
    ["not", "an", "object"],
]


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    (folder / "run.log").write_text("\n".join(["not-json", "", *map(json.dumps, LINES)]) + "\n")
    runs = spark.createDataFrame(
        [("mine", 10.0, 500), ("quiet", 1.0, 1)], "execution_id string, duration_seconds double, input_events long"
    )
    return spark.read.text(str(folder)), runs


def test_only_own_queries_are_counted(logs):
    lines, runs = logs
    row = reports.run_scan_metrics(lines, runs, "mine").first()
    assert row.asDict() == {
        "execution_id": "mine",
        "query_count": 3,
        "failed_queries": 2,
        "bytes_scanned": 2_000_000_000,
        "engine_ms": 7,
        "scan_usd": 0.01,
        "events_per_second": 50.0,
    }
    assert reports.run_scan_metrics(lines, runs, "mine", 10.0).first().scan_usd == 0.02


def test_run_without_queries_is_an_error(logs):
    lines, runs = logs
    with pytest.raises(CapturedException, match="no queries"):
        reports.run_scan_metrics(lines, runs, "quiet").collect()
    with pytest.raises(ValueError):
        reports.run_scan_metrics(lines, runs, "mine", -1.0)


def test_statistics_belong_to_a_query_by_its_id(spark):
    lines = [
        {"query_id": "a", "execution_id": "one", "phase": "submitted"},
        {"query_id": "a", "execution_id": "other", "state": "SUCCEEDED", "bytes_scanned": 50_000, "engine_ms": 7},
        {"query_id": "b", "execution_id": "one", "phase": "submitted"},
    ]
    text = spark.createDataFrame([(json.dumps(x),) for x in lines], "value string")
    runs = spark.createDataFrame([("one", 10, 5)], "execution_id string, duration_seconds long, input_events long")
    for run_id in ("one", None):
        row = reports.run_scan_metrics(text, runs, run_id).first()
        assert (row.query_count, row.failed_queries, row.bytes_scanned, row.engine_ms) == (2, 1, 50_000, 7)
        assert row.scan_usd == 50_000 / 1e12 * 5.0 and row.events_per_second == 0.5
    found = rows_of(reports.run_queries(text, "one"))
    assert found == [("one", "a", "SUCCEEDED", 50_000, 7), ("one", "b", None, None, None)]
