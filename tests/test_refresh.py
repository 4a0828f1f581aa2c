import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from eventmart.operators import reports
from eventmart.plans import acceptance, publication
from eventmart.plans import refresh as refresh_module
from eventmart.plans.lake import Lake
from eventmart.plans.publication import PublicationRefused
from eventmart.plans.refresh import GateFailed, refresh, refresh_from_files
from eventmart.sources import generate, raw
from eventmart.storage import files

GOOD = {"total": 18, "passed": 18, "failed": 0, "errors": 0}
DAY1 = {"start": "2024-01-01", "end": "2024-01-01"}
DAY2 = {"start": "2024-01-02", "end": "2024-01-02"}
# The report on the 24-event sample.
SUMMARY = [
    ("click", 4, 0.0),
    ("login", 4, 0.0),
    ("logout", 4, 0.0),
    ("page_view", 4, 0.0),
    ("purchase", 4, 0.44),
    ("signup", 4, 0.0),
]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    """A lake after one full run over the sample; tests must not change it."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("published")))
    events, users = generate.events_frame(spark, 24, 6), generate.users_frame(spark, 6)
    document = refresh(lake, events, users, "base")
    return lake, document


@pytest.fixture()
def base(spark, lake, sample_events, sample_users):
    refresh(lake, sample_events, sample_users, "base")
    return lake


def _state(lake):
    return {name: rows_of(mart.read()) for name, mart in lake.marts.items()}


def _plus(events, **changes):
    """The events and a changed copy of the first one."""
    first = events.where("event_id = 'e00000000000001'")
    for name, value in changes.items():
        first = first.withColumn(name, F.lit(value))
    return events.unionByName(first)


def test_full_run_on_the_sample(published):
    lake, document = published
    assert [tuple(r) for r in reports.summary_by_type(lake.fct_events.read()).collect()] == SUMMARY
    assert document["quality"] == GOOD and document["window"] is None
    assert document["revision"] == publication.revision_of("base")
    assert publication.resolve(lake) == document == publication.resolve(lake, document["revision"])
    assert files.names(lake.spark, f"{lake.root}/staging") == []
    assert lake.fct_events.read().schema.names[:5] == [
        "event_id",
        "user_id",
        "event_type",
        "event_timestamp",
        "event_date",
    ]


def test_audit_rows_of_a_run(published):
    lake, _ = published
    audit = lake.audit.read()
    assert len(audit.columns) == 28
    rows = audit.collect()
    assert len(rows) == 35 and len({r.id for r in rows}) == 35
    assert {r.invocation_id for r in rows} == {"base:staging", "base:marts"}
    assert {(r.severity, r.status, r.failures, r.failed_row_count) for r in rows} == {("ERROR", "pass", 0, 0)}
    other = json.loads(rows[0].other)
    assert other["name"] == rows[0].test_name and rows[0].database_name == "eventmart"
    assert [r.tests for r in reports.audit_status_counts(audit).collect()] == [35]
    unset = [c for c in audit.columns if all(r[c] is None for r in rows)]
    assert len(unset) == 13


def test_replay_is_identical(base, sample_events, sample_users):
    before = _state(base)
    refresh(base, sample_events, sample_users, "again")
    assert _state(base) == before
    assert publication.verify_counts(base, {"events": 24, "users": 6}) == {"events": 24, "users": 6}


@pytest.mark.parametrize(
    "changes",
    [
        {},  # duplicate
        {"event_id": "x", "user_id": "missing"},
        {"event_id": "x", "amount": -1.0},
        {"event_id": "x", "timestamp": "invalid"},
        {"event_id": "x", "event_type": "unknown"},
    ],
)
def test_invalid_source_changes_nothing(published, sample_events, sample_users, changes):
    lake, document = published
    before = lake.snapshot_ids()
    with pytest.raises(GateFailed) as failed:
        refresh(lake, _plus(sample_events, **changes), sample_users, "bad")
    assert failed.value.layer == "staging" and failed.value.summary["failed"] == 1
    assert lake.snapshot_ids() == before and publication.resolve(lake) == document


def test_late_event_needs_its_window(base, sample_events, sample_users):
    late = _plus(sample_events, event_id="late-event", timestamp="2024-01-01T00:00:00+00:00")
    refresh(base, late, sample_users, "next-day", DAY2)
    assert base.fct_events.read().count() == 24
    document = refresh(base, late, sample_users, "that-day", DAY1)
    assert base.fct_events.read().count() == 25
    assert document["window"] == DAY1 and document["quality"] == GOOD


def test_window_before_any_full_run_is_refused(lake, sample_events, sample_users):
    with pytest.raises(GateFailed) as failed:
        refresh(lake, sample_events, sample_users, "early", DAY1)
    assert failed.value.summary["errors"] == 2
    assert lake.snapshot_ids() == {"dim_users": None, "fct_events": None}


def test_changed_profile_needs_a_full_run(base, sample_events, sample_users):
    renamed = sample_users.withColumn(
        "name", F.when(F.col("user_id") == "u0000000001", "Renamed").otherwise(F.col("name"))
    )
    with pytest.raises(GateFailed):
        refresh(base, sample_events, renamed, "windowed", DAY1)
    refresh(base, sample_events, renamed, "full")
    assert base.fct_events.read().where("username = 'Renamed'").count() == 4


def test_failure_between_commits_leaves_the_publication(base, sample_events, sample_users):
    document, facts = publication.resolve(base), rows_of(base.fct_events.read())
    pinned = rows_of(publication.published_daily_by_country(base))
    moved = sample_users.withColumn("country", F.lit("XX"))

    def fail():
        raise RuntimeError("between the commits")

    with pytest.raises(RuntimeError, match="between"):
        refresh(base, sample_events, moved, "broken", before_facts=fail)
    assert base.dim_users.read().where("country = 'XX'").count() == 6
    assert rows_of(base.fct_events.read()) == facts
    assert publication.resolve(base) == document
    assert rows_of(publication.published_daily_by_country(base)) == pinned
    refresh(base, sample_events, moved, "rerun")
    assert rows_of(publication.published_daily_by_country(base)) != pinned


def test_moved_row_fails_reconciliation_after_the_merge(base, sample_events, sample_users):
    """A row whose source moved out of the window stays, and the mart gate notices."""
    document = publication.resolve(base)
    moved = sample_events.withColumn(
        "timestamp",
        F.when(F.col("event_id") == "e00000000000001", "2024-01-05T00:00:00Z").otherwise(F.col("timestamp")),
    )
    with pytest.raises(GateFailed) as failed:
        refresh(base, moved, sample_users, "moved", DAY1)
    assert failed.value.layer == "marts" and failed.value.summary["failed"] == 1
    assert publication.resolve(base) == document


def test_drill(base, sample_events, sample_users):
    found = acceptance.failure_drill(base, sample_events, sample_users, "drill")
    assert found == {
        "layer": "staging",
        "failed_checks": 2,
        "publication_unchanged": True,
        "marts_unchanged": True,
    }
    refresh(base, sample_events, sample_users, "recovery")
    assert publication.verify_counts(base, {"events": 24, "users": 6})


def test_partitioned_files(spark, lake, tmp_path):
    root = str(tmp_path / "set")
    generate.generate(spark, root, 10, 3, 2, 86_396, True)
    paths = (f"{root}/raw/events", f"{root}/raw/users")
    assert acceptance.replay(lake, root, ("full",)) == {"events": 10, "users": 3}
    refresh_from_files(lake, *paths, "day", DAY2, True)
    assert lake.fct_events.read().count() == 10
    with pytest.raises(GateFailed):  # no rows on the pruned dates
        refresh_from_files(lake, *paths, "empty", {"start": "2025-01-01", "end": "2025-01-01"}, True)
    with pytest.raises(ValueError):
        refresh_from_files(lake, *paths, "flag", DAY2, "yes")


def test_appended_batch_is_merged(spark, lake, tmp_path):
    path, users = str(tmp_path / "events"), str(tmp_path / "users")
    raw.replace_users(generate.users_frame(spark, 6), users)
    for run, start in (("one", 1), ("two", 25)):
        raw.append_events(generate.events_frame(spark, 24, 6, start), path)
        refresh_from_files(lake, path, users, run)
    assert lake.fct_events.read().select("event_id").distinct().count() == 48


def test_published_run_id_is_refused_before_any_write(base, sample_events, sample_users):
    before, staged = base.snapshot_ids(), files.names(base.spark, f"{base.root}/staging")
    with pytest.raises(PublicationRefused):
        refresh(base, _plus(sample_events, event_id="extra"), sample_users, "base")
    assert base.snapshot_ids() == before and files.names(base.spark, f"{base.root}/staging") == staged


def test_acceptance_works_again_and_again(spark, lake, tmp_path):
    root = str(tmp_path / "set")
    generate.generate(spark, root, 24, 6)
    for _ in range(2):
        assert acceptance.replay(lake, root, ("once",)) == {"events": 24, "users": 6}


def test_commit_between_gate_and_publication_is_refused(base, sample_events, sample_users, monkeypatch):
    """The attested snapshots are those that the gate has read."""
    whole = refresh_module.gate

    def meddled(lake, layer, *args, **kwargs):
        summary = whole(lake, layer, *args, **kwargs)
        if layer == "marts":
            lake.dim_users.commit(lake.dim_users.current().directories, lake.dim_users.current())
        return summary

    monkeypatch.setattr(refresh_module, "gate", meddled)
    document = publication.resolve(base)
    with pytest.raises(PublicationRefused):
        refresh(base, sample_events, sample_users, "meddled")
    assert publication.resolve(base) == document


# -- publication -----------------------------------------------------------------


def test_nothing_published(lake):
    with pytest.raises(LookupError):
        publication.resolve(lake)


@pytest.mark.parametrize(
    "quality",
    [
        {"total": 18, "passed": 17, "failed": 1, "errors": 0},
        {"total": 18, "passed": 17, "failed": 0, "errors": 1},
        {"total": 0, "passed": 0, "failed": 0, "errors": 0},
        {"total": 18, "passed": 17, "failed": 0, "errors": 0},
    ],
)
def test_failed_checks_are_never_attested(published, quality):
    lake, _ = published
    with pytest.raises(PublicationRefused):
        publication.attest(lake, "other", quality, lake.snapshot_ids())
    with pytest.raises(PublicationRefused):
        publication.publish(lake, "other")


def test_changed_snapshots_are_refused(base, sample_users):
    publication.attest(base, "late", GOOD, base.snapshot_ids())
    base.dim_users.rollback(1)
    with pytest.raises(PublicationRefused):
        publication.publish(base, "late")


def test_retry_is_identical_and_other_content_is_refused(base):
    publication.attest(base, "again", GOOD, base.snapshot_ids())
    first = publication.publish(base, "again", DAY1)
    assert publication.publish(base, "again", DAY1) == first
    with pytest.raises(PublicationRefused):
        publication.publish(base, "again", DAY2)


def test_old_revision_stays_readable(base, sample_events, sample_users):
    first = publication.resolve(base)
    refresh(base, _plus(sample_events, event_id="extra"), sample_users, "second")
    assert publication.read_published(base)["fct_events"].count() == 25
    assert publication.read_published(base, first["revision"])["fct_events"].count() == 24


def test_wrong_counts_are_rejected(published):
    lake, _ = published
    with pytest.raises(RuntimeError, match="expected 999, found 24"):
        publication.verify_counts(lake, {"events": 999, "users": 6})


def test_other_database_is_rejected(published):
    lake, _ = published
    with pytest.raises(ValueError):
        publication.resolve(Lake(lake.spark, lake.root, "other"))
    with pytest.raises(ValueError):
        Lake(lake.spark, lake.root, "Not Valid")


def test_a_window_run_writes_new_users_only(spark, lake, sample_events, sample_users):
    refresh(lake, sample_events, sample_users, "base")
    before = lake.dim_users.current()
    extra = sample_users.limit(1).withColumns({"user_id": F.lit("u9"), "email": F.lit("new@example.com")})
    refresh(lake, sample_events, sample_users.unionByName(extra), "day", window=DAY1)
    after = lake.dim_users.current()
    assert set(before.directories) < set(after.directories) and after.rows == before.rows + 1
    assert sorted(d.rows for d in set(after.directories) - set(before.directories)) == [1]
