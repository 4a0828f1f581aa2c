from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from hashlib import sha512

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmart.operators import models, reports
from eventmart.operators.merge import DuplicateKeys, compact, upsert
from eventmart.operators.windows import DateWindow
from eventmart.schemas import DIM_USERS, FCT_EVENTS, MARTS, SchemaDrift
from eventmart.sources import generate
from eventmart.storage import files
from eventmart.storage.snapshots import Mart

START = date(2024, 1, 1)


def fact(key, day, amount=1.0, user="u1"):
    when = None if day is None else datetime(2024, 1, 1) + timedelta(days=day)
    return (
        key,
        user,
        "click",
        when,
        None if day is None else START + timedelta(days=day),
        "s",
        "/p",
        amount,
        "n",
        "e",
        None,
    )


def facts(spark, rows):
    return spark.createDataFrame([fact(*r) for r in rows], FCT_EVENTS)


def users(spark, rows):
    return spark.createDataFrame([(k, n, f"{k}@x", None, c) for k, n, c in rows], DIM_USERS)


def stored(mart, number=None):
    """key -> (day offset, amount) of a snapshot."""
    return {
        r.event_id: (None if r.event_date is None else (r.event_date - START).days, r.amount)
        for r in mart.read(number).collect()
    }


def test_first_merge_into_a_missing_mart(spark, lake):
    mart = lake.fct_events
    snapshot = upsert(mart, facts(spark, [("a", 0), ("b", 1)]))
    assert (snapshot.id, snapshot.parent, snapshot.rows) == (2, 1, 2)
    assert mart.snapshot(1).rows == 0 and stored(mart, 1) == {}
    assert mart.read(1).schema == FCT_EVENTS
    assert mart.read().schema.names == FCT_EVENTS.names


def test_moved_new_and_untouched_keys(spark, lake):
    mart = lake.fct_events
    first = upsert(mart, facts(spark, [("moves", 0), ("stays", 0), ("other", 1), ("far", 5)]))
    upsert(mart, facts(spark, [("moves", 2, 7.0), ("new", 1)]))
    assert stored(mart) == {
        "moves": (2, 7.0),
        "stays": (0, 1.0),
        "other": (1, 1.0),
        "far": (5, 1.0),
        "new": (1, 1.0),
    }
    assert stored(mart, first.id)["moves"] == (0, 1.0)


def test_dates_without_a_match_are_kept_by_reference(spark, lake):
    mart = lake.fct_events
    first = upsert(mart, facts(spark, [("a", 0), ("b", 1), ("c", 2), ("d", 2)]))
    second = upsert(mart, facts(spark, [("a", 0, 2.0), ("c", 2, 2.0), ("n", 1)]))
    old = {d.day: d for d in first.directories}
    assert old["2024-01-02"] in second.directories  # no row replaced
    assert old["2024-01-01"] not in second.directories  # all rows replaced
    assert old["2024-01-03"] not in second.directories  # one survivor, rewritten
    assert stored(mart) == {"a": (0, 2.0), "b": (1, 1.0), "c": (2, 2.0), "d": (2, 1.0), "n": (1, 1.0)}


def test_replay_rewrites_nothing_but_the_source(spark, lake):
    mart = lake.fct_events
    rows = [(f"k{i}", i % 3) for i in range(30)]
    first = upsert(mart, facts(spark, rows))
    before = rows_of(mart.read())
    second = upsert(mart, facts(spark, rows))
    assert rows_of(mart.read()) == before == rows_of(mart.read(first.id))
    assert len({d.batch for d in second.directories}) == 1


def test_all_attributes_are_replaced_with_nulls_too(spark, lake):
    mart = lake.dim_users
    upsert(mart, users(spark, [("a", "A", "US"), ("b", "B", "GB")]))
    upsert(mart, users(spark, [("a", None, None), ("c", "C", "IN")]))
    assert {(r.user_id, r.username, r.country) for r in mart.read().collect()} == {
        ("a", None, None),
        ("b", "B", "GB"),
        ("c", "C", "IN"),
    }


def test_null_keys_and_dates(spark, lake):
    mart = lake.fct_events
    upsert(mart, facts(spark, [(None, 0, 1.0), ("x", None, 1.0), ("y", None, 1.0)]))
    upsert(mart, facts(spark, [("x", 1, 2.0), (None, 0, 3.0)]))
    got = [(r.event_id, r.event_date, r.amount) for r in mart.read().collect()]
    assert sorted(got, key=repr) == sorted(
        [(None, START, 1.0), (None, START, 3.0), ("x", date(2024, 1, 2), 2.0), ("y", None, 1.0)], key=repr
    )


def test_repeated_source_keys_are_refused(spark, lake):
    mart = lake.fct_events
    upsert(mart, facts(spark, [("a", 0)]))
    with pytest.raises(DuplicateKeys):
        upsert(mart, facts(spark, [("b", 0), ("b", 1)]))
    assert mart.current_id() == 2 and stored(mart) == {"a": (0, 1.0)}


def test_empty_source(spark, lake):
    upsert(lake.fct_events, facts(spark, [("a", 0)]))
    upsert(lake.fct_events, facts(spark, []))
    assert stored(lake.fct_events) == {"a": (0, 1.0)}
    upsert(lake.dim_users, users(spark, []))
    assert lake.dim_users.read().count() == 0


def test_row_that_left_the_window_is_kept(spark, lake):
    """The source filter hides the moved row, so its old version stays."""
    mart = lake.fct_events
    upsert(mart, facts(spark, [("leaves", 1), ("in", 1)]))
    window = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-02"})
    source = facts(spark, [("leaves", 5, 9.0), ("in", 1, 2.0)]).where(window.covers("event_date"))
    upsert(mart, source, stable_in=window)
    assert stored(mart) == {"leaves": (1, 1.0), "in": (1, 2.0)}


def test_wrong_schema_is_refused(spark, lake):
    with pytest.raises(SchemaDrift):
        upsert(lake.fct_events, facts(spark, [("a", 0)]).drop("page"))
    assert lake.fct_events.current().rows == 0


KEYS = st.sampled_from("abcdefgh")
LOADS = st.lists(
    st.dictionaries(KEYS, st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=6), min_size=2, max_size=3
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads=LOADS)
def test_equals_a_keyed_map(spark, tmp_path_factory, loads):
    mart = Mart(spark, str(tmp_path_factory.mktemp("mart")), MARTS["fct_events"])
    state = {}
    for load in loads:
        state |= {k: (day, float(amount)) for k, (day, amount) in load.items()}
        rows = [(k, day, float(amount)) for k, (day, amount) in load.items()]
        assert upsert(mart, facts(spark, rows)).rows == len(state)
        assert stored(mart) == state


# -- snapshots -------------------------------------------------------------------


def test_history_time_travel_and_rollback(spark, lake):
    mart = lake.fct_events
    one = upsert(mart, facts(spark, [("a", 0)]))
    two = upsert(mart, facts(spark, [("a", 0, 2.0)]))
    assert [s.id for s in mart.history()] == [1, 2, 3]
    assert one.committed_at < two.committed_at
    assert mart.as_of(one.committed_at).id == one.id
    assert mart.as_of(two.committed_at - timedelta(microseconds=1)).id == one.id
    assert mart.as_of(datetime.now(timezone.utc)).id == two.id
    with pytest.raises(LookupError):
        mart.as_of(datetime(2001, 1, 1))

    mart.rollback(one.id)
    assert mart.current_id() == one.id and stored(mart) == {"a": (0, 1.0)}
    three = upsert(mart, facts(spark, [("b", 0)]))
    assert (three.id, three.parent) == (4, one.id)
    assert [s.id for s in mart.history()] == [1, 2, 4]
    with pytest.raises(LookupError):
        mart.snapshot(99)


def test_manifest_is_never_overwritten(spark, lake):
    path = f"{lake.root}/doc.json"
    files.create_text(spark, path, "one")
    with pytest.raises(Exception):
        files.create_text(spark, path, "two")
    files.replace_text(spark, path, "three")
    assert files.read_text(spark, path) == "three"
    assert files.names(spark, lake.root) == ["doc.json"]


def test_window_read_lists_only_its_dates(spark, lake):
    upsert(lake.fct_events, facts(spark, [(f"k{i}", i) for i in range(5)]))
    window = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-03"})
    rows = lake.fct_events.read(window=window)
    assert {r.event_id for r in rows.collect()} == {"k1", "k2"}
    assert len(rows.inputFiles()) == 2


def test_compaction_keeps_content_and_old_snapshots(spark, lake):
    mart = lake.fct_events
    for part in range(3):
        upsert(mart, facts(spark, [(f"k{part}-{i}", i % 2) for i in range(4)] + [(f"only{part}", 9 + part)]))
    before, base = rows_of(mart.read()), mart.current()
    done = compact(mart)
    assert rows_of(mart.read()) == before == rows_of(mart.read(base.id))
    assert done.parent == base.id
    assert len(done.directories) == 5 < len(base.directories) == 9
    assert compact(mart).id == done.id


def test_hot_date_is_written_by_several_tasks(spark, lake, conf):
    """Two thirds of the rows share one date: that date must not be one task's work."""
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1b",
    )
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "sha2(CAST(id AS STRING), 256) AS user_id",
        "'click' AS event_type",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS event_timestamp",
        "date_add(DATE'2024-01-01', CAST(IF(id % 3 < 2, 0, id % 30) AS INT)) AS event_date",
        "'s' AS session_id",
        "'/p' AS page",
        "1.0D AS amount",
        "'n' AS username",
        "'e' AS user_email",
        "'c' AS user_country",
    )
    snapshot = upsert(lake.fct_events, rows, unique=True)
    assert snapshot.rows == 60_000
    hot = [f for f in lake.fct_events.read().inputFiles() if "event_date=2024-01-01" in f]
    assert len(hot) > 4


def test_small_files_of_a_date_are_packed(spark, lake):
    """Forty files in one directory become one; the rows stay."""
    mart = lake.fct_events
    events = models.stage_events(generate.events_frame(spark, 400, 6))
    rows = models.fct_events(events, models.stage_users(generate.users_frame(spark, 6)))
    rows.repartition(40).write.partitionBy("event_date").parquet(f"{mart.data}/batch=many")
    mart.commit(mart._measure("many"), None)
    day = mart.current().directories[0]
    assert files.count_and_size(spark, f"{mart.data}/{day.path}")[0] == 40
    packed = compact(mart)
    assert [files.count_and_size(spark, f"{mart.data}/{d.path}")[0] for d in packed.directories] == [1]
    assert reports.table_diff(rows, mart.read()).isEmpty()
    assert compact(mart).id == packed.id  # nothing left to pack


def test_reading_a_missing_mart_writes_nothing(spark, lake):
    assert lake.dim_users.read().count() == 0 and lake.dim_users.current_id() is None


# -- key hashes and packing ------------------------------------------------------


def scanned_by(mart, monkeypatch):
    """The directories that are scanned from now on."""
    seen, scan = [], mart.scan

    def recorded(directories, **how):
        seen.extend(directories)
        return scan(directories, **how)

    monkeypatch.setattr(mart, "scan", recorded)
    return seen


def test_few_keys_read_only_directories_whose_hashes_hit(spark, lake, monkeypatch):
    mart = lake.fct_events
    base = upsert(mart, facts(spark, [(f"k{i}", i % 20) for i in range(2000)]))
    seen = scanned_by(mart, monkeypatch)
    upsert(mart, facts(spark, [("k3", 3, 2.0), ("k23", 3, 2.0), ("k7", 19, 2.0), *((f"new{i}", i) for i in range(17))]))
    old = {d.batch for d in base.directories}
    assert {d.day for d in seen if d.batch in old} == {"2024-01-04", "2024-01-08"}
    got = stored(mart)
    assert len(got) == 2017 and got["k3"] == (3, 2.0) and got["k7"] == (19, 2.0) and got["k43"] == (3, 1.0)


def test_many_keys_do_not_ask_the_hashes(spark, lake, monkeypatch):
    mart = lake.fct_events
    upsert(mart, facts(spark, [(f"k{i}", i % 3) for i in range(30)]))
    monkeypatch.setattr(mart, "key_hashes", lambda directories: pytest.fail("asked"))
    upsert(mart, facts(spark, [(f"k{i}", i % 3, 2.0) for i in range(20)]))
    assert len(stored(mart)) == 30


def test_a_hash_that_hits_by_chance_replaces_nothing(spark, lake, monkeypatch):
    mart = lake.fct_events
    upsert(mart, facts(spark, [(f"k{i}", 0) for i in range(40)]))
    hashes = mart.key_hashes
    monkeypatch.setattr(mart, "key_hashes", lambda d: hashes(d).selectExpr("1L AS key_hash", "batch", "event_date"))
    upsert(mart, facts(spark, [("other", 1)]))
    assert len(stored(mart)) == 41


def test_directories_without_hashes_are_read(spark, lake):
    """A mart written before there were hashes."""
    mart = lake.fct_events
    first = upsert(mart, facts(spark, [(f"k{i}", i % 2) for i in range(20)]))
    mart.commit([replace(d, hashed=False) for d in first.directories], first)
    assert mart.all_key_hashes(mart.current_id()) is None
    upsert(mart, facts(spark, [("k1", 5, 2.0)]))
    assert len(stored(mart)) == 20 and stored(mart)["k1"] == (5, 2.0)
    assert mart.all_key_hashes(first.id).count() == 20


def test_null_keys_have_null_hashes(spark, lake):
    mart = lake.fct_events
    rows = upsert(mart, facts(spark, [(None, 0), (None, 0), ("a", 1)]), unique=True).directories
    assert mart.key_hashes(rows).where("key_hash IS NULL").count() == 2


def file_sizes(mart):
    found = mart.listed(mart.current().directories).collect()
    return {r["file_path"]: r["length"] for r in found}


def test_small_files_are_packed_beside_a_large_one(spark, lake):
    """One large and forty small files in one directory: the small ones become one, the large one stays."""
    mart = lake.fct_events
    rows = facts(spark, [(f"k{i}", 0) for i in range(40)])
    keys = [sha512(b"%d" % i).hexdigest() for i in range(3000)]
    big = facts(spark, [(k, 0) for k in keys])
    target = f"{mart.data}/batch=mixed"
    big.repartition(1).write.partitionBy("event_date").parquet(target)
    one_each = rows.repartitionById(40, F.substring("event_id", 2, 9).cast("int"))
    one_each.write.mode("append").partitionBy("event_date").parquet(target)
    mart.commit(mart._measure("mixed"), None)
    before = file_sizes(mart)
    assert len(before) == 41
    large = max(before, key=before.get)
    done = compact(mart, file_bytes=before[large])
    after = file_sizes(mart)
    assert len(after) == 2 and after[large] == before[large]
    assert done.rows == 3040 and {d.rows for d in done.directories} == {3000, 40}
    assert reports.table_diff(rows.unionAll(big), mart.read()).isEmpty()
    assert compact(mart, file_bytes=before[large]).id == done.id
    upsert(mart, facts(spark, [("k1", 2, 9.0), (keys[5], 3, 9.0)]))
    assert mart.current().rows == 3040 and stored(mart)["k1"] == (2, 9.0)


def test_bins_are_filled_in_order_of_size(spark, lake):
    mart = lake.fct_events
    rows = facts(spark, [(f"k{i}", i % 2) for i in range(400)])
    rows.repartition(20).write.partitionBy("event_date").parquet(f"{mart.data}/batch=many")
    mart.commit(mart._measure("many"), None)
    sizes = file_sizes(mart)
    limit = 5 * max(sizes.values())
    done = compact(mart, file_bytes=limit)
    assert done.rows == 400 and reports.table_diff(rows, mart.read()).isEmpty()
    days = {d.day for d in done.directories}
    assert len(days) == 2 and 2 * 20 // 6 <= len(file_sizes(mart)) <= 2 * 5


def test_compaction_of_a_window_and_of_users(spark, lake):
    mart = lake.fct_events
    for part in range(2):
        upsert(mart, facts(spark, [(f"k{part}-{i}", i) for i in range(3)]))
    done = compact(mart, DateWindow.parse({"start": "2024-01-02", "end": "2024-01-02"}))
    assert sorted(d.day for d in done.directories) == ["2024-01-01"] * 2 + ["2024-01-02"] + ["2024-01-03"] * 2
    for part in range(3):
        upsert(lake.dim_users, users(spark, [(f"u{part}", "n", "c")]))
    assert len(compact(lake.dim_users).directories) == 1 and lake.dim_users.read().count() == 3
    assert compact(Mart(spark, f"{lake.root}/none", MARTS["dim_users"])).rows == 0
