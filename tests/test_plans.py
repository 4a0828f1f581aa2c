"""Physical plans: what is pruned, joined, shuffled and split."""

import re
from pathlib import Path

from conftest import ROOT, plan_of
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from eventmart.operators import checks, models, reports
from eventmart.operators.merge import upsert
from eventmart.operators.windows import DateWindow
from eventmart.plans.refresh import refresh_from_files
from eventmart.session import SHUFFLE_BYTES, sized_shuffles
from eventmart.sources import generate, manifest, raw

WINDOW = DateWindow.parse({"start": "2024-01-02", "end": "2024-01-02"})


def _staged(spark, events=1000, users=10):
    return (
        models.stage_events(generate.events_frame(spark, events, users)),
        models.stage_users(generate.users_frame(spark, users)),
    )


def test_orphans_are_counted_before_an_anti_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(reports.orphans(*_staged(spark)))
    join = plan.index("LeftAnti")
    assert plan.index("partial_count", join) > join  # below the join, i.e. before it


def test_window_of_a_mart_prunes_partitions(spark, lake):
    events, users = _staged(spark, 200_000)
    upsert(lake.fct_events, models.fct_events(events, users), unique=True)
    plan = plan_of(reports.daily_by_type(lake.fct_events.read(), WINDOW))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "event_date" in filters
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", read)) == {"event_type", "amount"}


def test_key_moves_do_not_read_the_window_of_the_fact(spark, lake):
    events, users = _staged(spark, 200_000)
    upsert(lake.fct_events, models.fct_events(events, users), unique=True)
    staged = models.typed_events(models.in_window(events, WINDOW))
    plan = plan_of(reports.key_date_moves(staged, lake.fct_events.read(), WINDOW))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*\]", plan)
    assert "ReadSchema: struct<event_id:string>" in plan


def test_row_checks_of_a_table_share_one_scan(spark):
    tables = checks.Tables(*_staged(spark))
    plan = checks.check_results(tables, "staging")._jdf.queryExecution().optimizedPlan().toString()
    # Two shared scans, one uniqueness scan per table, both sides of the relationship check.
    assert plan.count("Range (") == 2 + 2 + 2


def test_hot_user_is_split_in_the_enrichment_join(spark, conf):
    """A third of the events on one user: AQE splits that partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__shuffle__partitions="8",
    )
    events, users = _staged(spark, 200_000, 2_000)
    hot = events.selectExpr(
        "event_id",
        "IF(substr(event_id, 15, 1) IN ('0', '1', '2', '3'), 'u0000000001', user_id) AS user_id",
        *events.columns[2:],
    ).repartition(8)
    facts = models.fct_events(hot, users)
    assert facts.where("username IS NOT NULL").count() == 200_000
    facts.collect()
    assert "skew=true" in plan_of(facts)


def test_small_users_are_broadcast_and_large_are_not(spark, conf):
    events, users = _staged(spark)
    assert "BroadcastHashJoin" in plan_of(models.fct_events(events, users))
    conf(spark__sql__autoBroadcastJoinThreshold="1")
    assert "SortMergeJoin" in plan_of(models.fct_events(events, users))


def test_facts_are_always_rebalanced_by_date(spark, lake, tmp_path, conf, monkeypatch):
    """How facts are written does not depend on the size of the users."""
    root = str(tmp_path / "set")
    generate.generate(spark, root, 200_000, 10, 50_000, partition_by_date=True)
    paths = (f"{root}/raw/events", f"{root}/raw/users")
    hints, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, *args: hints.append(args) or hint(df, *args))

    assert refresh_from_files(lake, *paths, "small users")["quality"]["passed"] == 18
    first, expected = lake.fct_events.read(), [("rebalance",), ("rebalance", "event_date")]
    assert hints == expected
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    refresh_from_files(lake, *paths, "large users")
    assert hints == 2 * expected
    assert reports.table_diff(first, lake.fct_events.read()).isEmpty()


def test_verified_load_moves_no_raw_rows(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    generate.generate(spark, str(tmp_path / "set"), 40, 6, 10, partition_by_date=True)
    for rows in manifest.load_verified(spark, str(tmp_path / "set")).values():
        assert "Exchange" not in plan_of(rows) and "Join" not in plan_of(rows)


def test_window_replay_lists_only_its_folders(spark, tmp_path):
    generate.generate(spark, str(tmp_path / "set"), 200_000, 10, 50_000, partition_by_date=True)
    found = raw.scan_events_window(spark, str(tmp_path / "set/raw/events"), WINDOW)
    plan = plan_of(found)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "event_date" in filters and "cast" not in filters.lower()
    files_read = found.select("_metadata.file_path").distinct().collect()
    assert files_read and all("event_date=2024-01-02" in r[0] for r in files_read)


def test_marts_gate_reads_the_fact_three_times(spark, lake):
    """Row checks, unique keys, and one pass for both user checks."""
    events, users = _staged(spark)
    upsert(lake.dim_users, models.dim_users(users), unique=True)
    upsert(lake.fct_events, models.fct_events(events, users), unique=True)
    tables = checks.Tables(events, users, lake.dim_users.read(), lake.fct_events.read())
    results = checks.check_results(tables, "marts")
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\]]*event_id#", plan)) == 3
    assert {r.status for r in results.collect()} == {"pass"}


def test_shuffles_grow_with_the_data_and_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 100 << 30):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str((100 << 30) // SHUFFLE_BYTES)
    with sized_shuffles(spark, 100 << 40, 4 << 30):  # no ceiling: the size of a partition is the caller's
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(100 << 8)
    with sized_shuffles(spark, 1):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_country_report_reduces_facts_before_a_shuffled_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    events, users = _staged(spark)
    plan = plan_of(reports.daily_by_country(models.typed_events(events), models.dim_users(users)))
    join = plan.index("SortMergeJoin")
    assert "partial_sum" in plan[join:]


def test_no_python_or_rdd_in_the_library():
    for file in Path(ROOT, "eventmart").rglob("*.py"):
        if "llm" in file.parts:  # operators of other styles, shipped apart
            continue
        text = file.read_text()
        for word in ("udf", "applyInPandas", "mapInPandas", ".rdd", "localCheckpoint", "crossJoin", "toPandas"):
            assert word not in text, (file, word)


def test_equal_tables_exchange_fingerprints_only(spark, tmp_path):
    rows = models.stage_events(generate.events_frame(spark, 20_000, 50))
    rows.write.parquet(str(tmp_path / "left"))
    rows.repartition(7).write.parquet(str(tmp_path / "right"))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
    assert reports.differing_parts(left, right)[1] == []
    assert "Scan" not in reports.changed_rows(left, right)._jdf.queryExecution().optimizedPlan().toString()
    changed = right.withColumn("amount", F.when(F.col("event_id") == "e00000000000007", 1.5).otherwise(F.col("amount")))
    found = reports.changed_rows(left, changed)
    assert len(reports.differing_parts(left, changed)[1]) in (1, 2)
    assert {(r["event_id"], r["copies"]) for r in found.collect()} == {("e00000000000007", 1), ("e00000000000007", -1)}


def test_fingerprints_see_copies_and_the_places_of_nulls(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "a string, b string")
    same = frame(("x", None), ("x", None), ("y", "z"))
    assert reports.differing_parts(same, frame(("y", "z"), ("x", None), ("x", None)))[1] == []
    for other in (frame(("x", None), ("y", "z")), frame((None, "x"), ("x", None), ("y", "z")), frame()):
        assert reports.differing_parts(same, other)[1] and reports.changed_rows(same, other).count() > 0
    assert reports.changed_rows(frame(), frame()).count() == 0
