"""Every operator as a query over the driver's tables: ``(spark, sf_dir) -> DataFrame``.

Queries that write use a new folder below the cluster's shared folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators import checks, merge, models, reports
from eventmart.operators.windows import DateWindow
from eventmart.plans import acceptance, publication
from eventmart.plans import driver_tables as d
from eventmart.plans.lake import Lake
from eventmart.plans.refresh import GateFailed, refresh, refresh_from_files
from eventmart.schemas import RAW_EVENTS, SchemaDrift
from eventmart.session import small_frame, workspace
from eventmart.sources import manifest, raw
from eventmart.storage import files

WINDOW = DateWindow.parse({"start": "2024-01-10", "end": "2024-01-19"})
NEXT_WINDOW = DateWindow.parse({"start": "2024-01-20", "end": "2024-01-25"})
FIRST_LOAD = DateWindow.parse({"start": "2024-01-01", "end": "2024-01-20"})
AS_OF = "2024-02-01 06:00:00"


def _lake(spark: SparkSession, name: str) -> Lake:
    return Lake(spark, workspace(spark, name))


def _staged(spark, sf, kind: str = "clean") -> tuple[DataFrame, DataFrame]:
    events = getattr(d, f"{kind}_events")(spark, sf)
    users = getattr(d, f"{kind}_users", d.clean_users)(spark, sf)
    return models.stage_events(events), models.stage_users(users)


def _facts(spark, sf, kind: str = "clean", window: DateWindow | None = None) -> DataFrame:
    return models.fct_events(*_staged(spark, sf, kind), window)


def _dims(spark, sf, kind: str = "clean") -> DataFrame:
    return models.dim_users(_staged(spark, sf, kind)[1])


def _dataset(spark, sf, kind: str = "clean", by_date: bool = False) -> str:
    """The driver's events and customers as a raw data set with its manifest."""
    root = workspace(spark, "dataset")
    events, users = getattr(d, f"{kind}_events")(spark, sf), d.clean_users(spark, sf)
    raw.replace_users(users, f"{root}/raw/users")
    if by_date:
        dated = events.withColumn("event_date", F.left("timestamp", F.lit(10)))
        dated.hint("rebalance", "event_date").write.partitionBy("event_date").json(f"{root}/raw/events")
    else:
        raw.append_events(events, f"{root}/raw/events")
    counts = d.table(spark, sf, "events").count(), d.table(spark, sf, "customer").count()
    manifest.write(spark, root, *counts, 1, ["event_date"] if by_date else [])
    return root


def _refresh(lake: Lake, sf: str, run_id: str, kind: str = "clean", **options) -> dict:
    events = getattr(d, f"{kind}_events")(lake.spark, sf)
    users = getattr(d, f"{kind}_users")(lake.spark, sf)
    return refresh(lake, events, users, run_id, **options)


# -- sources ---------------------------------------------------------------------


def stg_raw_events(spark, sf):
    models.register_view(_staged(spark, sf)[0], "stg_raw_events")
    return spark.table("stg_raw_events")


def stg_raw_users(spark, sf):
    models.register_view(_staged(spark, sf)[1], "stg_raw_users")
    return spark.table("stg_raw_users")


def raw_events_scan(spark, sf):
    path = workspace(spark, "raw-events")
    raw.append_events(d.clean_events(spark, sf), path)
    return models.stage_events(raw.scan_events(spark, path))


def raw_users_scan(spark, sf):
    path = workspace(spark, "raw-users")
    raw.replace_users(d.changed_users(spark, sf), path)
    raw.replace_users(d.clean_users(spark, sf), path)
    return models.stage_users(raw.scan_users(spark, path))


def events_pruned_scan(spark, sf):
    path = workspace(spark, "raw-by-date")
    events = d.clean_events(spark, sf).withColumn("event_date", F.left("timestamp", F.lit(10)))
    events.hint("rebalance", "event_date").write.partitionBy("event_date").json(path)
    return models.stage_events(raw.scan_events_window(spark, path, WINDOW), "event_date")


def raw_load_defects(spark, sf):
    """What would be refused when loading events with odd amounts and broken lines."""
    path = workspace(spark, "odd-events")
    d.unloadable_lines(spark, sf).write.text(path)
    users = workspace(spark, "users")
    raw.replace_users(d.clean_users(spark, sf), users)
    events = raw.load_defects(raw.scan_events(spark, path), "events")
    return events.unionByName(raw.load_defects(raw.scan_users(spark, users), "users"))


def manifest_audit(spark, sf):
    return manifest.audit_totals(spark, _dataset(spark, sf, by_date=True))


def manifest_findings(spark, sf):
    """One day's rows are listed wrongly, one day's digests, and one day's files under other names."""
    root = _dataset(spark, sf, by_date=True)
    day = F.regexp_extract("path", "event_date=([0-9-]+)", 1)
    altered = manifest.listed(spark, root).select(
        F.when(day == "2024-01-12", F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("path"),
        F.when(day == "2024-01-10", F.col("rows") * 2).otherwise(F.col("rows")).alias("rows"),
        F.when(day == "2024-01-11", F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"),
    )
    altered.write.json(f"{root}/altered")
    head = manifest.totals(spark, root) | {"files_in": "altered"}
    files.replace_text(spark, f"{root}/manifest.json", json.dumps(head))
    per_day = manifest.audit(spark, root).groupBy("kind", F.nullif(day, F.lit("")).alias("day"), "status")
    return per_day.agg(F.sum("listed_rows").alias("listed_rows"), F.sum("found_rows").alias("found_rows"))


def schema_contract(spark, sf):
    root = workspace(spark, "contract")
    raw.append_events(d.clean_events(spark, sf), f"{root}/events")
    raw.replace_users(d.clean_users(spark, sf), f"{root}/users")
    return raw.schema_contract(spark, {k: f"{root}/{k}" for k in ("events", "users")})


def schema_drift(spark, sf):
    """Amounts as text, no page, and a field that nobody declared."""
    root = workspace(spark, "drift")
    events = d.clean_events(spark, sf)
    amount = F.concat(F.col("amount").cast("string"), F.lit(" EUR"))
    events.withColumns({"amount": amount, "channel": F.col("event_type")}).drop("page").write.json(f"{root}/events")
    d.clean_users(spark, sf).withColumn("created_at", F.lit(20240101)).write.json(f"{root}/users")
    return raw.schema_contract(spark, {k: f"{root}/{k}" for k in ("events", "users")})


def schema_drift_by_file(spark, sf):
    """One file per day; those of a window have amounts as text, no page and a field that nobody declared."""
    root = workspace(spark, "drift-by-file")
    events = d.clean_events(spark, sf).withColumn("day", F.left("timestamp", F.lit(10)))
    inside = WINDOW.covers_text("day")
    amount = F.concat(F.col("amount").cast("string"), F.lit(" EUR"))
    changed = events.where(inside).withColumns({"amount": amount, "channel": F.col("event_type")}).drop("page")
    for name, rows in (("plain", events.where(~inside)), ("changed", changed)):
        rows.repartition("day").write.partitionBy("day").json(f"{root}/events/{name}")
    d.clean_users(spark, sf).coalesce(1).withColumn("created_at", F.lit(20240101)).write.json(f"{root}/users")
    found = raw.drift_by_file(spark, {k: f"{root}/{k}" for k in ("events", "users")})
    return found.groupBy("source", "field", "declared", "found", "status").agg(F.count_distinct("file_path").alias("files"))


def refused_writes(spark, sf):
    """Facts of another type, without a column and with one more: no write happens, the mart stays."""
    lake = _lake(spark, "refused")
    facts = _facts(spark, sf)
    merge.upsert(lake.fct_events, facts)
    amount = F.col("amount").cast("decimal(18, 2)")
    wrong = {
        "type changed": facts.withColumn("amount", amount),
        "column gone": facts.drop("page"),
        "column added": facts.withColumn("channel", F.col("event_type")),
    }
    found = None
    for change, rows in wrong.items():
        try:
            merge.upsert(lake.fct_events, rows)
            refused = False
        except SchemaDrift:
            refused = True
        kept = lake.fct_events.read().agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("keys"))
        kept = kept.select(F.lit(change).alias("change"), F.lit(refused).alias("refused"), "rows", "keys")
        found = kept if found is None else found.unionByName(kept)
    return found


def batch_append(spark, sf):
    """Events before, in and after a window as three batches, appended without touching users."""
    root = workspace(spark, "batches")
    events = d.clean_events(spark, sf)
    raw.replace_users(d.clean_users(spark, sf), f"{root}/users")
    day = F.left("timestamp", F.lit(10))
    first, last = WINDOW.start.isoformat(), WINDOW.end.isoformat()
    for batch in (day < first, day.between(first, last), day > last):
        raw.append_events(events.where(batch), f"{root}/events")
    return raw.scan_events(spark, f"{root}/events").select(*RAW_EVENTS.names[:4], "amount")


# -- models and marts ------------------------------------------------------------


def dim_users(spark, sf):
    return _dims(spark, sf)


def fct_events(spark, sf):
    return _facts(spark, sf)


def fct_events_window(spark, sf):
    return _facts(spark, sf, window=WINDOW)


def fact_window_scan(spark, sf):
    lake = _lake(spark, "fact-window")
    merge.upsert(lake.fct_events, _facts(spark, sf))
    return lake.fct_events.read(window=WINDOW)


def bootstrap_empty(spark, sf):
    """A mart starts as an empty snapshot; bootstrapping again changes nothing."""
    lake = _lake(spark, "bootstrap")
    lake.fct_events.ensure()
    merge.upsert(lake.fct_events, _facts(spark, sf))
    lake.fct_events.ensure()
    return lake.snapshot_log().select("snapshot_id", "parent_id", "rows")


def compacted_fact(spark, sf):
    lake = _lake(spark, "compaction")
    for window in (FIRST_LOAD, None):
        merge.upsert(lake.fct_events, _facts(spark, sf, "changed", window))
    merge.upsert(lake.fct_events, _facts(spark, sf, "clean", WINDOW))
    return lake.fct_events.read(merge.compact(lake.fct_events).id)


def time_travel_read(spark, sf):
    lake = _lake(spark, "time-travel")
    first = merge.upsert(lake.fct_events, _facts(spark, sf, window=FIRST_LOAD))
    second = merge.upsert(lake.fct_events, _facts(spark, sf, "changed"))
    between = first.committed_at + (second.committed_at - first.committed_at) / 2
    return lake.fct_events.read(lake.fct_events.as_of(between).id)


# -- merges ----------------------------------------------------------------------


def merge_dim_users(spark, sf):
    lake = _lake(spark, "merge-users")
    merge.upsert(lake.dim_users, _dims(spark, sf))
    merge.upsert(lake.dim_users, _dims(spark, sf, "changed"))
    return lake.dim_users.read()


def merge_fct_full(spark, sf):
    lake = _lake(spark, "merge-full")
    merge.upsert(lake.fct_events, _facts(spark, sf, window=FIRST_LOAD))
    merge.upsert(lake.fct_events, _facts(spark, sf, "changed"))
    return lake.fct_events.read()


def merge_fct_window(spark, sf):
    lake = _lake(spark, "merge-window")
    merge.upsert(lake.fct_events, _facts(spark, sf))
    merge.upsert(lake.fct_events, _facts(spark, sf, "changed", WINDOW))
    return lake.fct_events.read()


def replay_diff(spark, sf):
    """Both marts before and after merging the same source again."""
    lake = _lake(spark, "replay")
    sources = {"dim_users": _dims(spark, sf), "fct_events": _facts(spark, sf)}
    found = None
    for name, mart in lake.marts.items():
        first = merge.upsert(mart, sources[name])
        second = merge.upsert(mart, sources[name])
        row = acceptance.compare(name, mart.read(first.id), mart.read(second.id))
        found = row if found is None else found.unionByName(row)
    return found


def late_arrival_replay(spark, sf):
    """Purchases arrive late: they appear only on dates that are replayed."""
    lake = _lake(spark, "late")
    events, users = _staged(spark, sf)
    early = events.where("event_type <> 'purchase'")
    merge.upsert(lake.fct_events, models.fct_events(early, users))
    for window in (WINDOW, NEXT_WINDOW):
        merge.upsert(lake.fct_events, models.fct_events(events, users, window))
    return reports.daily_by_type(lake.fct_events.read())


def gated_refresh(spark, sf):
    """A source that fails its checks leaves both marts as they were."""
    lake = _lake(spark, "gated")
    _refresh(lake, sf, "good")
    before = lake.snapshot_log()
    try:
        _refresh(lake, sf, "bad", "dirty")
        blocked = False
    except GateFailed:
        blocked = True
    after = lake.snapshot_log().select("mart", F.col("rows").alias("rows_after"), "snapshot_id")
    return before.join(after, ["mart", "snapshot_id"], "left").select(
        "mart", F.col("rows").alias("rows_before"), "rows_after", F.lit(blocked).alias("blocked")
    ).where("rows_before > 0")


def partial_failure_drill(spark, sf):
    """A run that dies between the two mart commits: readers keep the published pair."""
    lake = _lake(spark, "partial")
    _refresh(lake, sf, "good")

    def fail() -> None:
        raise RuntimeError("injected failure after the dimension commit")

    events = d.clean_events(spark, sf)
    users = d.clean_users(spark, sf).withColumn("country", F.lit("moved"))
    try:
        refresh(lake, events, users, "broken", before_facts=fail)
    except RuntimeError as reason:
        if "injected" not in str(reason):
            raise
    return publication.published_daily_by_country(lake)


# -- reports ---------------------------------------------------------------------


def summary_by_type(spark, sf):
    return reports.summary_by_type(models.typed_events(_staged(spark, sf)[0]))


def summary_by_type_extremes(spark, sf):
    """Exact totals of amounts from 4e-7 to 1e300, to nine decimal places."""
    return reports.summary_by_type(models.typed_events(_staged(spark, sf, "extreme")[0]), 9)


def daily_by_type(spark, sf):
    staged = models.in_window(_staged(spark, sf)[0], WINDOW)
    return reports.daily_by_type(models.typed_events(staged))


def daily_by_country(spark, sf):
    """The report on unpublished models."""
    events, users = _staged(spark, sf)
    return reports.daily_by_country(models.typed_events(events), models.dim_users(users))


def daily_by_country_mills(spark, sf):
    events, users = _staged(spark, sf, "mills")
    return reports.daily_by_country(models.typed_events(events), models.dim_users(users))


def published_daily_by_country(spark, sf):
    lake = _lake(spark, "published")
    _refresh(lake, sf, "run-1")
    return publication.published_daily_by_country(lake)


def published_daily_by_country_mills(spark, sf):
    lake = _lake(spark, "published-mills")
    refresh(lake, d.mills_events(spark, sf), d.clean_users(spark, sf), "run-1")
    return publication.published_daily_by_country(lake)


def orphan_users(spark, sf):
    return reports.orphans(_staged(spark, sf, "dirty")[0], _staged(spark, sf)[1])


def negative_amounts(spark, sf):
    return reports.negative_amounts(_staged(spark, sf, "dirty")[0])


def duplicate_keys(spark, sf):
    events, users = _staged(spark, sf, "dirty")
    found = reports.duplicate_keys(events, "event_id").withColumn("key", F.lit("event_id"))
    for key in ("user_id", "email"):
        part = reports.duplicate_keys(users, key).withColumn("key", F.lit(key))
        found = found.unionByName(part)
    return found.select("key", "key_value", "rows")


def enrichment_mismatches(spark, sf):
    return reports.enrichment_mismatches(_facts(spark, sf), _dims(spark, sf, "changed"), "event_id")


def key_date_moves(spark, sf):
    staged = models.typed_events(models.in_window(_staged(spark, sf, "changed")[0], WINDOW))
    return reports.key_date_moves(staged, _facts(spark, sf), WINDOW)


def profile_changes(spark, sf):
    return reports.profile_changes(_dims(spark, sf), _dims(spark, sf, "changed"))


def nonempty_sources(spark, sf):
    events, users = _staged(spark, sf)
    never = DateWindow.parse({"start": "1999-01-01", "end": "1999-01-31"})
    empty = models.in_window(events, never)
    return reports.nonempty({"events": events, "users": users, "pruned_events": empty})


def source_freshness(spark, sf):
    events, users = _staged(spark, sf)
    times = {
        "events": (events, models.parsed_time(events, "event_timestamp")),
        "users": (users, models.parsed_time(users, "created_at")),
    }
    return reports.source_freshness(times, AS_OF)


def run_scan_metrics(spark, sf):
    found = reports.run_scan_metrics(d.log_lines(spark, sf), d.log_runs(spark, sf))
    rounded = {"scan_usd": F.round("scan_usd", 12), "events_per_second": F.round("events_per_second", 3)}
    return found.withColumns(rounded)


def run_queries(spark, sf):
    return reports.run_queries(d.log_lines(spark, sf))


# -- quality gates ---------------------------------------------------------------

_SHOWN = ("test_name", "model", "column_name", "kind", "failures", "status")


def _mart_tables(spark, sf) -> checks.Tables:
    """Marts with defects: dirty events without errors, attributes of other users."""
    events, _ = _staged(spark, sf, "dirty")
    users = _staged(spark, sf)[1]
    facts = models.fct_events(events.where("event_type <> 'error' OR event_type IS NULL"), users)
    return checks.Tables(*_staged(spark, sf), _dims(spark, sf, "dirty"), facts)


def _changed_tables(spark, sf) -> checks.Tables:
    staged = _staged(spark, sf, "changed")
    return checks.Tables(*staged, _dims(spark, sf), _facts(spark, sf))


def quality_staging(spark, sf):
    tables = checks.Tables(*_staged(spark, sf, "dirty"))
    return checks.check_results(tables, "staging").select(*_SHOWN)


def quality_staging_empty(spark, sf):
    """Sources without a row."""
    events, users = _staged(spark, sf)
    tables = checks.Tables(events.where("event_type = 'never'"), users.where("length(user_id) = 0"))
    return checks.check_results(tables, "staging").select(*_SHOWN)


def quality_marts(spark, sf):
    return checks.check_results(_mart_tables(spark, sf), "marts").select(*_SHOWN)


def quality_staging_window(spark, sf):
    return checks.check_results(_changed_tables(spark, sf), "staging", WINDOW).select(*_SHOWN)


def quality_marts_window(spark, sf):
    return checks.check_results(_changed_tables(spark, sf), "marts", WINDOW).select(*_SHOWN)


def count_reconciliation(spark, sf):
    tables = _mart_tables(spark, sf)
    kind = F.col("kind") == "reconciliation"
    return checks.check_results(tables, "marts").where(kind).select("test_name", "failures", "status")


def gate_summary(spark, sf):
    return checks.gate_summary(quality_staging(spark, sf))


def _audited(spark, sf) -> Lake:
    """Audit history of one good run and one run stopped by its staging gate."""
    lake = _lake(spark, "audit")
    _refresh(lake, sf, "good")
    try:
        _refresh(lake, sf, "bad", "dirty")
    except GateFailed:
        pass
    return lake


def audit_status_counts(spark, sf):
    return reports.audit_status_counts(_audited(spark, sf).audit.read())


def audit_failed_checks(spark, sf):
    audit = _audited(spark, sf).audit.read()
    return reports.failed_checks(audit, "bad:staging", acceptance.DRILL_CHECKS)


# -- publication and acceptance --------------------------------------------------


def snapshot_log(spark, sf):
    lake = _lake(spark, "snapshots")
    _refresh(lake, sf, "full")
    _refresh(lake, sf, "replay", window=WINDOW)
    return lake.snapshot_log().drop("committed_at")


def publish_cycle(spark, sf):
    """The publications of a full run and of a window run, with their pinned rows."""
    lake = _lake(spark, "publish")
    documents = [_refresh(lake, sf, "full"), _refresh(lake, sf, "replay", window=WINDOW)]
    rows = []
    for doc in documents:
        again = publication.publish(lake, doc["execution_id"], doc["window"]) if doc is documents[-1] else doc
        if again != doc or publication.resolve(lake, doc["revision"]) != doc:
            raise RuntimeError("a publication was not repeatable")
        pinned = {name: mart.snapshot(doc["snapshots"][name]).rows for name, mart in lake.marts.items()}
        start = (doc["window"] or {}).get("start")
        quality = doc["quality"]
        rows.append(
            (doc["execution_id"], doc["revision"], start, quality["total"], quality["passed"])
            + (pinned["dim_users"], pinned["fct_events"])
        )
    return small_frame(
        spark,
        rows,
        "execution_id string, revision string, window_start string, checks long, passed long, "
        "users long, events long",
    )


def published_count_check(spark, sf):
    """Two full runs over a verified data set; pinned counts equal its manifest."""
    lake, root = _lake(spark, "acceptance"), _dataset(spark, sf)
    return publication.published_counts(lake, acceptance.replay(lake, root))


def partitioned_refresh(spark, sf):
    """A full run, then a window replay of other amounts that reads only the window's raw folders."""
    lake = _lake(spark, "partitioned")
    before, after = _dataset(spark, sf, by_date=True), _dataset(spark, sf, "doubled", by_date=True)
    refresh_from_files(lake, f"{before}/raw/events", f"{before}/raw/users", "full")
    paths = (f"{after}/raw/events", f"{after}/raw/users")
    refresh_from_files(lake, *paths, "replay", window=WINDOW, partitioned_source=True)
    return publication.published_daily_by_country(lake)


def failure_drill_audit(spark, sf):
    lake = _lake(spark, "drill")
    events, users = d.clean_events(spark, sf), d.clean_users(spark, sf)
    refresh(lake, events, users, "baseline")
    drill = acceptance.failure_drill(lake, events, users, "drill")
    refresh(lake, events, users, "recovery")
    recovered = publication.read_published(lake)["fct_events"]
    return recovered.agg(F.count(F.lit(1)).alias("recovered_events")).select(
        F.lit(drill["layer"]).alias("layer"),
        F.lit(drill["failed_checks"]).cast("long").alias("failed_checks"),
        F.lit(drill["publication_unchanged"]).alias("publication_unchanged"),
        F.lit(drill["marts_unchanged"]).alias("marts_unchanged"),
        "recovered_events",
    )


def model_parity(spark, sf):
    return acceptance.model_parity(d.clean_events(spark, sf), d.clean_users(spark, sf))


QUERIES = {
    q.__name__: q
    for q in (
        stg_raw_events,
        stg_raw_users,
        raw_events_scan,
        raw_users_scan,
        events_pruned_scan,
        raw_load_defects,
        manifest_audit,
        manifest_findings,
        schema_contract,
        schema_drift,
        schema_drift_by_file,
        refused_writes,
        batch_append,
        dim_users,
        fct_events,
        fct_events_window,
        fact_window_scan,
        bootstrap_empty,
        compacted_fact,
        time_travel_read,
        merge_dim_users,
        merge_fct_full,
        merge_fct_window,
        replay_diff,
        late_arrival_replay,
        gated_refresh,
        partial_failure_drill,
        summary_by_type,
        summary_by_type_extremes,
        daily_by_type,
        daily_by_country,
        daily_by_country_mills,
        published_daily_by_country,
        published_daily_by_country_mills,
        orphan_users,
        negative_amounts,
        duplicate_keys,
        enrichment_mismatches,
        key_date_moves,
        profile_changes,
        nonempty_sources,
        source_freshness,
        run_scan_metrics,
        run_queries,
        quality_staging,
        quality_staging_empty,
        quality_marts,
        quality_staging_window,
        quality_marts_window,
        count_reconciliation,
        gate_summary,
        audit_status_counts,
        audit_failed_checks,
        snapshot_log,
        publish_cycle,
        published_count_check,
        partitioned_refresh,
        failure_drill_audit,
        model_parity,
    )
}
