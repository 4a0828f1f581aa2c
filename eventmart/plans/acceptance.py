"""Acceptance jobs: replay, failure drill and parity of the two model definitions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators import models, reports
from eventmart.plans import publication
from eventmart.plans.lake import Lake
from eventmart.plans.refresh import GateFailed, refresh
from eventmart.schemas import RAW_EVENTS
from eventmart.sources import manifest

DRILL_CHECKS = ["relationships_stg_raw_events", "nonnegative_amount_stg_raw_events"]


def compare(name: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of ``left`` and how many row values differ in their copies.

    Fingerprints decide which parts of the tables are compared row by row.
    """
    sides = left.select(F.lit(1).alias("n"), F.lit(0).alias("d"))
    differing = reports.changed_rows(left, right).select(F.lit(0).alias("n"), F.lit(1).alias("d"))
    return sides.unionAll(differing).agg(
        F.lit(name).alias("name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("differences"),
    )


def model_parity(raw_events: DataFrame, raw_users: DataFrame) -> DataFrame:
    """DataFrame and SQL definitions of each model, compared by result."""
    frames = models.frame_models(raw_events, raw_users)
    texts = models.sql_models(raw_events, raw_users)
    found = None
    for name, frame in frames.items():
        row = compare(name, frame, texts[name])
        found = row if found is None else found.unionByName(row)
    return found


def new_run(name: str) -> str:
    """A run id that no lake has seen."""
    return f"{name}-{uuid.uuid4().hex}"


def replay(lake: Lake, dataset: str, runs: tuple[str, ...] = ("replay-1", "replay-2")) -> dict:
    """Run a verified data set as often as ``runs`` names runs; counts must equal its manifest."""
    head = manifest.totals(lake.spark, dataset)
    expected = {kind: head[kind] for kind in manifest.KINDS}
    data = manifest.load_verified(lake.spark, dataset)
    for name in runs:
        document = refresh(lake, data["events"], data["users"], new_run(name))
        publication.verify_counts(lake, expected, document["revision"])
    return expected


def invalid_event(raw_events: DataFrame) -> DataFrame:
    """One row like the source's, with an unknown user and a negative amount."""
    seed = raw_events.agg(F.min(F.struct(*RAW_EVENTS.names)).alias("e")).select("e.*")
    return seed.select(
        F.lit("acceptance-invalid").alias("event_id"),
        F.lit("missing-acceptance-user").alias("user_id"),
        "event_type",
        "page",
        "timestamp",
        "session_id",
        F.lit(-1.0).alias("amount"),
    )


def failure_drill(lake: Lake, raw_events: DataFrame, raw_users: DataFrame, run_id: str) -> dict:
    """A bad source must be stopped by the staging gate and change no publication."""
    before = publication.resolve(lake)
    snapshots = lake.snapshot_ids()
    bad = raw_events.select(*RAW_EVENTS.names).unionByName(invalid_event(raw_events))
    try:
        refresh(lake, bad, raw_users, run_id)
    except GateFailed as failed:
        layer = failed.layer
    else:
        raise RuntimeError("the drill's invalid source was published")
    audit = reports.failed_checks(lake.audit.read(), f"{run_id}:staging", DRILL_CHECKS)
    return {
        "layer": layer,
        "failed_checks": audit.first()["failed_checks"],
        "publication_unchanged": publication.resolve(lake) == before,
        "marts_unchanged": lake.snapshot_ids() == snapshots,
    }
