"""Refresh of the marts: land, gate, merge, gate, attest, publish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from eventmart.operators import checks, models
from eventmart.operators.merge import upsert
from eventmart.operators.windows import DateWindow
from eventmart.plans import publication
from eventmart.plans.lake import Lake
from eventmart.session import SHUFFLE_BYTES, sized_shuffles
from eventmart.sources import raw
from eventmart.storage import files


class GateFailed(RuntimeError):
    """A quality check failed or could not be evaluated; its audit is written."""

    def __init__(self, layer: str, summary: dict[str, int]):
        super().__init__(f"{layer} checks: {summary}")
        self.layer, self.summary = layer, summary


def tables_of(lake: Lake, events: DataFrame, users: DataFrame, snapshots=None) -> checks.Tables:
    """Inputs of a gate; a mart that does not exist yet is absent, not empty."""
    ids = snapshots or lake.snapshot_ids()
    marts = {n: m.read(ids[n]) if ids[n] is not None else None for n, m in lake.marts.items()}
    facts = ids["fct_events"]
    hashes = lake.fct_events.all_key_hashes(facts) if facts is not None else None
    return checks.Tables(events, users, **marts, fct_hashes=hashes)


def gate(lake: Lake, layer: str, tables: checks.Tables, run_id: str, window=None) -> dict[str, int]:
    """Run a layer's checks, write the audit, then raise unless all passed."""
    results = checks.run_checks(tables, layer, DateWindow.parse(window))
    lake.audit.append(results, f"{run_id}:{layer}")
    summary = checks.summarize(results)
    if summary["passed"] != summary["total"] or not summary["total"]:
        raise GateFailed(layer, summary)
    return summary


def refresh(
    lake: Lake,
    raw_events: DataFrame,
    raw_users: DataFrame,
    run_id: str,
    window=None,
    before_facts: Callable[[], None] | None = None,
    partition_bytes: int = SHUFFLE_BYTES,
) -> dict:
    """One full run, or a run that replays a date window of events.

    A failure leaves earlier commits in place but the publication unchanged, so
    readers of the publication never see a half-done run; the rerun reconciles.
    A run id that has been published is refused before anything is written.
    ``before_facts`` runs between the two mart commits (failure drills). Shuffles are dealt
    into partitions of about ``partition_bytes``; a larger value makes fewer of them.
    """
    window = DateWindow.parse(window)
    publication.require_unpublished(lake, run_id)
    staged = f"{lake.root}/staging/run={publication.revision_of(run_id)}"
    events = raw.land(raw_events, "events", f"{staged}/events")
    users = raw.land(raw_users, "users", f"{staged}/users")

    with sized_shuffles(lake.spark, _shuffled_bytes(lake, staged), partition_bytes):
        gate(lake, "staging", tables_of(lake, events, users), run_id, window)
        upsert(lake.dim_users, _users_to_write(lake, users, window), unique=True)
        if before_facts:
            before_facts()
        facts = models.fct_events(events, users, window)
        upsert(lake.fct_events, facts, unique=True, stable_in=window)
        checked = lake.snapshot_ids()
        summary = gate(lake, "marts", tables_of(lake, events, users, checked), run_id, window)
    publication.attest(lake, run_id, summary, checked)
    document = publication.publish(lake, run_id, window)
    files.remove(lake.spark, staged)  # a failed run's copy stays, to look into its rows
    return document


def _users_to_write(lake: Lake, users: DataFrame, window: DateWindow | None) -> DataFrame:
    """The staged users; in a window run, whose gate lets no known user change, the new ones alone."""
    staged = models.dim_users(users)
    if window is None:
        return staged
    return staged.join(lake.dim_users.read().select("user_id"), "user_id", "left_anti")


def _shuffled_bytes(lake: Lake, staged: str) -> int:
    """Upper estimate of a run's largest shuffle.

    Either whole enriched rows of the landed copy (uncompressed, so several times
    its Parquet size) or the key of every fact row.
    """
    facts = lake.fct_events.current()
    return max(4 * files.size(lake.spark, staged), 64 * (facts.rows if facts else 0))


def refresh_from_files(
    lake: Lake,
    events_path: str,
    users_path: str,
    run_id: str,
    window=None,
    partitioned_source: bool = False,
) -> dict:
    """Refresh from NDJSON folders; with a window a partitioned source is pruned."""
    if not isinstance(partitioned_source, bool):
        raise ValueError("partitioned_source is neither True nor False")
    window, spark = DateWindow.parse(window), lake.spark
    if window and partitioned_source:
        events = raw.scan_events_window(spark, events_path, window)
    else:
        events = raw.scan_events(spark, events_path)
    return refresh(lake, events, raw.scan_users(spark, users_path), run_id, window)
