import json

import pytest

from eventmart.__main__ import main
from eventmart.sources import generate


def _run(capsys, *argv):
    assert main([str(a) for a in argv]) == 0
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_sample_from_generation_to_report(spark, tmp_path, capsys):
    data, lake = tmp_path / "data", tmp_path / "lake"
    head = _run(capsys, "generate", "--output", data, "--events", 24, "--users", 6)
    assert head["events"] == 24 and head["files_in"]
    assert {r["kind"]: r["found_rows"] for r in _run(capsys, "verify", data)} == {"events": 24, "users": 6}
    paths = ("--events", data / "raw/events", "--users", data / "raw/users")
    assert _run(capsys, "refresh", "--lake", lake, *paths, "--run-id", "one")["quality"]["passed"] == 18
    window = ("--window-start", "2024-01-01", "--window-end", "2024-01-01")
    done = _run(capsys, "refresh", "--lake", lake, *paths, "--run-id", "two", *window)
    assert done["window"] == {"start": "2024-01-01", "end": "2024-01-01"}
    rows = _run(capsys, "report", "--lake", lake, "summary-by-type")
    assert {r["event_type"]: (r["events"], r["amount"]) for r in rows}["purchase"] == (4, 0.44)
    assert sum(r["events"] for r in _run(capsys, "report", "--lake", lake, "daily-by-country")) == 24
    old = _run(capsys, "report", "--lake", lake, "daily-by-type", "--revision", done["revision"])
    assert len(old) == 6


def test_follow_on_batch_and_rollback(spark, tmp_path, capsys):
    data, lake = tmp_path / "data", tmp_path / "lake"
    head = _run(capsys, "generate", "--output", tmp_path / "batch", "--events", 5, "--follow-on", 3)
    assert head["events"] == 5 and head["start_id"] == generate.BATCH3_START
    _run(capsys, "generate", "--output", data, "--events", 6, "--users", 6)
    paths = ("--events", data / "raw/events", "--users", data / "raw/users")
    _run(capsys, "refresh", "--lake", lake, *paths, "--run-id", "one")
    assert _run(capsys, "rollback", "--lake", lake, "dim_users", 1) == {"dim_users": 1, "fct_events": 2}


def test_acceptance_with_drill(spark, tmp_path, capsys):
    data = tmp_path / "data"
    _run(capsys, "generate", "--output", data, "--events", 24, "--users", 6, "--partition-by-date")
    found = _run(capsys, "acceptance", "--lake", tmp_path / "lake", "--dataset", data, "--failure-drill")
    assert found["counts"] == {"events": 24, "users": 6}
    assert found["drill"]["failed_checks"] == 2 and found["drill"]["publication_unchanged"]


def test_metrics(spark, tmp_path, capsys):
    lines = [
        {"query_id": "q", "execution_id": "run", "phase": "submitted"},
        {"query_id": "q", "state": "SUCCEEDED", "bytes_scanned": 10**12, "engine_ms": 5},
    ]
    (tmp_path / "log").write_text("\n".join(map(json.dumps, lines)))
    args = ("metrics", "--logs", tmp_path / "log", "--run-id", "run", "--seconds", 2, "--input-events", 10)
    row = _run(capsys, *args)
    assert (row["query_count"], row["scan_usd"], row["events_per_second"]) == (1, 5.0, 5.0)
    assert [(q["query_id"], q["bytes_scanned"]) for q in row["queries"]] == [("q", 10**12)]


@pytest.mark.parametrize("count", ["0", "-1"])
def test_counts_are_positive(count):
    with pytest.raises(SystemExit):
        main(["generate", "--output", "x", "--events", count])


def test_half_a_window(spark, tmp_path):
    args = ["refresh", "--lake", str(tmp_path), "--events", "e", "--users", "u", "--run-id", "r"]
    with pytest.raises(SystemExit):
        main([*args, "--window-start", "2024-01-01"])
