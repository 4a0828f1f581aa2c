"""Command line: ``python -m eventmart <command>``; each command prints one JSON document."""

from __future__ import annotations

import argparse
import json

from eventmart.operators import reports
from eventmart.plans import acceptance, publication
from eventmart.plans.lake import Lake
from eventmart.plans.refresh import refresh_from_files
from eventmart.session import session, small_frame
from eventmart.sources import generate, manifest


def _positive(text: str) -> int:
    if not text.isdecimal() or not int(text):
        raise argparse.ArgumentTypeError(f"{text} is no count from 1 on")
    return int(text)


def _window(args) -> dict | None:
    edges = {"start": args.window_start, "end": args.window_end}
    given = [name for name, day in edges.items() if day]
    if len(given) == 1:
        raise SystemExit(f"the window has only its {given[0]}")
    return edges if given else None


def _rows(df) -> list[dict]:
    """A report (one row per date and group) as JSON values."""
    return [json.loads(row) for row in df.toJSON().collect()]


def make(spark, args):
    if args.follow_on:
        return {"3": generate.batch3, "4": generate.batch4}[args.follow_on](spark, args.output, args.events)
    return generate.generate(
        spark, args.output, args.events, args.users, args.shard_size, args.start_id, args.partition_by_date
    )


def verify(spark, args):
    manifest.load_verified(spark, args.dataset)
    return _rows(manifest.audit_totals(spark, args.dataset))


def run(spark, args):
    lake = Lake(spark, args.lake, args.database)
    partitioned = args.partitioned_source
    return refresh_from_files(lake, args.events, args.users, args.run_id, _window(args), partitioned)


def roll_back(spark, args):
    lake = Lake(spark, args.lake, args.database)
    lake.marts[args.mart].rollback(args.snapshot)
    return lake.snapshot_ids()


def report(spark, args):
    lake = Lake(spark, args.lake, args.database)
    if args.name == "daily-by-country":
        return _rows(publication.published_daily_by_country(lake, args.revision))
    facts = publication.read_published(lake, args.revision)["fct_events"]
    by_name = {"summary-by-type": reports.summary_by_type, "daily-by-type": reports.daily_by_type}
    return _rows(by_name[args.name](facts))


def accept(spark, args):
    lake = Lake(spark, args.lake, args.database)
    result = {"counts": acceptance.replay(lake, args.dataset)}
    if args.failure_drill:
        data = manifest.load_verified(spark, args.dataset)
        result["drill"] = acceptance.failure_drill(lake, data["events"], data["users"], acceptance.new_run("drill"))
        acceptance.replay(lake, args.dataset, ("recovery",))
    return result


def metrics(spark, args):
    schema = "execution_id string, duration_seconds long, input_events long"
    runs = small_frame(spark, [(args.run_id, args.seconds, args.input_events)], schema)
    found = reports.run_scan_metrics(spark.read.text(args.logs), runs, args.run_id, args.usd_per_tb)
    queries = reports.run_queries(spark.read.text(args.logs), args.run_id)
    return _rows(found)[0] | {"queries": _rows(queries.orderBy("query_id"))}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="eventmart", description=__doc__)
    top.add_argument("--master", help="Spark master; default: the environment's")
    commands = top.add_subparsers(required=True)

    def command(name, action, *lake: str):
        added = commands.add_parser(name)
        added.set_defaults(action=action)
        if lake:
            added.add_argument("--lake", required=True)
            added.add_argument("--database", default="eventmart")
        return added

    p = command("generate", make)
    p.add_argument("--output", required=True)
    p.add_argument("--events", type=_positive, default=50_000_000)
    p.add_argument("--users", type=_positive, default=1_000_000)
    p.add_argument("--shard-size", type=_positive, default=generate.SHARD_ROWS)
    p.add_argument("--start-id", type=_positive, default=1)
    p.add_argument("--partition-by-date", action="store_true")
    p.add_argument("--follow-on", choices=("3", "4"), help="a batch after the base data; takes --events only")

    p = command("verify", verify)
    p.add_argument("dataset")

    p = command("refresh", run, "lake")
    p.add_argument("--events", required=True)
    p.add_argument("--users", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--window-start")
    p.add_argument("--window-end")
    p.add_argument("--partitioned-source", action="store_true")

    p = command("report", report, "lake")
    p.add_argument("name", choices=("summary-by-type", "daily-by-type", "daily-by-country"))
    p.add_argument("--revision", default=publication.CURRENT)

    p = command("rollback", roll_back, "lake")
    p.add_argument("mart", choices=("dim_users", "fct_events"))
    p.add_argument("snapshot", type=_positive)

    p = command("acceptance", accept, "lake")
    p.add_argument("--dataset", required=True)
    p.add_argument("--failure-drill", action="store_true")

    p = command("metrics", metrics)
    p.add_argument("--logs", required=True)
    p.add_argument("--run-id", required=True)
    p.add_argument("--seconds", type=int, required=True)
    p.add_argument("--input-events", type=int, required=True)
    p.add_argument("--usd-per-tb", type=float, default=5.0)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session("eventmart", args.master)
    print(json.dumps(args.action(spark, args)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
