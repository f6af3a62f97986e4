"""Command line of the jobs, for spark-submit.

    spark-submit millwright/plans/run.py flush --topic logistics_events --base PATH --servers HOST
    spark-submit millwright/plans/run.py flush --topic hrss_telemetry --base PATH --landing PATH --repeats-ever
    spark-submit millwright/plans/run.py quarterly --quarter 2025-01-01 --base PATH --from-partials
    spark-submit millwright/plans/run.py compact --topic hrss_telemetry --base PATH
    spark-submit millwright/plans/run.py retain --topic hrss_telemetry --base PATH --oldest 2023-07-01
    spark-submit millwright/plans/run.py erase --topic logistics_events --base PATH --column asset_id --ids CSV
    spark-submit millwright/plans/run.py replay --topic logistics_events --base PATH --run NAME
    spark-submit millwright/plans/run.py logs --path PATH --base PATH --batch NAME
    spark-submit millwright/plans/run.py profile --path CSV --out PATH

The quarter is an argument and not taken from the clock, so a scheduler can repeat any run.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from millwright.plans import jobs  # noqa: E402
from millwright.plans.jobs import CONTRACTS, flush_topic, quarterly  # noqa: E402
from millwright.session import builder  # noqa: E402


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millwright")
    commands = parser.add_subparsers(dest="command", required=True)
    flush = commands.add_parser("flush", help="take what has arrived on a topic into the raw table")
    flush.add_argument("--topic", required=True, choices=sorted(CONTRACTS))
    flush.add_argument("--base", required=True)
    origin = flush.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers")
    origin.add_argument("--landing")
    flush.add_argument("--repeats-within")
    flush.add_argument("--repeats-ever", action="store_true", help="drop payloads that any earlier flush accepted")
    rebuild = commands.add_parser("quarterly", help="rebuild one quarter of the feature tables")
    rebuild.add_argument("--quarter", required=True, help="its first day, yyyy-mm-dd")
    rebuild.add_argument("--base", required=True)
    rebuild.add_argument("--computed-at", help="ISO time stored with the rows; default now")
    rebuild.add_argument("--min-rows", type=int, default=1, help="0: take the quarter as it is")
    rebuild.add_argument("--max-gap-days", type=int, default=7)
    rebuild.add_argument("--from-partials", action="store_true", help="from stored partial sums")
    for name, text in (
        ("compact", "merge the small files of a raw table"), ("retain", "drop old rows of a raw table"),
        ("erase", "remove the rows of given ids from a raw table"), ("replay", "take quarantined messages again"),
    ):
        table = commands.add_parser(name, help=text)
        table.add_argument("--topic", required=True, choices=sorted(CONTRACTS))
        table.add_argument("--base", required=True)
        if name == "compact":
            table.add_argument("--before", help="leave out batches from this name on")
            table.add_argument("--keep-hours", type=float, default=24.0, help="how long replaced files stay")
        if name == "retain":
            table.add_argument("--oldest", required=True, help="the first day that stays, yyyy-mm-dd")
        if name == "erase":
            table.add_argument("--column", required=True)
            table.add_argument("--ids", required=True, help="a CSV file with that column")
        if name == "replay":
            table.add_argument("--run", required=True, help="a name that no run before had")
    entries = commands.add_parser("logs", help="add log files to the table of log entries")
    entries.add_argument("--path", required=True)
    entries.add_argument("--base", required=True)
    entries.add_argument("--batch", required=True)
    columns = commands.add_parser("profile", help="profile the columns of CSV files")
    columns.add_argument("--path", required=True)
    columns.add_argument("--out", required=True)
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = builder(f"millwright {args.command}").getOrCreate()
    if args.command == "flush":
        flush_topic(
            spark, args.topic, args.base, servers=args.servers, landing=args.landing,
            repeats_within=args.repeats_within, repeats_ever=args.repeats_ever,
        ).awaitTermination()
    elif args.command == "quarterly":
        computed_at = (
            datetime.fromisoformat(args.computed_at) if args.computed_at
            else datetime.now(timezone.utc)
        )
        quarterly(
            spark, args.quarter, args.base, computed_at, min_rows=args.min_rows, max_gap_days=args.max_gap_days,
            from_partials=args.from_partials,
        )
    elif args.command == "compact":
        print(jobs.compact_topic(spark, args.topic, args.base, args.before, keep_hours=args.keep_hours))
    elif args.command == "retain":
        print(jobs.retain_topic(spark, args.topic, args.base, args.oldest))
    elif args.command == "erase":
        print(jobs.erase_topic(spark, args.topic, args.base, args.column, args.ids))
    elif args.command == "replay":
        print(jobs.replay_topic(spark, args.topic, args.base, args.run))
    elif args.command == "logs":
        jobs.add_logs(spark, args.path, args.base, args.batch)
    else:
        jobs.profile_csv(spark, args.path, args.out)


if __name__ == "__main__":
    main()
