"""spark-submit trialweave/jobs/daily.py --pages DIR --warehouse DIR [--date D | --backfill A B]"""

from __future__ import annotations

import argparse
import datetime as dt

from trialweave.plans.daily import day_before, run_backfill, run_daily
from trialweave.session import build_session
from trialweave.sinks.messages import TOPIC
from trialweave.streaming.history import MODES


def main() -> None:
    parser = argparse.ArgumentParser(description="Add days of registry updates to the history.")
    parser.add_argument("--pages", required=True, help="folder of event_date=YYYY-MM-DD")
    parser.add_argument("--warehouse", required=True)
    days = parser.add_mutually_exclusive_group()
    days.add_argument("--date", help="day of the updates, yesterday by default")
    days.add_argument("--backfill", nargs=2, metavar=("FIRST", "LAST"))
    parser.add_argument("--mode", choices=MODES, default=MODES[0])
    parser.add_argument("--page-per-line", action="store_true", help="files hold a page per line")
    parser.add_argument("--keep-nulls", action="store_true", help="null fields of pages stay null")
    parser.add_argument("--bootstrap-servers", help="publish to and read from a topic")
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--staging-url", help="stage the activity in a relational table")
    args = parser.parse_args()
    spark = build_session("trialweave-daily")
    if args.backfill:
        result = run_backfill(
            spark, args.pages, args.warehouse, *args.backfill, args.mode, args.page_per_line,
            args.keep_nulls,
        )
    else:
        day = args.date or day_before(dt.datetime.now(dt.UTC).date().isoformat())
        result = run_daily(
            spark, args.pages, args.warehouse, day, args.mode, args.page_per_line,
            args.bootstrap_servers, args.topic, args.staging_url, args.keep_nulls,
        )
    print(result.status)
    print(f"rows read {result.rows_read}, skipped {result.rows_skipped}, appended {result.rows_appended}")
    if result.skipped is not None:
        for row in result.skipped.toLocalIterator():
            print(f"skipped {row.activity_date}")


if __name__ == "__main__":
    main()
