"""spark-submit trialweave/jobs/monthly.py --snapshots DIR --warehouse DIR [--date D]"""

from __future__ import annotations

import argparse

from trialweave.plans.monthly import run_monthly
from trialweave.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(description="Rebuild the trial table and the landscape mart.")
    parser.add_argument("--snapshots", required=True, help="folder of snapshot_date=YYYY-MM-DD")
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--date", help="snapshot date, today by default")
    parser.add_argument("--whole-files", action="store_true", help="read a file per task")
    parser.add_argument("--max-record-chars", type=int, help="refuse longer records: a lost quote")
    parser.add_argument("--normalize", action="store_true", help="match statuses in any case")
    args = parser.parse_args()
    count = run_monthly(
        build_session("trialweave-monthly"),
        args.snapshots,
        args.warehouse,
        args.date,
        whole_files=args.whole_files,
        normalize=args.normalize,
        max_record_chars=args.max_record_chars,
    )
    print(f"wrote {count:,} trials")


if __name__ == "__main__":
    main()
