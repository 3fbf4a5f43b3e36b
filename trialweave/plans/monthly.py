"""The monthly run: snapshot files -> trial table -> landscape mart -> checks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trialweave.operators.quality import ACTIVITY_CHECKS, TRIAL_CHECKS, require_clean, run_checks
from trialweave.operators.trials import enrich_trials
from trialweave.plans.marts import trial_landscape
from trialweave.plans.staging import stg_trials
from trialweave.sinks.tables import write_landscape, write_trials
from trialweave.sources.snapshots import land_snapshot, read_landed, resolve_snapshot
from trialweave.sources.tables import path_exists, read_trials
from trialweave.streaming.history import read_daily_activity


def run_monthly(
    spark: SparkSession,
    snapshots: str,
    warehouse: str,
    snapshot_date: str | None = None,
    whole_files: bool = False,
    normalize: bool = False,
    max_record_chars: int | None = None,
) -> int:
    """Rebuild the trial table and its mart, check them, and return the number of trials."""
    folder = resolve_snapshot(spark, snapshots, snapshot_date)
    land_snapshot(spark, folder, f"{warehouse}/landed", whole_files, max_record_chars)
    studies, sponsors, conditions = read_landed(spark, f"{warehouse}/landed")
    trials = enrich_trials(studies, sponsors, conditions, normalize=normalize)
    count = write_trials(trials, f"{warehouse}/trials")
    stored = read_trials(spark, f"{warehouse}/trials")
    write_landscape(
        trial_landscape(stg_trials(stored, normalize)), f"{warehouse}/mart_trial_landscape"
    )
    check_tables(spark, warehouse)
    return count


def check_tables(spark: SparkSession, warehouse: str) -> None:
    """Run the checks of every stored table and raise if one fails."""
    report = run_checks(read_trials(spark, f"{warehouse}/trials"), TRIAL_CHECKS, "trials")
    if path_exists(spark, f"{warehouse}/daily_activity"):
        activity = read_daily_activity(spark, f"{warehouse}/daily_activity")
        report = report.unionByName(run_checks(activity, ACTIVITY_CHECKS, "daily_activity"))
    require_clean(report)
