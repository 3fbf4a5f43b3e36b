"""Keeping an activity history free of duplicate days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.sources.tables import activity_dates

ACTIVITY_KEY = ("window_start", "therapeutic_area")


def new_days(staged: DataFrame, target: DataFrame) -> DataFrame:
    """Staged rows of days the target has no row of."""
    return _by_day(staged, target, "left_anti")


def known_days(staged: DataFrame, target: DataFrame) -> DataFrame:
    """Staged rows of days the target already has."""
    return _by_day(staged, target, "left_semi")


def _by_day(staged: DataFrame, target: DataFrame, how: str) -> DataFrame:
    # The distinct days are far below the broadcast limit in practice; adaptive execution sees
    # their real size and decides, so nothing here assumes it.
    return (
        staged.withColumn("activity_date", F.to_date("window_start"))
        .join(activity_dates(target), "activity_date", how)
        .drop("activity_date")
    )


def sync_report(staged: DataFrame, target: DataFrame) -> DataFrame:
    """One row: staged rows read, rows of known days (skipped) and of new days (appended)."""
    known = activity_dates(target).withColumn("known", F.lit(True))
    by_day = staged.select(F.to_date("window_start").alias("activity_date")).join(
        known, "activity_date", "left"
    )
    return by_day.agg(
        F.count("*").alias("rows_read"),
        F.count("known").alias("rows_skipped"),
        F.count_if(F.col("known").isNull()).alias("rows_appended"),
    )


def skipped_days(staged: DataFrame, target: DataFrame) -> DataFrame:
    """The days :func:`known_days` leaves out, in order."""
    return activity_dates(known_days(staged, target)).orderBy("activity_date")


def latest_rows(versions: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """The newest version of every key, null key parts included.

    Of rows with the same version the one with the greatest values is kept, compared in the order
    of the columns, so that the result never depends on the order of the rows.
    """
    values = [name for name in versions.columns if name not in (*keys, version)]
    return (
        versions.groupBy(*keys)
        .agg(F.max(F.struct(version, *values)).alias("row"))
        .select(*keys, *[F.col(f"row.{name}").alias(name) for name in values])
    )


def one_row_per_key(activity: DataFrame) -> DataFrame:
    """One row per window and area: of several the one with most updates, as totals only grow."""
    most = activity.withColumn("_updates", F.col("update_count"))
    return latest_rows(most, ACTIVITY_KEY, "_updates")

