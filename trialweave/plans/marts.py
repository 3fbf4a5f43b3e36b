"""Marts: the two aggregate tables behind the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.functions.scalars import ratio

# Fixed value: first start year of the landscape.
FIRST_YEAR = 2010

LANDSCAPE_KEYS = (
    "therapeutic_area", "start_year", "phase", "phase_numeric", "sponsor_class", "status_category",
)


def trial_landscape(staged: DataFrame, min_year: int = FIRST_YEAR) -> DataFrame:
    """Counts and means per area, year, phase, sponsor class and status category.

    ``completion_rate`` is within a status category, see :func:`completion_by_phase`.
    """
    return (
        staged.filter((F.col("start_year") >= min_year) & F.col("therapeutic_area").isNotNull())
        .groupBy(*LANDSCAPE_KEYS)
        .agg(
            F.count("*").alias("trial_count"),
            ratio(F.count_if("is_completed"), F.count("*")).alias("completion_rate"),
            F.avg("enrollment").alias("avg_enrollment"),
            F.avg("trial_duration_days").alias("avg_duration_days"),
            F.sum("enrollment").alias("total_planned_enrollment"),
        )
    )


def completion_by_phase(landscape: DataFrame) -> DataFrame:
    """Share of completed trials per area and phase, over all status categories."""
    completed = F.sum(F.col("completion_rate") * F.col("trial_count"))
    return landscape.groupBy("therapeutic_area", "phase").agg(
        F.sum("trial_count").alias("trial_count"),
        ratio(completed, F.sum("trial_count")).alias("completion_rate"),
    )


def activity_trends(staged: DataFrame) -> DataFrame:
    """Daily totals per area and day. The mean enrollment is the unweighted mean of the rows."""
    return staged.groupBy("therapeutic_area", "activity_date").agg(
        F.sum("update_count").alias("daily_updates"),
        F.sum("industry_sponsored").alias("industry_updates"),
        F.avg("avg_enrollment").alias("avg_enrollment"),
        ratio(F.sum("industry_sponsored"), F.sum("update_count")).alias("industry_share"),
        F.sum("completed_count").alias("completed_count"),
    )


def enrollment_by_month(staged: DataFrame) -> DataFrame:
    """Mean enrollment per area and month: of the rows, and of the updates behind them.

    A row's mean weighs as many updates as the row counts, so a day with one update does not weigh as
    much as one with thousands. Rows without a mean carry no weight; without any the means are null.
    """
    weight = F.when(F.col("avg_enrollment").isNotNull(), F.col("update_count"))
    return staged.groupBy(
        "therapeutic_area", F.trunc("activity_date", "month").alias("activity_month")
    ).agg(
        F.sum("update_count").alias("update_count"),
        F.avg("avg_enrollment").alias("avg_enrollment"),
        ratio(F.sum(F.col("avg_enrollment") * weight), F.sum(weight)).alias("weighted_enrollment"),
    )


def newest_first(trends: DataFrame) -> DataFrame:
    """Trends in reading order; a stored table keeps none."""
    return trends.orderBy(
        F.desc("activity_date"), F.desc("daily_updates"), F.asc("therapeutic_area")
    )
