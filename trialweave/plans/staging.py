"""Staging views: stored tables normalised for reporting. Lazy, recomputed from their source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.functions.scalars import ratio
from trialweave.functions.trial_codes import phase_label, phase_numeric, status_category


def stg_trials(trials: DataFrame, normalize: bool = False) -> DataFrame:
    """Trials with a readable phase, its number and a status category (18 columns)."""
    labelled = trials.filter(F.col("nct_id").isNotNull()).withColumn(
        "phase", phase_label(F.col("phase"))
    )
    return labelled.select(
        "nct_id",
        "brief_title",
        "overall_status",
        status_category(F.col("overall_status"), normalize).alias("status_category"),
        "phase",
        phase_numeric(F.col("phase")).alias("phase_numeric"),
        "study_type",
        "is_interventional",
        "sponsor_class",
        "lead_sponsor_name",
        "enrollment",
        "start_date",
        "completion_date",
        "first_posted_date",
        "start_year",
        "therapeutic_area",
        "is_completed",
        "trial_duration_days",
    )


def stg_daily_activity(activity: DataFrame) -> DataFrame:
    """Daily activity with the industry share and the calendar day (9 columns)."""
    return activity.filter(
        F.col("therapeutic_area").isNotNull() & (F.col("update_count") > 0)
    ).select(
        "window_start",
        "window_end",
        "therapeutic_area",
        "update_count",
        "industry_sponsored",
        "avg_enrollment",
        "completed_count",
        ratio(F.col("industry_sponsored"), F.col("update_count")).alias("industry_share"),
        F.to_date("window_start").alias("activity_date"),
    )
