"""Report and verification queries over the trial table and the two marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.functions.trial_codes import ALL_PHASES
from trialweave.operators.series import fill_days, top_n_and_others
from trialweave.plans.marts import FIRST_YEAR

# Field labels of the report.
LANDSCAPE_LABELS = {
    "therapeutic_area": "Therapeutic Area",
    "start_year": "Start Year",
    "phase": "Phase",
    "phase_numeric": "Phase (Numeric)",
    "sponsor_class": "Sponsor",
    "status_category": "Status",
    "trial_count": "Trial Count",
    "completion_rate": "Completion Rate",
    "avg_enrollment": "Avg Enrollment",
    "avg_duration_days": "Avg Duration (Days)",
}
TRENDS_LABELS = {
    "activity_date": "Activity Date",
    "therapeutic_area": "Therapeutic Area",
    "daily_updates": "Daily Updates",
    "industry_updates": "Industry Updates",
    "avg_enrollment": "Avg Enrollment",
    "industry_share": "Industry Share",
}
# Fixed value: lines drawn before the rest becomes Others.
SERIES_SHOWN = 7


def relabel(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(labels)


# --- landscape ---------------------------------------------------------------------------------


def landscape_selection(
    landscape: DataFrame,
    min_year: int = FIRST_YEAR,
    start_year: int | None = None,
    sponsor: str | None = None,
) -> DataFrame:
    """The report's fixed first year plus its two independent, optional controls."""
    selected = landscape.filter(F.col("start_year") >= min_year)
    if start_year is not None:
        selected = selected.filter(F.col("start_year") == start_year)
    if sponsor is not None:
        selected = selected.filter(F.col("sponsor_class") == sponsor)
    return selected


def area_by_phase(selection: DataFrame) -> DataFrame:
    """Trials per area and phase, one row per segment of a bar."""
    return selection.groupBy("therapeutic_area", "phase").agg(
        F.sum("trial_count").alias("trial_count")
    )


def area_by_phase_pivot(selection: DataFrame) -> DataFrame:
    """One bar per area, longest first: a column per phase and the total.

    The phases are listed, so no extra job looks for them.
    """
    phases = [F.coalesce(F.col(phase), F.lit(0)).alias(phase) for phase in ALL_PHASES]
    total = sum((F.coalesce(F.col(phase), F.lit(0)) for phase in ALL_PHASES), F.lit(0))
    return (
        selection.groupBy("therapeutic_area")
        .pivot("phase", list(ALL_PHASES))
        .agg(F.sum("trial_count"))
        .select("therapeutic_area", *phases, total.cast("bigint").alias("trial_count"))
        .orderBy(F.desc("trial_count"), F.asc("therapeutic_area"))
    )


def year_control(landscape: DataFrame) -> DataFrame:
    """Entries of the start-year list, latest first."""
    return (
        landscape.groupBy("start_year")
        .agg(F.sum("trial_count").alias("trial_count"))
        .orderBy(F.desc("start_year"))
    )


def sponsor_control(landscape: DataFrame) -> DataFrame:
    """Entries of the sponsor list, most trials first."""
    return (
        landscape.groupBy("sponsor_class")
        .agg(F.sum("trial_count").alias("trial_count"))
        .orderBy(F.desc("trial_count"), F.asc("sponsor_class"))
    )


def years_of_area(df: DataFrame, first_year: int, last_year: int, area: str) -> DataFrame:
    """Rows of one area in a range of years; prunes year folders and skips row groups."""
    return df.filter(
        F.col("start_year").between(first_year, last_year) & (F.col("therapeutic_area") == area)
    )


# --- activity ----------------------------------------------------------------------------------


def month_to_date(as_of: str) -> tuple[str, str]:
    """First and last day of the default report range."""
    day = dt.date.fromisoformat(as_of)
    return day.replace(day=1).isoformat(), day.isoformat()


def in_range(trends: DataFrame, first_day: str, last_day: str) -> DataFrame:
    return trends.filter(
        F.col("activity_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    )


def updates_by_day_and_area(trends: DataFrame, first_day: str, last_day: str) -> DataFrame:
    return (
        in_range(trends, first_day, last_day)
        .groupBy("activity_date", "therapeutic_area")
        .agg(F.sum("daily_updates").alias("daily_updates"))
        .orderBy(F.desc("daily_updates"), F.asc("activity_date"), F.asc("therapeutic_area"))
    )


def activity_lines(
    trends: DataFrame, first_day: str, last_day: str, shown: int = SERIES_SHOWN
) -> DataFrame:
    """The line chart: leading areas, Others, and zero on days without updates."""
    lines = top_n_and_others(
        in_range(trends, first_day, last_day),
        "therapeutic_area",
        "daily_updates",
        ("activity_date",),
        shown,
    )
    return fill_days(
        lines, "activity_date", "therapeutic_area", "daily_updates", first_day, last_day
    )


# --- verification ------------------------------------------------------------------------------


def area_counts(trials: DataFrame) -> DataFrame:
    return (
        trials.groupBy("therapeutic_area")
        .agg(F.count("*").alias("trial_count"))
        .orderBy(F.desc("trial_count"), F.asc("therapeutic_area"))
    )


def area_years(landscape: DataFrame, limit: int = 20) -> DataFrame:
    """Trials per area and year, latest year first, the first ``limit`` rows."""
    return (
        landscape.groupBy("therapeutic_area", "start_year")
        .agg(F.sum("trial_count").alias("n"))
        .orderBy(F.desc("start_year"), F.desc("n"), F.asc("therapeutic_area"))
        .limit(limit)
    )


def daily_totals(trends: DataFrame) -> DataFrame:
    return (
        trends.groupBy("activity_date")
        .agg(F.sum("daily_updates").alias("total"))
        .orderBy(F.desc("activity_date"))
    )
