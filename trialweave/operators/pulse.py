"""Events -> activity per day and area. Works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Codes counted, window length and lateness bound.
INDUSTRY = "INDUSTRY"
COMPLETED = "COMPLETED"
WINDOW = "1 day"
LATENESS = "5 seconds"


def daily_pulse(events: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Updates, industry updates, mean enrollment and completions per (window, area).

    Events without a valid ``event_time`` belong to no window. Counts and sums are combined in the
    map tasks, so one area holding most events does not load one reducer.
    """
    if events.isStreaming:
        events = events.withWatermark("event_time", lateness)
    return (
        events.groupBy(F.window("event_time", window).alias("w"), "therapeutic_area")
        .agg(
            F.count("*").alias("update_count"),
            F.count_if(F.col("sponsor_class") == INDUSTRY).alias("industry_sponsored"),
            F.avg(F.col("enrollment").cast("double")).alias("avg_enrollment"),
            F.count_if(F.col("overall_status") == COMPLETED).alias("completed_count"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "therapeutic_area",
            "update_count",
            "industry_sponsored",
            "avg_enrollment",
            "completed_count",
        )
    )
