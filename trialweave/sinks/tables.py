"""Writing the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trialweave import schemas
from trialweave.sources.tables import read_landscape, read_trends, read_trials
from trialweave.plans.staging import stg_daily_activity, stg_trials


def _write_by_year(df: DataFrame, path: str, cluster: tuple[str, str]) -> None:
    """Replace a table partitioned by ``start_year`` and clustered inside each year.

    The rebalance hint shuffles by year and first cluster column; adaptive execution then joins
    small partitions and splits large ones at the advisory size. So a year with most of the trials
    is written by many tasks, and no sampling pass is needed to find the ranges. Sorting inside the
    tasks gives parquet row groups narrow min/max ranges of the cluster columns.
    """
    (
        df.hint("rebalance", "start_year", cluster[0])
        .sortWithinPartitions("start_year", *cluster)
        .write.mode("overwrite")
        .partitionBy("start_year")
        .parquet(path)
    )


def write_trials(trials: DataFrame, path: str) -> int:
    """Replace the trial table and return its row count.

    The count comes from the footers of the committed files: the plan does not run again, and task
    attempts that were lost or repeated cannot distort it.
    """
    _write_by_year(
        schemas.conform(trials, schemas.TRIALS), path, ("therapeutic_area", "overall_status")
    )
    return read_trials(trials.sparkSession, path).count()


def write_landscape(landscape: DataFrame, path: str) -> None:
    _write_by_year(
        schemas.conform(landscape, schemas.LANDSCAPE), path, ("therapeutic_area", "phase")
    )


def write_trends(trends: DataFrame, path: str) -> None:
    """Replace the trends table; one row per area and day, so it is not partitioned."""
    schemas.conform(trends, schemas.TRENDS).write.mode("overwrite").parquet(path)


def register_views(spark: SparkSession, warehouse: str, activity: DataFrame | None = None) -> None:
    """Views over a warehouse folder: tables as they are stored, staging computed on read."""
    trials = read_trials(spark, f"{warehouse}/trials")
    trials.createOrReplaceTempView("trials")
    stg_trials(trials).createOrReplaceTempView("stg_trials")
    read_landscape(spark, f"{warehouse}/mart_trial_landscape").createOrReplaceTempView(
        "mart_trial_landscape"
    )
    if activity is not None:
        activity.createOrReplaceTempView("daily_activity")
        stg_daily_activity(activity).createOrReplaceTempView("stg_daily_activity")
        read_trends(spark, f"{warehouse}/mart_activity_trends").createOrReplaceTempView(
            "mart_activity_trends"
        )
