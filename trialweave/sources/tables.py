"""Tables as sources: parquet folders with a known schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave import schemas


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists. Any other failure to reach it is raised, not read as absence."""
    try:
        spark.read.text(path).schema  # noqa: B018  (analysis checks the path, no data is read)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows where nothing was ever written."""
    if path_exists(spark, path):
        return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """The enriched trial table; filters on ``start_year`` prune its folders."""
    return read_table(spark, path, schemas.TRIALS).select(*schemas.TRIALS.names)


def read_landscape(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.LANDSCAPE).select(*schemas.LANDSCAPE.names)


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.TRENDS)


def activity_dates(activity: DataFrame) -> DataFrame:
    """The distinct days a daily-activity table holds."""
    return activity.select(F.to_date("window_start").alias("activity_date")).distinct()
