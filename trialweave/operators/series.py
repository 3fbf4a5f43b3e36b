"""Series for charts: leading series plus the rest, and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OTHERS = "Others"


def top_series(df: DataFrame, series: str, value: str, n: int) -> DataFrame:
    """The ``n`` series with the largest totals; ties go to the first by name."""
    return (
        df.groupBy(series)
        .agg(F.sum(value).alias("_total"))
        .orderBy(F.desc("_total"), F.asc(series))
        .limit(n)
        .select(series)
    )


def top_n_and_others(
    df: DataFrame, series: str, value: str, keys: tuple[str, ...], n: int
) -> DataFrame:
    """Sum ``value`` per key and series, with all but the ``n`` largest series summed as Others.

    The broadcast side is a limit of ``n`` rows, so its size is bounded by the parameter.
    """
    leading = F.broadcast(top_series(df, series, value, n).withColumn("_leads", F.lit(True)))
    # Null-safe, so rows without a series can lead like any other.
    joined = df.join(
        leading.withColumnRenamed(series, "_series"),
        F.col(series).eqNullSafe(F.col("_series")),
        "left",
    )
    return (
        joined.withColumn(series, F.when(F.col("_leads"), F.col(series)).otherwise(OTHERS))
        .groupBy(*keys, series)
        .agg(F.sum(value).alias(value))
    )


def fill_days(
    df: DataFrame, day: str, series: str, value: str, first_day: str, last_day: str
) -> DataFrame:
    """One row per series and day of the range, zero where ``df`` has none.

    A series is first summed to one value per day, so the map built for it has at most as many
    entries as the range has days; the days are then looked up in it. No join is involved.
    """
    spine = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
    per_day = (
        df.filter(F.col(day).between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
        .groupBy(series, day)
        .agg(F.sum(value).alias(value))
    )
    return (
        per_day.groupBy(series)
        .agg(F.map_from_entries(F.collect_list(F.struct(day, value))).alias("_by_day"))
        .select(series, "_by_day", F.explode(spine).alias(day))
        .select(
            day, series, F.coalesce(F.element_at("_by_day", F.col(day)), F.lit(0)).alias(value)
        )
    )


def last_days(spark: SparkSession, as_of: str, days: int = 14) -> DataFrame:
    """The ``days`` calendar days up to and including ``as_of``, ascending."""
    end = F.lit(as_of).cast("date")
    return spark.range(1).select(
        F.explode(F.sequence(F.date_sub(end, days - 1), end)).alias("activity_date")
    )
