"""The staging area between the daily aggregation and the activity history.

One folder per streaming query: ``checkpoint`` (read position and window state), ``changelog`` and
``synced``; with a quarantine also ``intake`` and ``events`` (see ``pulse_stream.run_intake``). ``changelog/batch_id=N`` holds the groups that micro-batch N changed; a replayed batch
overwrites its own folder, so replays change nothing. ``synced`` records up to which batch the
history has been brought. Clearing the staging area means moving that mark, so rows that arrive
while a sync is running are not lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave import schemas
from trialweave.operators.merge import ACTIVITY_KEY, latest_rows
from trialweave.sources.tables import read_table_or_empty

_BATCH = T.StructField("batch_id", T.LongType())
_CHANGES = T.StructType([*schemas.DAILY_ACTIVITY.fields, _BATCH])
_SYNCED = T.StructType([_BATCH])


def write_changes(activity: DataFrame, root: str, batch_id: int) -> None:
    schemas.conform(activity, schemas.DAILY_ACTIVITY).write.mode("overwrite").parquet(
        f"{root}/changelog/batch_id={batch_id}"
    )


def last_batch(spark: SparkSession, root: str, after: int = -1) -> int:
    """The newest batch staged after batch ``after``, -1 when there is none."""
    return _largest(_changes_after(spark, root, after))


def synced_batch(spark: SparkSession, root: str) -> int:
    """The last batch the history holds, -1 when there is none."""
    return _largest(read_table_or_empty(spark, f"{root}/synced", _SYNCED))


def mark_synced(spark: SparkSession, root: str, batch_id: int) -> None:
    mark = spark.createDataFrame([(batch_id,)], _SYNCED)
    mark.coalesce(1).write.mode("append").parquet(f"{root}/synced")


def staged_activity(
    spark: SparkSession, root: str, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Newest staged row per window and area from batches not yet synced."""
    after = synced_batch(spark, root) if after is None else after
    changes = _changes_after(spark, root, after)
    if upto is not None:
        changes = changes.filter(F.col("batch_id") <= upto)
    return schemas.conform(latest_rows(changes, ACTIVITY_KEY, "batch_id"), schemas.DAILY_ACTIVITY)


def _changes_after(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    changes = read_table_or_empty(spark, f"{root}/changelog", _CHANGES)
    return changes.filter(F.col("batch_id") > batch_id)


def _largest(df: DataFrame) -> int:
    return df.agg(F.coalesce(F.max("batch_id"), F.lit(-1)).alias("batch_id")).first().batch_id
