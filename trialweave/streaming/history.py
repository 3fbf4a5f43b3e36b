"""The activity history and its sync from the staging area.

The history is a folder per month and, below it, per load: ``activity_month=M/load=N``. A load holds the
*whole* month, merged from what was there and what came, and only the newest load of a month counts. So
reading takes as many files as there are months, however often a day is loaded, and a month changes at once:
its new folder is written aside and renamed. A load that is cut short leaves every month as it was or as it
should be. Of two loads of one month at the same time the second fails, as the number it would take is taken,
and can be repeated. The load before the newest stays until the next one, for readers that have begun; older
ones go.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave import schemas
from trialweave.operators.merge import (
    ACTIVITY_KEY,
    latest_rows,
    new_days,
    one_row_per_key,
    skipped_days,
    sync_report,
)
from trialweave.session import folders, move_folder, remove_folder
from trialweave.sinks import jdbc
from trialweave.sources.tables import read_table_or_empty
from trialweave.streaming.staging import last_batch, mark_synced, staged_activity, synced_batch

_HISTORY = T.StructType(
    [*schemas.DAILY_ACTIVITY.fields, T.StructField("loaded_at", T.TimestampType())]
)
_MERGED = T.StructType([T.StructField("batch_key", T.StringType())])
MODES = ("skip_date", "upsert")


@dataclass(frozen=True)
class SyncResult:
    status: str  # "empty", "nothing_new" or "appended"
    skipped: DataFrame | None = None  # days left out, in order
    rows_read: int = 0
    rows_skipped: int = 0
    rows_appended: int = 0


def _newest_loads(spark: SparkSession, path: str, month: str = "activity_month=*") -> dict[str, list[int]]:
    """The numbers of a month's loads, rising, by the name of its folder."""
    loads: dict[str, list[int]] = {}
    for folder in folders(spark, f"{path}/{month}/load=*"):
        *_, name, load = folder.split("/")
        loads.setdefault(name, []).append(int(load.partition("=")[2]))
    return {name: sorted(numbers) for name, numbers in loads.items()}


def _rows(spark: SparkSession, path: str, loads: dict[str, list[int]] | None = None) -> DataFrame:
    """The rows of the newest load of every month (or of the given ones), one per window and area."""
    loads = _newest_loads(spark, path) if loads is None else loads
    newest = [f"{path}/{month}/load={numbers[-1]}" for month, numbers in loads.items()]
    if not newest:
        return spark.createDataFrame([], _HISTORY)
    return spark.read.schema(_HISTORY).parquet(*newest)


def read_daily_activity(spark: SparkSession, path: str) -> DataFrame:
    """The history: one row per window and area, no rows before the first load."""
    return schemas.conform(_rows(spark, path), schemas.DAILY_ACTIVITY)


def append_activity(activity: DataFrame, path: str) -> None:
    """Bring rows into the months they belong to; other months are not touched.

    Of several versions of a window and area the newest counts. A row's version is its ``loaded_at``, or
    the time of this load where the rows have no such column.
    """
    spark = activity.sparkSession
    if "loaded_at" not in activity.columns:
        activity = activity.withColumn("loaded_at", F.current_timestamp())
    aside = f"{path}/_incoming-{uuid.uuid4().hex}"
    _write_months(schemas.conform(activity, _HISTORY), f"{aside}/came")
    months = [folder.rsplit("/", 1)[1] for folder in folders(spark, f"{aside}/came/activity_month=*")]
    loads = {month: _newest_loads(spark, path, month).get(month, []) for month in months}
    known = {month: numbers for month, numbers in loads.items() if numbers}
    if known:
        came = spark.read.schema(_HISTORY).parquet(*[f"{aside}/came/{month}" for month in known])
        _write_months(_rows(spark, path, known).unionByName(came), f"{aside}/whole")
    for month, numbers in loads.items():
        whole = f"{aside}/{'whole' if numbers else 'came'}/{month}"
        move_folder(spark, whole, f"{path}/{month}/load={numbers[-1] + 1 if numbers else 0}")
        for old in numbers[:-1]:
            remove_folder(spark, f"{path}/{month}/load={old}")
    remove_folder(spark, aside)


def _write_months(rows: DataFrame, path: str) -> None:
    """The newest version of every window and area, a file per month."""
    newest = latest_rows(rows.withColumn("version", F.col("loaded_at")), ACTIVITY_KEY, "version")
    month = F.date_format("window_start", "yyyy-MM")
    newest = schemas.conform(newest, _HISTORY).withColumn("activity_month", month)
    newest.repartition("activity_month").write.partitionBy("activity_month").parquet(path)


def merge_activity(
    spark: SparkSession, activity: DataFrame, target: str, mode: str = "skip_date"
) -> SyncResult:
    """Bring activity rows, stored ones as they are read more than once, into the history.

    ``skip_date`` appends only days the history lacks. ``upsert`` brings every row in as a newer
    version, so a late area of a known day is kept. Of several rows of a window and area the one
    with most updates counts.
    """
    _require_known(mode)
    activity = one_row_per_key(activity)
    # An upsert skips nothing: to it every day is new.
    known = _rows(spark, target) if mode == "skip_date" else spark.createDataFrame([], _HISTORY)
    skipped = skipped_days(activity, known) if mode == "skip_date" else None
    counts = sync_report(activity, known).first().asDict()
    if not counts["rows_appended"]:
        return SyncResult("nothing_new", skipped, **counts)
    append_activity(new_days(activity, known) if mode == "skip_date" else activity, target)
    return SyncResult("appended", skipped, **counts)


def sync_new_dates(
    spark: SparkSession, staging: str, target: str, mode: str = "skip_date"
) -> SyncResult:
    """Bring staged activity into the history, then clear the staging area.

    Without staged rows nothing happens. Otherwise the staging area is cleared even if no day was
    new. A run that dies in between is repeated safely: known days are skipped.
    """
    _require_known(mode)
    done = synced_batch(spark, staging)
    newest = last_batch(spark, staging, after=done)
    if newest < 0:
        return SyncResult("empty")
    staged = staged_activity(spark, staging, after=done, upto=newest)
    result = merge_activity(spark, staged, target, mode)
    mark_synced(spark, staging, newest)
    return result


def sync_relational(
    spark: SparkSession,
    url: str,
    staging: str,
    target: str,
    mode: str = "skip_date",
    table: str = jdbc.TABLE,
    **options: str,
) -> SyncResult:
    """:func:`sync_new_dates` from a relational staging table.

    Only micro-batches that the ledger names and whose rows are all there are merged, and only those are
    deleted (see ``sinks.jdbc``). Rows that land at any moment of a sync stay for a later one, whatever
    time they bear. They keep that time as their version, so that totals which arrive late never replace
    newer ones in the history.

    The tables are read once, into a folder below ``staging``; merging and the report work on that copy.
    ``staging`` also records which batches have been merged, until they are deleted: a sync that dies in
    between is repeated without reading them again. One sync runs at a time, writers at any time.
    """
    _require_known(mode)
    merged = [row["batch_key"] for row in _merged(spark, staging).collect()]
    copy = f"{staging}/relational/run-{uuid.uuid4().hex}"
    # The ledger first: the rows of every batch it names then have been committed.
    ledger = jdbc.read_jdbc(spark, url, jdbc.ledger_of(table), jdbc.LEDGER, **options)
    ledger = _copied(ledger.join(_merged(spark, staging), "batch_key", "left_anti"), f"{copy}/ledger")
    staged = jdbc.read_jdbc(spark, url, table, jdbc.STAGED, **options)
    staged = _copied(staged.join(ledger, "batch_key", "left_semi"), f"{copy}/rows")
    complete = jdbc.complete_batches(staged, ledger).select("batch_key")
    rows = staged.join(complete, "batch_key", "left_semi").drop("batch_key")
    result = SyncResult("empty")
    if not rows.isEmpty():
        versions = rows.withColumns(
            {"version": F.struct("staged_at", "batch_id"), "loaded_at": F.col("staged_at")}
        ).drop("staged_at", "batch_id")
        result = merge_activity(spark, latest_rows(versions, ACTIVITY_KEY, "version"), target, mode)
    # One row per micro-batch since the last sync.
    done = [row["batch_key"] for row in complete.collect()]
    if done:
        complete.coalesce(1).write.mode("append").parquet(f"{staging}/merged")
    if merged or done:
        jdbc.delete_jdbc_batches(spark, url, [*merged, *done], table, **options)
        remove_folder(spark, f"{staging}/merged")
    return result


def _merged(spark: SparkSession, staging: str) -> DataFrame:
    """Batches the history holds although they may not be deleted yet."""
    return read_table_or_empty(spark, f"{staging}/merged", _MERGED)


def _copied(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _require_known(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
