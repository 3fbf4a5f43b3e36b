"""The daily run: landed pages -> events -> activity -> history -> trends mart."""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from trialweave.functions.scalars import timestamp_or_null
from trialweave.operators.pulse import daily_pulse
from trialweave.plans.marts import activity_trends
from trialweave.plans.staging import stg_daily_activity
from trialweave.session import folders, remove_folder
from trialweave.sinks import jdbc
from trialweave.sinks.messages import TOPIC, publish
from trialweave.sinks.tables import write_trends
from trialweave.sources.pages import flatten_pages, read_pages
from trialweave.streaming.history import (
    SyncResult,
    read_daily_activity,
    sync_new_dates,
    sync_relational,
)
from trialweave.streaming.pulse_stream import pulse_from_messages
from trialweave.streaming.staging import write_changes


def day_before(as_of: str) -> str:
    return (dt.date.fromisoformat(as_of) - dt.timedelta(days=1)).isoformat()


def refresh_trends(spark: SparkSession, warehouse: str) -> None:
    activity = read_daily_activity(spark, f"{warehouse}/daily_activity")
    write_trends(
        activity_trends(stg_daily_activity(activity)), f"{warehouse}/mart_activity_trends"
    )


def run_daily(
    spark: SparkSession,
    pages: str,
    warehouse: str,
    event_date: str,
    mode: str = "skip_date",
    per_line: bool = False,
    servers: str | None = None,
    topic: str = TOPIC,
    staging_url: str | None = None,
    keep_nulls: bool = False,
) -> SyncResult:
    """Publish a day's updates, aggregate them, sync and refresh the mart.

    Every run is independent: it replaces the day's messages and aggregates them from an empty
    state in a staging folder of its own. So a day may be run again or out of order. With
    ``servers`` the messages go through a topic instead, whose read position and state are kept
    from run to run; with ``staging_url`` the activity is staged in a relational table.
    """
    events = flatten_pages(read_pages(spark, pages, event_date, event_date, per_line), keep_nulls)
    quarantine = f"{warehouse}/quarantine/event_date={event_date}"
    write = jdbc.jdbc_writer(staging_url) if staging_url else None
    if servers:
        stage = f"{warehouse}/staging/topic={topic}"
        publish(events, servers=servers, topic=topic)
        source = {"servers": servers, "topic": topic}
        pulse_from_messages(spark, stage, f"{warehouse}/quarantine/topic={topic}", write=write, **source)
    else:
        stage = _fresh_stage(warehouse, event_date)
        messages = f"{warehouse}/trial_updates/event_date={event_date}"
        if publish(events, messages, mode="overwrite"):
            pulse_from_messages(spark, stage, quarantine, write=write, path=messages)
    if staging_url:
        target = f"{warehouse}/daily_activity"
        result = sync_relational(spark, staging_url, f"{warehouse}/staging", target, mode)
        return _refreshed(spark, result, warehouse)
    return _sync_and_refresh(spark, stage, warehouse, mode, keep=bool(servers))


def activity_of_pages(pages: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Daily activity of landed pages as one batch query."""
    events = flatten_pages(pages, keep_nulls)
    return daily_pulse(events.withColumn("event_time", timestamp_or_null(events.event_date)))


def run_backfill(
    spark: SparkSession,
    pages: str,
    warehouse: str,
    first_day: str,
    last_day: str,
    mode: str = "skip_date",
    per_line: bool = False,
    keep_nulls: bool = False,
) -> SyncResult:
    """Aggregate all days of a range in one job and merge them into the history.

    Days are independent of each other and known days are skipped, so a backfill may overlap
    earlier runs. The pages are read once: the merge works on the staged result.
    """
    stage = _fresh_stage(warehouse, f"{first_day}_{last_day}")
    activity = activity_of_pages(
        read_pages(spark, pages, first_day, last_day, per_line), keep_nulls
    )
    write_changes(activity, stage, 0)
    return _sync_and_refresh(spark, stage, warehouse, mode)


def _fresh_stage(warehouse: str, days: str) -> str:
    return f"{warehouse}/staging/event_date={days}/run-{uuid.uuid4().hex}"


def _sync_and_refresh(
    spark: SparkSession, stage: str, warehouse: str, mode: str, keep: bool = False
) -> SyncResult:
    """Sync a staging folder. A run's own folder has served its purpose then and is removed.

    A run that dies before leaves its folder; :func:`remove_old_stages` removes those.
    """
    result = _refreshed(
        spark, sync_new_dates(spark, stage, f"{warehouse}/daily_activity", mode), warehouse
    )
    if not keep:
        if result.skipped is not None:
            # The report must not need the folder any more; it has at most a row per day.
            days = result.skipped.collect()
            skipped = spark.createDataFrame(days, result.skipped.schema).orderBy("activity_date")
            result = dataclasses.replace(result, skipped=skipped)
        remove_folder(spark, stage)
    return result


def _refreshed(spark: SparkSession, result: SyncResult, warehouse: str) -> SyncResult:
    if result.status == "appended":
        refresh_trends(spark, warehouse)
    return result


def remove_old_stages(spark: SparkSession, warehouse: str) -> None:
    """Remove what daily runs and backfills that died have staged; only when none is running."""
    for kind in ("event_date=*", "relational"):
        for folder in folders(spark, f"{warehouse}/staging/{kind}/run-*"):
            remove_folder(spark, folder)

