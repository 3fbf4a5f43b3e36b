"""The named queries: callables from (session, table folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.catalog import adapters
from trialweave.functions.areas import conditions_area, conditions_area_by_key
from trialweave.functions.scalars import timestamp_or_null, yesterday
from trialweave.operators import merge, quality, series, trials
from trialweave.operators.pulse import daily_pulse
from trialweave.plans import marts, report, staging
from trialweave.plans.daily import activity_of_pages, refresh_trends, run_backfill
from trialweave.plans.monthly import run_monthly
from trialweave.session import scratch_path, configure
from trialweave.sinks.messages import encode_events, publish
from trialweave.sinks.tables import (
    register_views,
    write_landscape,
    write_trends,
    write_trials,
)
from trialweave.sources.events import decode_events, good_events
from trialweave.sources.pages import flatten_pages
from trialweave.sources.delimited import read_delimited, read_delimited_split
from trialweave.sources.snapshots import FALLBACK_SNAPSHOT, FILES, land
from trialweave.sources.tables import read_landscape, read_trends, read_trials
from trialweave.streaming.history import (
    append_activity,
    merge_activity,
    read_daily_activity,
    sync_new_dates,
)
from trialweave.streaming.pulse_stream import pulse_from_messages
from trialweave.streaming.staging import staged_activity, write_changes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The events cover January 2024 up to the 30th; the day after has none and must be filled.
AS_OF = "2024-01-31"
# Days before this one count as already loaded in the sync queries.
KNOWN_BEFORE = "2024-01-16"


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    QUERIES[run.__name__] = configured
    return configured


# --- shared inputs -----------------------------------------------------------------------------


def _enriched(spark, sf_dir):
    return trials.enrich_trials(*adapters.batch_inputs(spark, sf_dir))


def _landscape(spark, sf_dir):
    return marts.trial_landscape(staging.stg_trials(_enriched(spark, sf_dir)))


def _events(spark, sf_dir):
    updates = adapters.trial_updates(spark, sf_dir)
    return updates.withColumn("event_time", timestamp_or_null(F.col("event_date")))


def _activity(spark, sf_dir):
    return daily_pulse(_events(spark, sf_dir))


def _trends(spark, sf_dir):
    return marts.activity_trends(staging.stg_daily_activity(_activity(spark, sf_dir)))


def _known_activity(spark, sf_dir):
    """An earlier load: the first days, of which only one area had arrived."""
    return _activity(spark, sf_dir).filter(
        (F.col("window_start") < F.lit(KNOWN_BEFORE).cast("timestamp"))
        & (F.col("therapeutic_area") == "Oncology")
    )


# --- snapshot files to landscape ---------------------------------------------------------------


@query
def trial_landscape(spark, sf_dir):
    return _landscape(spark, sf_dir)


@query
def typed_studies(spark, sf_dir):
    return trials.typed_studies(adapters.studies(spark, sf_dir))


@query
def lead_sponsors(spark, sf_dir):
    return trials.lead_sponsors(adapters.sponsors(spark, sf_dir))


@query
def classified_terms(spark, sf_dir):
    return trials.classified_terms(adapters.conditions(spark, sf_dir))


@query
def primary_area(spark, sf_dir):
    return trials.primary_area(adapters.conditions(spark, sf_dir))


@query
def primary_area_ranked(spark, sf_dir):
    return trials.primary_area_ranked(adapters.conditions(spark, sf_dir))


@query
def enriched_trials(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query
def stg_trials(spark, sf_dir):
    return staging.stg_trials(_enriched(spark, sf_dir))


@query
def completion_by_phase(spark, sf_dir):
    by_phase = marts.completion_by_phase(_landscape(spark, sf_dir))
    return by_phase.withColumn("completion_rate", F.round("completion_rate", 6))


@query
def delimited_studies(spark, sf_dir):
    """Studies written as quoted pipe-delimited text, read back and typed."""
    path = scratch_path(spark, "delimited")
    _write_delimited(adapters.studies(spark, sf_dir), path)
    return trials.typed_studies(read_delimited(spark, path))


@query
def delimited_studies_split(spark, sf_dir):
    """The same text, read in splits that may begin inside a field."""
    path = scratch_path(spark, "delimited")
    _write_delimited(adapters.studies(spark, sf_dir), path)
    return trials.typed_studies(read_delimited_split(spark, path))


@query
def landed_conditions(spark, sf_dir):
    """Condition text landed once as parquet, then classified from there."""
    text, landed = scratch_path(spark, "conditions-text"), scratch_path(spark, "conditions")
    _write_delimited(adapters.conditions(spark, sf_dir), text)
    land(read_delimited(spark, text), landed)
    return trials.primary_area(spark.read.parquet(landed))


@query
def monthly_run(spark, sf_dir):
    """The whole batch from text files to the stored mart; the asked-for snapshot is missing."""
    snapshots, warehouse = scratch_path(spark, "snapshots"), scratch_path(spark, "warehouse")
    inputs = dict(zip(FILES, adapters.batch_inputs(spark, sf_dir), strict=True))
    for name, df in inputs.items():
        _write_delimited(df, f"{snapshots}/snapshot_date={FALLBACK_SNAPSHOT}/{FILES[name]}")
    run_monthly(spark, snapshots, warehouse, snapshot_date="1999-01-01")
    return read_landscape(spark, f"{warehouse}/mart_trial_landscape")


def _write_delimited(df: DataFrame, path: str) -> None:
    (
        df.write.option("sep", "|")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


# --- stored tables and views -------------------------------------------------------------------


@query
def stored_trials(spark, sf_dir):
    path = scratch_path(spark, "trials")
    write_trials(_enriched(spark, sf_dir), path)
    return read_trials(spark, path)


@query
def load_row_count(spark, sf_dir):
    """The rows of the committed table."""
    path = scratch_path(spark, "trials")
    write_trials(_enriched(spark, sf_dir), path)
    return read_trials(spark, path).agg(F.count("*").alias("rows_written"))


@query
def years_of_area(spark, sf_dir):
    """One area over a range of years, from the stored table's folders."""
    path = scratch_path(spark, "trials")
    write_trials(_enriched(spark, sf_dir), path)
    return report.years_of_area(read_trials(spark, path), 2009, 2011, "Oncology")


@query
def stored_landscape(spark, sf_dir):
    path = scratch_path(spark, "landscape")
    write_landscape(_landscape(spark, sf_dir), path)
    return read_landscape(spark, path)


@query
def stored_trends(spark, sf_dir):
    path = scratch_path(spark, "trends")
    write_trends(_trends(spark, sf_dir), path)
    return marts.newest_first(read_trends(spark, path))


@query
def views_sql(spark, sf_dir):
    """Ad-hoc SQL over the registered views."""
    warehouse = scratch_path(spark, "warehouse")
    write_trials(_enriched(spark, sf_dir), f"{warehouse}/trials")
    stored = staging.stg_trials(read_trials(spark, f"{warehouse}/trials"))
    write_landscape(marts.trial_landscape(stored), f"{warehouse}/mart_trial_landscape")
    register_views(spark, warehouse)
    return spark.sql(
        """
        SELECT s.status_category, count(*) AS trials, sum(s.phase_numeric) AS phase_sum
        FROM stg_trials s
        WHERE s.start_year IN (SELECT start_year FROM mart_trial_landscape)
        GROUP BY s.status_category
        """
    )


@query
def activity_views_sql(spark, sf_dir):
    """Ad-hoc SQL over the three views of the daily activity."""
    warehouse = scratch_path(spark, "warehouse")
    write_trials(_enriched(spark, sf_dir), f"{warehouse}/trials")
    stored = staging.stg_trials(read_trials(spark, f"{warehouse}/trials"))
    write_landscape(marts.trial_landscape(stored), f"{warehouse}/mart_trial_landscape")
    append_activity(_activity(spark, sf_dir), f"{warehouse}/daily_activity")
    refresh_trends(spark, warehouse)
    register_views(spark, warehouse, read_daily_activity(spark, f"{warehouse}/daily_activity"))
    return spark.sql(
        """
        SELECT m.therapeutic_area, m.activity_date, m.daily_updates, s.update_count,
               d.completed_count
        FROM mart_activity_trends m
        JOIN stg_daily_activity s USING (therapeutic_area, activity_date)
        JOIN daily_activity d
          ON d.therapeutic_area = m.therapeutic_area AND to_date(d.window_start) = m.activity_date
        """
    )


@query
def normalized_statuses(spark, sf_dir):
    """Statuses and types in capitals, matched without regard to case."""
    capitals = adapters.studies(spark, sf_dir).select(
        "*", F.upper("overall_status").alias("s"), F.upper("study_type").alias("t")
    ).drop("overall_status", "study_type").withColumnsRenamed({"s": "overall_status", "t": "study_type"})
    others = adapters.batch_inputs(spark, sf_dir)[1:]
    staged = staging.stg_trials(trials.enrich_trials(capitals, *others, normalize=True), normalize=True)
    return staged.groupBy("status_category", "is_completed", "is_interventional").agg(
        F.count("*").alias("trials")
    )


# --- updates to trends -------------------------------------------------------------------------


@query
def flattened_pages(spark, sf_dir):
    return flatten_pages(adapters.pages(spark, sf_dir))


@query
def flattened_pages_nulls(spark, sf_dir):
    """The same studies with their missing fields there as null, which is kept."""
    return flatten_pages(adapters.pages(spark, sf_dir, nulls=True), keep_nulls=True)


@query
def pages_activity(spark, sf_dir):
    return activity_of_pages(adapters.pages(spark, sf_dir))


@query
def condition_list_area(spark, sf_dir):
    return adapters.condition_lists(spark, sf_dir).select(
        "nct_id", conditions_area(F.col("conditions")).alias("therapeutic_area")
    )


@query
def condition_rows_area(spark, sf_dir):
    return conditions_area_by_key(
        adapters.condition_rows(spark, sf_dir), "nct_id", "position", "condition"
    )


@query
def document_areas(spark, sf_dir):
    """Rules over whole texts; where the first piece of a word stands decides nothing."""
    area = conditions_area(F.array("text"), adapters.TEXT_RULES)
    return adapters.table(spark, sf_dir, "documents").select("doc_id", area.alias("therapeutic_area"))


@query
def encoded_events(spark, sf_dir):
    """Events through JSON and back."""
    return good_events(decode_events(encode_events(adapters.trial_updates(spark, sf_dir))))


@query
def daily_activity(spark, sf_dir):
    return _activity(spark, sf_dir)


@query
def daily_activity_stream(spark, sf_dir):
    """Published events, aggregated by the streaming run, read from the staging area."""
    topic, stage = scratch_path(spark, "updates"), scratch_path(spark, "staging")
    publish(adapters.trial_updates(spark, sf_dir), topic)
    pulse_from_messages(spark, stage, path=topic)
    return staged_activity(spark, stage)


@query
def quarantined_stream(spark, sf_dir):
    """Every third message is cut short: those are kept aside, the others aggregated, the queue read once."""
    topic, stage = scratch_path(spark, "updates"), scratch_path(spark, "staging")
    bad = scratch_path(spark, "quarantine")
    messages = encode_events(adapters.trial_updates(spark, sf_dir))
    number = F.substring(F.get_json_object("value", "$.nct_id"), 4, 20).cast("long")
    cut = F.when(number % 3 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    messages.select(cut.alias("value")).write.text(topic)
    pulse_from_messages(spark, stage, bad, path=topic)
    aside = spark.read.parquet(f"{bad}/messages").count()
    return staged_activity(spark, stage).withColumn("set_aside", F.lit(aside).cast("long"))


@query
def late_events_stream(spark, sf_dir):
    """A second run of the stream brings events of all days: closed days drop theirs."""
    topic, stage = scratch_path(spark, "updates"), scratch_path(spark, "staging")
    updates = adapters.trial_updates(spark, sf_dir, (F.col("event_id") % 2).alias("run"))
    for run in (0, 1):
        publish(updates.filter(F.col("run") == run).drop("run"), topic)
        pulse_from_messages(spark, stage, path=topic)
    return staged_activity(spark, stage)


@query
def stg_daily_activity(spark, sf_dir):
    return staging.stg_daily_activity(_activity(spark, sf_dir))


@query
def activity_trends(spark, sf_dir):
    return marts.newest_first(_trends(spark, sf_dir))


@query
def enrollment_by_month(spark, sf_dir):
    """Rounded, as sums of fractions depend on their order."""
    means = marts.enrollment_by_month(staging.stg_daily_activity(_activity(spark, sf_dir)))
    return means.withColumns({c: F.round(c, 6) for c in ("avg_enrollment", "weighted_enrollment")})


@query
def sync_skip_date(spark, sf_dir):
    """Staged days merged into a history that has some of them: known days stay as they are."""
    return _synced(spark, sf_dir, "skip_date")


@query
def sync_upsert(spark, sf_dir):
    """The same, but late areas of known days are kept."""
    return _synced(spark, sf_dir, "upsert")


@query
def sync_repeated_upserts(spark, sf_dir):
    """Six upserts of the same days: first smaller totals, then all, then a correction of even days."""
    stage, history = scratch_path(spark, "staging"), scratch_path(spark, "history")
    activity = _activity(spark, sf_dir)

    def with_updates(more):
        return activity.withColumn("update_count", F.col("update_count") + more)

    corrected = with_updates(1).filter(F.dayofmonth("window_start") % 2 == 0)
    for batch, rows in enumerate([*(with_updates(less) for less in (-4, -3, -2, -1)), activity, corrected]):
        write_changes(rows, stage, batch)
        sync_new_dates(spark, stage, history, "upsert")
    return read_daily_activity(spark, history)


@query
def merge_duplicate_versions(spark, sf_dir):
    """Two staged versions of some windows: the one with more updates counts."""
    history = scratch_path(spark, "history")
    activity = _activity(spark, sf_dir)
    older = activity.filter("therapeutic_area = 'Oncology'").withColumns(
        {"update_count": F.col("update_count") - 1, "completed_count": F.lit(0).cast("long")}
    )
    merge_activity(spark, older.unionByName(activity), history)
    return read_daily_activity(spark, history)


@query
def sync_report(spark, sf_dir):
    return merge.sync_report(_activity(spark, sf_dir), _known_activity(spark, sf_dir))


@query
def sync_steps(spark, sf_dir):
    """The history after a sync with nothing staged, one with rows and one with nothing new."""
    stage, history = scratch_path(spark, "staging"), scratch_path(spark, "history")
    after = []
    for batch in (None, 0, 1):
        if batch is not None:
            write_changes(_activity(spark, sf_dir), stage, batch)
        status = sync_new_dates(spark, stage, history).status
        rows = read_daily_activity(spark, history).agg(F.count("*").alias("rows"))
        after.append(rows.select(F.lit(status).alias("status"), "rows"))
    return after[0].unionAll(after[1]).unionAll(after[2])


def _synced(spark, sf_dir, mode):
    stage, history = scratch_path(spark, "staging"), scratch_path(spark, "history")
    append_activity(_known_activity(spark, sf_dir), history)
    write_changes(_activity(spark, sf_dir), stage, 0)
    sync_new_dates(spark, stage, history, mode)
    return read_daily_activity(spark, history)


@query
def new_day_rows(spark, sf_dir):
    return merge.new_days(_activity(spark, sf_dir), _known_activity(spark, sf_dir))


@query
def known_day_rows(spark, sf_dir):
    return merge.known_days(_activity(spark, sf_dir), _known_activity(spark, sf_dir))


@query
def skipped_days(spark, sf_dir):
    return merge.skipped_days(_activity(spark, sf_dir), _known_activity(spark, sf_dir))


@query
def backfill(spark, sf_dir):
    """The last 14 days merged over a history that holds older ones."""
    stage, history = scratch_path(spark, "staging"), scratch_path(spark, "history")
    append_activity(_known_activity(spark, sf_dir), history)
    activity = _activity(spark, sf_dir).withColumn("activity_date", F.to_date("window_start"))
    days = series.last_days(spark, AS_OF)
    write_changes(activity.join(days, "activity_date", "left_semi"), stage, 0)
    sync_new_dates(spark, stage, history)
    return read_daily_activity(spark, history)


@query
def backfill_run(spark, sf_dir):
    """A whole month from landed pages to the stored trends, twice: the second run adds nothing."""
    landed, warehouse = scratch_path(spark, "pages"), scratch_path(spark, "warehouse")
    adapters.update_pages(spark, sf_dir).write.partitionBy("event_date").text(landed)
    for _ in range(2):
        run_backfill(
            spark, landed, warehouse, *report.month_to_date(AS_OF), mode="skip_date", per_line=True
        )
    return read_trends(spark, f"{warehouse}/mart_activity_trends")


@query
def backfill_days(spark, sf_dir):
    """The days of a backfill, each with the schedule date's yesterday and its updates."""
    updates = _trends(spark, sf_dir).groupBy("activity_date").agg(
        F.sum("daily_updates").alias("updates")
    )
    return (
        series.last_days(spark, AS_OF)
        .join(updates, "activity_date", "left")
        .select(
            "activity_date",
            yesterday(F.col("activity_date")).alias("fetched_date"),
            F.coalesce("updates", F.lit(0)).alias("updates"),
        )
    )


# --- checks ------------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    """All checks; updates without an area make one of them fail."""
    return quality.run_checks(
        _enriched(spark, sf_dir), quality.TRIAL_CHECKS, "trials"
    ).unionByName(
        quality.run_checks(_activity(spark, sf_dir), quality.ACTIVITY_CHECKS, "daily_activity")
    )


@query
def duplicate_ids(spark, sf_dir):
    """Failing values of the uniqueness check, on a table with many rows per trial."""
    return quality.failing_values(
        adapters.conditions(spark, sf_dir), quality.Check("unique", "nct_id")
    )


@query
def unaccepted_statuses(spark, sf_dir):
    check = quality.Check("accepted_values", "overall_status", ("Completed", "Recruiting"))
    return quality.failing_values(adapters.studies(spark, sf_dir), check)


# --- report ------------------------------------------------------------------------------------


@query
def area_counts(spark, sf_dir):
    return report.area_counts(_enriched(spark, sf_dir))


@query
def area_years_top20(spark, sf_dir):
    return report.area_years(_landscape(spark, sf_dir))


@query
def daily_totals(spark, sf_dir):
    return report.daily_totals(_trends(spark, sf_dir))


@query
def tile1_area_by_phase(spark, sf_dir):
    return report.area_by_phase(report.landscape_selection(_landscape(spark, sf_dir)))


@query
def tile1_pivot(spark, sf_dir):
    return report.area_by_phase_pivot(report.landscape_selection(_landscape(spark, sf_dir)))


@query
def tile1_selected(spark, sf_dir):
    """Tile 1 with both controls set."""
    selection = report.landscape_selection(
        _landscape(spark, sf_dir), start_year=2012, sponsor="MACHINERY"
    )
    return report.area_by_phase(selection)


@query
def tile1_year_control(spark, sf_dir):
    return report.year_control(_landscape(spark, sf_dir))


@query
def tile1_sponsor_control(spark, sf_dir):
    return report.sponsor_control(_landscape(spark, sf_dir))


@query
def labelled_landscape(spark, sf_dir):
    return report.relabel(_landscape(spark, sf_dir), report.LANDSCAPE_LABELS)


@query
def labelled_trends(spark, sf_dir):
    return report.relabel(_trends(spark, sf_dir), report.TRENDS_LABELS)


@query
def tile2_by_area(spark, sf_dir):
    return report.updates_by_day_and_area(_trends(spark, sf_dir), *report.month_to_date(AS_OF))


@query
def tile2_lines(spark, sf_dir):
    """Leading areas, Others and zero-filled days. There are four areas, so two are shown."""
    return report.activity_lines(_trends(spark, sf_dir), *report.month_to_date(AS_OF), shown=2)
