"""Updates to trends: pages, events, streaming runs, history, backfill."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from trialweave import schemas
from trialweave.operators import merge
from trialweave.operators.pulse import daily_pulse
from trialweave.plans import daily, marts, staging
from trialweave.session import configure
from trialweave.sinks import jdbc
from trialweave.sinks.messages import encode_events, publish
from trialweave.sources import events, pages, tables
from trialweave.streaming import history, pulse_stream
from trialweave.streaming import staging as stage_area


def study(nct_id="NCT1", status="RECRUITING", phases=("PHASE3",), count=10, conditions=("Stroke",),
          sponsor="INDUSTRY", name="Acme"):
    return {"protocolSection": {
        "identificationModule": {"nctId": nct_id, "briefTitle": "ignored"},
        "statusModule": {"overallStatus": status},
        "designModule": {"phases": list(phases), "enrollmentInfo": {"count": count, "type": "x"}},
        "conditionsModule": {"conditions": list(conditions)},
        "sponsorCollaboratorsModule": {"leadSponsor": {"name": name, "class": sponsor}}}}


def land_page(root: Path, day: str, name: str, *studies, token=None):
    folder = root / f"event_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    body = {"studies": list(studies)}
    if token:
        body["nextPageToken"] = token
    (folder / f"{name}.json").write_text(json.dumps(body, indent=1))


def event(day, area="Oncology", enrollment=10, sponsor="INDUSTRY", status="COMPLETED", nct_id="N"):
    return (nct_id, status, "PHASE1", area, sponsor, enrollment, day, "S")


def event_frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TRIAL_UPDATE)


def rows_of(df):
    """(day, area, updates, industry, mean enrollment, completed)"""
    return sorted(((r.window_start.date().isoformat(), r.therapeutic_area, r.update_count,
                    r.industry_sponsored, r.avg_enrollment, r.completed_count)
                   for r in df.collect()), key=repr)


def activity(spark, *rows):
    """Activity rows from (day, area, updates) or (day, area, updates, mean)."""
    data = []
    for day, area, n, *mean in rows:
        start = dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc)
        data.append((start, start + dt.timedelta(days=1), area, n, n, *(mean or [1.0]), 0))
    return spark.createDataFrame(data, schemas.DAILY_ACTIVITY)


def counts(df):
    return sorted(((r.window_start.date().isoformat(), r.therapeutic_area, r.update_count)
                   for r in df.collect()), key=repr)


# --- pages -------------------------------------------------------------------------------------


def test_flatten_fills_missing_fields(spark, tmp_path):
    land_page(tmp_path, "2024-01-05", "p1", {"protocolSection": {}}, study(phases=(), count=None),
              study("NCT2", phases=("PHASE1", "PHASE2"), conditions=("Lung", "Disease X")),
              token="t")
    land_page(tmp_path, "2024-01-05", "p2", study("NCT3", conditions=()))
    land_page(tmp_path, "2024-01-05", "p3")
    got = sorted(map(tuple, pages.flatten_pages(pages.read_pages(spark, str(tmp_path))).collect()))
    day = "2024-01-05"
    assert got == [
        ("", "UNKNOWN", "N/A", "Other", "Other", 0, day, ""),
        ("NCT1", "RECRUITING", "N/A", "Cardiovascular", "INDUSTRY", 0, day, "Acme"),
        ("NCT2", "RECRUITING", "PHASE1", "Respiratory", "INDUSTRY", 10, day, "Acme"),
        ("NCT3", "RECRUITING", "PHASE3", "Other", "INDUSTRY", 10, day, "Acme"),
    ]


def test_present_nulls_stay_null_if_asked(spark, tmp_path):
    nothing = {"protocolSection": {
        "identificationModule": {"nctId": None}, "statusModule": {"overallStatus": None},
        "designModule": {"phases": [None, "PHASE2"], "enrollmentInfo": {"count": None}},
        "conditionsModule": {"conditions": None},
        "sponsorCollaboratorsModule": {"leadSponsor": {"name": None, "class": None}}}}
    sections = {"protocolSection": dict.fromkeys(nothing["protocolSection"])}
    land_page(tmp_path, "2024-01-05", "p1", nothing, sections, {"protocolSection": {}}, {"protocolSection": None},
              study(phases=(), count=None), study("NCT2", phases=("PHASE1",), name=None))
    land_page(tmp_path, "2024-01-05", "p2")
    df = pages.read_pages(spark, str(tmp_path))
    missing = ("", "UNKNOWN", "N/A", "Other", "Other", 0, "2024-01-05", "")
    rest = [("NCT1", "RECRUITING", "N/A", "Cardiovascular", "INDUSTRY", 0, "2024-01-05", "Acme")]
    second = ("NCT2", "RECRUITING", "PHASE1", "Cardiovascular", "INDUSTRY", 10, "2024-01-05")
    kept = sorted(map(tuple, pages.flatten_pages(df, keep_nulls=True).collect()), key=repr)
    assert kept == sorted([
        (None, None, None, "Other", None, 0, "2024-01-05", None), *[missing] * 3, *rest, (*second, None)], key=repr)
    filled = sorted(map(tuple, pages.flatten_pages(df).collect()), key=repr)
    assert filled == sorted([*[missing] * 4, *rest, (*second, "")], key=repr)


def test_pages_with_nulls_go_through_a_daily_run(spark, tmp_path):
    configure(spark)
    land_page(tmp_path / "pages", "2024-01-02", "p", study(status=None), study(status="COMPLETED", sponsor=None))
    wh = str(tmp_path / "wh")
    assert daily.run_daily(spark, str(tmp_path / "pages"), wh, "2024-01-02", keep_nulls=True).status == "appended"
    assert rows_of(history.read_daily_activity(spark, f"{wh}/daily_activity")) == [
        ("2024-01-02", "Cardiovascular", 2, 1, 10.0, 1)]


def test_pages_are_pruned_by_day(spark, tmp_path):
    for day in ("2024-01-04", "2024-01-05", "2024-01-06"):
        land_page(tmp_path, day, "p", study(day))
    df = pages.flatten_pages(pages.read_pages(spark, str(tmp_path), "2024-01-05", "2024-01-05"))
    assert [r.nct_id for r in df.collect()] == ["2024-01-05"]
    assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().toString()


def test_pages_stored_one_per_line(spark, tmp_path):
    folder = tmp_path / "event_date=2024-01-05"
    folder.mkdir()
    bodies = [{"studies": [study(f"N{i}"), study(f"M{i}")]} for i in range(3)]
    (folder / "pages.jsonl").write_text("".join(json.dumps(b) + "\n" for b in bodies))
    df = pages.flatten_pages(pages.read_pages(spark, str(tmp_path), per_line=True))
    assert sorted(r.nct_id for r in df.collect()) == ["M0", "M1", "M2", "N0", "N1", "N2"]


def test_page_that_is_not_json_fails(spark, tmp_path):
    land_page(tmp_path, "2024-01-05", "p", study())
    (tmp_path / "event_date=2024-01-05" / "bad.json").write_text('{"studies": [{"protocol')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        pages.flatten_pages(pages.read_pages(spark, str(tmp_path))).collect()


# --- events ------------------------------------------------------------------------------------


def test_events_survive_json(spark):
    df = event_frame(spark, event("2024-01-05"), event("2024-01-05", area=None, enrollment=None))
    messages = encode_events(df)
    assert '"therapeutic_area":null' in [r.value for r in messages.collect()][1]
    back = events.good_events(events.decode_events(messages))
    assert sorted(map(str, back.drop("event_time").collect())) == sorted(map(str, df.collect()))


def test_bad_messages_are_set_aside(spark):
    messages = spark.createDataFrame([('{"nct_id": "A", "event_date": "2024-01-05"}',),
                                      ("{oops",), ("",)], "value string")
    decoded = events.decode_events(messages)
    assert [r.nct_id for r in events.good_events(decoded).collect() if r.nct_id] == ["A"]
    assert [r.value for r in events.quarantined(decoded).collect()] == ["{oops"]


def test_messages_are_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    events_read = events.good_events(events.decode_events(messages)).filter("event_time is not null")
    assert events_read._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_publish_nothing(spark, tmp_path):
    assert not publish(event_frame(spark).limit(0), str(tmp_path / "topic"))
    assert not (tmp_path / "topic").exists()


def test_daily_pulse(spark):
    df = event_frame(spark, event("2024-01-05", enrollment=0), event("2024-01-05"),
                     event("2024-01-05", sponsor=None, status=None, enrollment=None),
                     event("2024-01-06", area=None), event("nonsense"), event(None))
    pulse = daily_pulse(df.withColumn("event_time", F.try_to_timestamp("event_date")))
    assert rows_of(pulse) == [("2024-01-05", "Oncology", 3, 2, 5.0, 2),
                              ("2024-01-06", None, 1, 1, 10.0, 1)]


# --- streaming runs ----------------------------------------------------------------------------


def run(spark, tmp_path, *rows):
    """Publish rows, run the stream on them, return the query."""
    if rows:
        publish(event_frame(spark, *rows), str(tmp_path / "topic"))
    return pulse_stream.pulse_from_messages(
        spark, str(tmp_path / "stage"), str(tmp_path / "bad"), path=str(tmp_path / "topic"))


def test_stream_continues_where_it_stopped(spark, tmp_path):
    stage = str(tmp_path / "stage")
    run(spark, tmp_path, event("2024-01-05"), event("2024-01-06"))
    first = [("2024-01-05", "Oncology", 1), ("2024-01-06", "Oncology", 1)]
    # The newest day is there although no later event has closed it.
    assert counts(stage_area.staged_activity(spark, stage)) == first
    run(spark, tmp_path)
    assert counts(stage_area.staged_activity(spark, stage)) == first
    # A day behind the newest is still open; its row is replaced by complete totals.
    query = run(spark, tmp_path, event("2024-01-05"), event("2024-01-07", area="Psychiatry"))
    assert counts(stage_area.staged_activity(spark, stage)) == [
        ("2024-01-05", "Oncology", 2), ("2024-01-06", "Oncology", 1),
        ("2024-01-07", "Psychiatry", 1)]
    assert pulse_stream.dropped_late(query) == 0
    # Two days behind is closed.
    query = run(spark, tmp_path, event("2024-01-04"))
    assert pulse_stream.dropped_late(query) == 1
    assert len(counts(stage_area.staged_activity(spark, stage))) == 3


def test_stream_sets_bad_messages_aside(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "extra.txt").write_text('{"nct_id"\n{"event_date": "never"}\n')
    run(spark, tmp_path, event("2024-01-05"))
    run(spark, tmp_path)
    staged = stage_area.staged_activity(spark, str(tmp_path / "stage"))
    assert counts(staged) == [("2024-01-05", "Oncology", 1)]
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/bad/messages").collect()] == [
        '{"nct_id"']


def _queue(spark, tmp_path, **more):
    """Three good messages and two bad ones, and how they are read."""
    topic = tmp_path / "topic"
    topic.mkdir()
    rows = [event("2024-01-05"), event("2024-01-05"), event("2024-01-06", area="Asthma")]
    good = [r.value for r in encode_events(event_frame(spark, *rows)).collect()]
    (topic / "1.txt").write_text("\n".join([good[0], "{bad", good[1], good[2], '{"worse']) + "\n")
    return lambda: pulse_stream.pulse_from_messages(
        spark, str(tmp_path / "stage"), str(tmp_path / "bad"), path=str(topic), state_partitions=2, **more)


_ASIDE = ['{"worse', "{bad"]
_COUNTED = [("2024-01-05", "Oncology", 2), ("2024-01-06", "Asthma", 1)]


def _outcome(spark, tmp_path):
    aside = sorted(r.value for r in spark.read.parquet(f"{tmp_path}/bad/messages").collect())
    return aside, counts(stage_area.staged_activity(spark, str(tmp_path / "stage")))


def test_messages_are_read_once_for_both_outcomes(spark, tmp_path, monkeypatch):
    reads, intake = [], pulse_stream.run_intake

    def seen(*args):
        query = intake(*args)
        reads.append(sum(p.numInputRows for p in query.recentProgress))
        return query

    monkeypatch.setattr(pulse_stream, "run_intake", seen)
    run_all = _queue(spark, tmp_path)
    query = run_all()
    assert reads == [5] and sum(p.numInputRows for p in query.recentProgress) == 3
    sources = {s.description for p in query.recentProgress for s in p.sources}
    assert all("/stage/events" in s for s in sources)
    assert _outcome(spark, tmp_path) == (_ASIDE, _COUNTED)
    run_all()
    assert reads == [5, 0] and _outcome(spark, tmp_path) == (_ASIDE, _COUNTED)


@pytest.mark.parametrize("step", ["quarantined", "daily_pulse", "write_changes"])
def test_intake_that_dies_is_replayed(spark, tmp_path, monkeypatch, step):
    """Whatever step fails, a repeated run keeps every message once."""
    run_all = _queue(spark, tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(pulse_stream, step, lambda *args: 1 / 0)
        with pytest.raises(Exception):
            run_all()
    run_all()
    assert _outcome(spark, tmp_path) == (_ASIDE, _COUNTED)


def test_an_empty_queue_stages_nothing(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    pulse_stream.pulse_from_messages(
        spark, str(tmp_path / "stage"), str(tmp_path / "bad"), path=str(tmp_path / "topic"), state_partitions=2)
    assert counts(stage_area.staged_activity(spark, str(tmp_path / "stage"))) == []


def test_replayed_batch_changes_nothing(spark, tmp_path):
    stage, df = str(tmp_path), activity(spark, ("2024-01-05", "Oncology", 3))
    for _ in range(2):
        stage_area.write_changes(df, stage, 0)
    assert counts(stage_area.staged_activity(spark, stage)) == [("2024-01-05", "Oncology", 3)]
    newer = activity(spark, ("2024-01-05", "Oncology", 4), ("2024-01-05", None, 1))
    stage_area.write_changes(newer, stage, 1)
    assert counts(stage_area.staged_activity(spark, stage)) == [
        ("2024-01-05", "Oncology", 4), ("2024-01-05", None, 1)]


def test_own_writer_replaces_the_staging_folder(spark, tmp_path):
    publish(event_frame(spark, event("2024-01-05")), str(tmp_path / "topic"))
    own = pulse_stream.streaming_session(spark, state_partitions=2)
    decoded = events.decode_events(events.read_messages(own, str(tmp_path / "topic"), streaming=True))
    seen = []
    pulse_stream.run_pulse(decoded, str(tmp_path / "s"),
                           write=lambda batch, i: seen.extend(counts(batch)))
    assert seen == [("2024-01-05", "Oncology", 1)]


# --- history -----------------------------------------------------------------------------------


def test_sync_into_nothing_then_known_days(spark, tmp_path):
    stage, target = str(tmp_path / "stage"), str(tmp_path / "history")
    assert history.sync_new_dates(spark, stage, target).status == "empty"
    stage_area.write_changes(activity(spark, ("2024-01-05", "A", 1), ("2024-01-06", "A", 2)), stage, 0)
    result = history.sync_new_dates(spark, stage, target)
    assert (result.status, result.skipped.count()) == ("appended", 0)
    assert counts(stage_area.staged_activity(spark, stage)) == []

    late = activity(spark, ("2024-01-06", "B", 5), ("2024-01-05", "A", 9))
    stage_area.write_changes(late, stage, 1)
    result = history.sync_new_dates(spark, stage, target)
    assert result.status == "nothing_new"
    assert [r[0].isoformat() for r in result.skipped.collect()] == ["2024-01-05", "2024-01-06"]
    assert history.sync_new_dates(spark, stage, target).status == "empty"
    assert counts(history.read_daily_activity(spark, target)) == [
        ("2024-01-05", "A", 1), ("2024-01-06", "A", 2)]


def test_sync_upsert_keeps_late_areas(spark, tmp_path):
    stage, target = str(tmp_path / "stage"), str(tmp_path / "history")
    stage_area.write_changes(activity(spark, ("2024-01-05", "A", 1)), stage, 0)
    history.sync_new_dates(spark, stage, target, "upsert")
    stage_area.write_changes(activity(spark, ("2024-01-05", "A", 3), ("2024-01-05", "B", 1)), stage, 1)
    history.sync_new_dates(spark, stage, target, "upsert")
    assert counts(history.read_daily_activity(spark, target)) == [
        ("2024-01-05", "A", 3), ("2024-01-05", "B", 1)]
    with pytest.raises(ValueError):
        history.sync_new_dates(spark, stage, target, "other")


def test_rows_staged_during_a_sync_stay(spark, tmp_path, monkeypatch):
    stage, target = str(tmp_path / "stage"), str(tmp_path / "history")
    stage_area.write_changes(activity(spark, ("2024-01-05", "A", 1)), stage, 0)
    append = history.append_activity

    def append_while_staging(*args):
        stage_area.write_changes(activity(spark, ("2024-01-06", "A", 1)), stage, 1)
        append(*args)

    monkeypatch.setattr(history, "append_activity", append_while_staging)
    history.sync_new_dates(spark, stage, target)
    assert counts(stage_area.staged_activity(spark, stage)) == [("2024-01-06", "A", 1)]


def test_sync_that_dies_before_clearing_is_repeated(spark, tmp_path, monkeypatch):
    stage, target = str(tmp_path / "stage"), str(tmp_path / "history")
    stage_area.write_changes(activity(spark, ("2024-01-05", "A", 1)), stage, 0)
    with monkeypatch.context() as patch:
        patch.setattr(history, "mark_synced", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.sync_new_dates(spark, stage, target)
    assert history.sync_new_dates(spark, stage, target).status == "nothing_new"
    assert counts(history.read_daily_activity(spark, target)) == [("2024-01-05", "A", 1)]


class _Database:
    """Relational tables as lists of rows: only what reads, writes and deletes is swapped."""

    def __init__(self, spark, monkeypatch):
        self.spark, self.tables, self.landing = spark, {}, []
        monkeypatch.setattr(jdbc, "append_jdbc", self.append)
        monkeypatch.setattr(jdbc, "read_jdbc", self.read)
        monkeypatch.setattr(jdbc, "delete_jdbc_batches", self.delete)
        self.write = jdbc.jdbc_writer("jdbc:x")

    def append(self, rows, url, table, **options):
        self.tables.setdefault(table, []).extend(rows.collect())

    def read(self, spark, url, table, schema, **options):
        return self.spark.createDataFrame(self.tables.get(table, []), schema)

    def delete(self, spark, url, keys, table=jdbc.TABLE, **options):
        for land in self.landing:  # what comes between reading and clearing
            land()
        self.landing = []
        for name in (jdbc.ledger_of(table), table):
            self.tables[name] = [row for row in self.tables.get(name, []) if row.batch_key not in keys]

    def stage(self, batch_id, at, *rows, entries=1, missing=0):
        """Stage a batch as of a time; without its ledger entry, or without some rows."""
        frame = activity(self.spark, *rows)
        if missing:
            frame = frame.limit(len(rows) - missing)
        before = {row.batch_key for row in self.rows}
        self.write(frame, batch_id)
        stamp = dt.datetime.fromtimestamp(at, dt.timezone.utc).replace(tzinfo=None)
        for table in (jdbc.TABLE, jdbc.ledger_of(jdbc.TABLE)):
            out = []
            for row in self.tables[table]:
                fresh = row.batch_key not in before and row.batch_id == batch_id
                row = row.asDict()
                if fresh:
                    row["staged_at"] = stamp
                    if missing and "row_count" in row:
                        row["row_count"] = len(rows)
                    if not entries and "row_count" in row:
                        continue
                out.append(Row(**row))
            self.tables[table] = out
        return [row.batch_key for row in self.rows if row.batch_key not in before][0]

    def enter(self, key, rows):
        """The ledger entry that completes a half-written batch."""
        one = next(row for row in self.rows if row.batch_key == key)
        self.tables[jdbc.ledger_of(jdbc.TABLE)].append(
            Row(batch_key=key, batch_id=one.batch_id, staged_at=one.staged_at, row_count=rows))

    @property
    def rows(self):
        return self.tables.get(jdbc.TABLE, [])


@pytest.fixture
def database(spark, monkeypatch):
    return _Database(spark, monkeypatch)


def _sync(spark, tmp_path, mode="skip_date"):
    return history.sync_relational(spark, "jdbc:x", str(tmp_path / "stage"), str(tmp_path / "history"), mode)


def _history(spark, tmp_path):
    return counts(history.read_daily_activity(spark, str(tmp_path / "history")))


def test_relational_staging_is_read_once_and_emptied(spark, tmp_path, database):
    assert _sync(spark, tmp_path).status == "empty"
    # A batch, its replay, and newer totals of a later run with the same batch number.
    old, new = ("2024-01-05", "A", 3), ("2024-01-05", "A", 9)
    for batch, at, row in ((0, 100, new), (0, 50, old), (0, 60, old), (1, 100, ("2024-01-06", "A", 1))):
        database.stage(batch, at, row)
    result = _sync(spark, tmp_path)
    assert (result.status, result.rows_read, result.rows_appended) == ("appended", 2, 2)
    assert not database.rows and not database.tables[jdbc.ledger_of(jdbc.TABLE)]
    assert _history(spark, tmp_path) == [new, ("2024-01-06", "A", 1)]
    database.stage(0, 200, ("2024-01-06", "B", 4), ("2024-01-05", "B", 4))
    result = _sync(spark, tmp_path)
    assert (result.status, result.rows_skipped, database.rows) == ("nothing_new", 2, [])
    # The report outlives the emptied table.
    assert [r[0].isoformat() for r in result.skipped.collect()] == ["2024-01-05", "2024-01-06"]
    assert _sync(spark, tmp_path).status == "empty"


def test_relational_rows_that_land_during_a_sync_stay(spark, tmp_path, database):
    """A half-written batch and one stamped earlier come between the reading and the clearing."""
    database.stage(0, 100, ("2024-01-05", "A", 1))
    half = []
    database.landing = [
        lambda: half.append(database.stage(1, 100, ("2024-01-07", "A", 2), ("2024-01-07", "B", 3), entries=0)),
        lambda: database.stage(2, 40, ("2024-01-04", "A", 4)),
    ]
    assert _sync(spark, tmp_path).rows_appended == 1
    assert len(database.rows) == 3
    # The half-written batch stays unread until its writer has entered it.
    assert _sync(spark, tmp_path).rows_appended == 1
    assert [row.batch_key for row in database.rows] == half * 2
    assert _sync(spark, tmp_path).status == "empty"
    database.enter(half[0], 2)
    assert _sync(spark, tmp_path).rows_appended == 2
    assert database.rows == []
    assert _history(spark, tmp_path) == [
        ("2024-01-04", "A", 4), ("2024-01-05", "A", 1), ("2024-01-07", "A", 2), ("2024-01-07", "B", 3)]


def test_relational_batch_with_rows_missing_waits(spark, tmp_path, database):
    database.stage(0, 10, ("2024-01-05", "A", 1), ("2024-01-05", "B", 2), missing=1)
    assert _sync(spark, tmp_path).status == "empty"
    assert len(database.rows) == 1
    late = database.rows[0].asDict() | {"therapeutic_area": "Z"}
    database.rows.append(Row(**late))
    assert _sync(spark, tmp_path).rows_appended == 2 and not database.rows


def test_relational_rows_inserted_twice_count_once(spark, tmp_path, database):
    database.stage(0, 10, ("2024-01-05", "A", 1), ("2024-01-05", None, 2))
    database.rows.append(database.rows[0])
    assert _sync(spark, tmp_path).rows_appended == 2
    assert _history(spark, tmp_path) == [("2024-01-05", "A", 1), ("2024-01-05", None, 2)]


def test_relational_sync_that_dies_before_deleting_is_repeated(spark, tmp_path, database, monkeypatch):
    database.stage(0, 10, ("2024-01-05", "A", 1))
    with monkeypatch.context() as patch:
        patch.setattr(jdbc, "delete_jdbc_batches", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            _sync(spark, tmp_path)
    assert len(database.rows) == 1
    database.stage(1, 11, ("2024-01-06", "A", 1))
    # Merged batches are not read again, only deleted.
    assert _sync(spark, tmp_path).rows_read == 1
    assert database.rows == [] and not (tmp_path / "stage" / "merged").exists()
    assert _history(spark, tmp_path) == [("2024-01-05", "A", 1), ("2024-01-06", "A", 1)]


def test_relational_totals_that_come_late_replace_no_newer_ones(spark, tmp_path, database):
    database.stage(0, 100, ("2024-01-05", "A", 9))
    _sync(spark, tmp_path, "upsert")
    database.stage(0, 50, ("2024-01-05", "A", 3), ("2024-01-05", "B", 1))
    assert _sync(spark, tmp_path, "upsert").status == "appended"
    assert _history(spark, tmp_path) == [("2024-01-05", "A", 9), ("2024-01-05", "B", 1)]
    database.stage(0, 200, ("2024-01-05", "A", 8))
    _sync(spark, tmp_path, "upsert")
    assert _history(spark, tmp_path) == [("2024-01-05", "A", 8), ("2024-01-05", "B", 1)]


def test_relational_batch_without_rows_is_cleared(spark, tmp_path, database):
    database.write(activity(spark, ("2024-01-05", "A", 1)).limit(0), 3)
    assert [row.row_count for row in database.tables[jdbc.ledger_of(jdbc.TABLE)]] == [0]
    assert _sync(spark, tmp_path).status == "empty"
    assert not database.tables[jdbc.ledger_of(jdbc.TABLE)]


def test_relational_writer_that_died_leaves_an_unfinished_batch(spark, tmp_path, database):
    died = database.stage(0, 10, ("2024-01-05", "A", 1), entries=0)
    database.stage(0, 20, ("2024-01-05", "A", 1))
    staged = database.read(spark, "", jdbc.TABLE, jdbc.STAGED)
    ledger = database.read(spark, "", jdbc.ledger_of(jdbc.TABLE), jdbc.LEDGER)
    at = lambda s: dt.datetime.fromtimestamp(s, dt.timezone.utc)
    assert jdbc.unfinished_batches(staged, ledger, at(10)).collect() == []
    assert [r[0] for r in jdbc.unfinished_batches(staged, ledger, at(30)).collect()] == [died]
    _sync(spark, tmp_path)
    assert [row.batch_key for row in database.rows] == [died]


def test_relational_stream_goes_through_the_ledger(spark, tmp_path, database):
    source = str(tmp_path / "queue")
    publish(event_frame(spark, event("2024-01-05"), event("2024-01-06", area="Asthma")), source)
    pulse_stream.pulse_from_messages(spark, str(tmp_path / "run"), write=database.write, path=source)
    assert {row.row_count for row in database.tables[jdbc.ledger_of(jdbc.TABLE)]} <= {0, 2}
    assert _sync(spark, tmp_path).rows_appended == 2 and not database.rows
    assert _history(spark, tmp_path) == [("2024-01-05", "Oncology", 1), ("2024-01-06", "Asthma", 1)]


# --- months of the history ---------------------------------------------------------------------


def test_files_of_the_history_do_not_grow_with_upserts(spark, tmp_path):
    days = ["2024-01-05", "2024-01-06", "2024-02-01", "2024-03-31"]
    target = str(tmp_path)
    for n in range(8):
        rows = [(day, area, n) for day in days for area in "AB"] + [(days[0], f"late {n}", 1)]
        history.merge_activity(spark, activity(spark, *rows), target, "upsert")
    files = set(tmp_path.rglob("*.parquet"))
    assert len(files) == 6 and not list(tmp_path.glob("_incoming*"))
    now = history.read_daily_activity(spark, target)
    assert len(now.inputFiles()) == 3
    assert counts(now) == sorted(
        [(d, a, 7) for d in days for a in "AB"] + [(days[0], f"late {n}", 1) for n in range(8)])
    # A load of one month leaves the files of the others alone.
    others = {f for f in files if "=2024-01" not in str(f)}
    history.append_activity(activity(spark, (days[0], "C", 1)), target)
    assert others == {f for f in tmp_path.rglob("*.parquet") if "=2024-01" not in str(f)}


def test_load_that_is_cut_short_leaves_whole_months(spark, tmp_path, monkeypatch):
    days = [f"2024-0{m}-01" for m in range(1, 5)]
    target = str(tmp_path)
    load = lambda n: history.append_activity(
        activity(spark, *[(day, area, n) for day in days for area in "AB"]), target)
    load(1)
    move, moved = history.move_folder, []

    def dies(*args):
        moved.append(args)
        if len(moved) == 3:
            raise OSError("lost")
        move(*args)

    with monkeypatch.context() as patch:
        patch.setattr(history, "move_folder", dies)
        with pytest.raises(OSError):
            load(2)
    got = counts(history.read_daily_activity(spark, target))
    assert got == sorted((day, area, 2 if i < 2 else 1) for i, day in enumerate(days) for area in "AB")
    load(2)
    assert counts(history.read_daily_activity(spark, target)) == [(day, area, 2) for day in days for area in "AB"]


def test_of_two_loads_of_one_month_none_is_lost(spark, tmp_path, monkeypatch):
    """The second to finish finds its number taken, fails, and can be repeated."""
    target = str(tmp_path)
    history.append_activity(activity(spark, ("2024-01-05", "A", 1)), target)
    move, others = history.move_folder, [("2024-01-07", "C", 3)]

    def overtaken(*args):
        if others:
            history.append_activity(activity(spark, others.pop()), target)
        move(*args)

    with monkeypatch.context() as patch:
        patch.setattr(history, "move_folder", overtaken)
        with pytest.raises(OSError):
            history.append_activity(activity(spark, ("2024-01-06", "B", 2)), target)
    history.append_activity(activity(spark, ("2024-01-06", "B", 2)), target)
    assert counts(history.read_daily_activity(spark, target)) == [
        ("2024-01-05", "A", 1), ("2024-01-06", "B", 2), ("2024-01-07", "C", 3)]


def test_reader_that_has_begun_outlives_a_load(spark, tmp_path):
    target = str(tmp_path)
    history.append_activity(activity(spark, ("2024-01-05", "A", 1)), target)
    begun = history.read_daily_activity(spark, target)
    history.append_activity(activity(spark, ("2024-01-05", "A", 2)), target)
    assert counts(begun) == [("2024-01-05", "A", 1)]
    assert counts(history.read_daily_activity(spark, target)) == [("2024-01-05", "A", 2)]


def test_rows_without_a_window_have_a_month_of_their_own(spark, tmp_path):
    nowhere = activity(spark, ("2024-01-05", "A", 1)).withColumn("window_start", F.lit(None).cast("timestamp"))
    for n in (1, 2):
        rows = nowhere.withColumn("update_count", F.lit(n).cast("long"))
        history.append_activity(rows.unionByName(activity(spark, ("2024-01-05", "A", n))), str(tmp_path))
    rows = history.read_daily_activity(spark, str(tmp_path)).collect()
    assert sorted((r.window_start is None, r.update_count) for r in rows) == [(False, 2), (True, 2)]


def test_two_rows_of_one_window_give_one_result(spark, tmp_path):
    rows = [("2024-01-05", "A", 3), ("2024-01-05", "A", 9), ("2024-01-05", None, 1)]
    for i, order in enumerate((rows, rows[::-1])):
        target = str(tmp_path / str(i))
        history.merge_activity(spark, activity(spark, *order), target)
        assert counts(history.read_daily_activity(spark, target)) == [
            ("2024-01-05", "A", 9), ("2024-01-05", None, 1)]


def test_rows_of_a_day_share_a_file(spark, tmp_path):
    days = [f"2024-01-{d:02d}" for d in range(1, 20)]
    df = activity(spark, *[(day, area, 1) for day in days for area in "ABCDE"])
    history.append_activity(df.repartition(8), str(tmp_path))
    files = spark.read.parquet(str(tmp_path)).groupBy("window_start").agg(
        F.countDistinct("_metadata.file_path").alias("files"))
    assert {r.files for r in files.collect()} == {1}


def test_semi_and_anti_rows(spark):
    staged = activity(spark, ("2024-01-05", "A", 1), ("2024-01-06", "A", 2), ("2024-01-06", None, 1))
    target = activity(spark, ("2024-01-06", "Z", 9))
    assert counts(merge.new_days(staged, target)) == [("2024-01-05", "A", 1)]
    assert counts(merge.known_days(staged, target)) == [("2024-01-06", "A", 2), ("2024-01-06", None, 1)]


# --- staging view, mart, runs ------------------------------------------------------------------


def test_staging_view_and_trends(spark):
    df = activity(spark, ("2024-01-05", "A", 3, 10.0), ("2024-01-05", "A", 1, 20.0),
                  ("2024-01-05", None, 2), ("2024-01-05", "B", 0))
    staged = staging.stg_daily_activity(df)
    assert len(staged.columns) == 9 and staged.count() == 2
    [row] = marts.activity_trends(staged).collect()
    assert (row.daily_updates, row.avg_enrollment, row.industry_share) == (4, 15.0, 1.0)


def test_enrollment_by_month_weighs_days_by_their_updates(spark):
    df = activity(spark, ("2024-01-05", "A", 3, 10.0), ("2024-01-31", "A", 1, 20.0), ("2024-01-06", "A", 6, None),
                  ("2024-02-01", "A", 2, 7.0), ("2024-02-01", "B", 5, None), ("2024-02-02", "B", 0, 9.0))
    rows = marts.enrollment_by_month(staging.stg_daily_activity(df)).collect()
    got = {(r.therapeutic_area, r.activity_month.isoformat()): tuple(r)[2:] for r in rows}
    assert got == {
        ("A", "2024-01-01"): (10, 15.0, 12.5),
        ("A", "2024-02-01"): (2, 7.0, 7.0),
        ("B", "2024-02-01"): (5, None, None),
    }
    assert marts.enrollment_by_month(staging.stg_daily_activity(df.limit(0))).count() == 0


def _trends(spark, warehouse):
    return sorted((r.activity_date.isoformat(), r.therapeutic_area, r.daily_updates)
                  for r in tables.read_trends(spark, f"{warehouse}/mart_activity_trends").collect())


def test_daily_runs_and_backfill(spark, tmp_path):
    configure(spark)
    root, wh = str(tmp_path / "pages"), str(tmp_path / "wh")
    for d in range(1, 6):
        land_page(tmp_path / "pages", f"2024-01-0{d}", "p1", *[study(f"N{i}") for i in range(d)])
        land_page(tmp_path / "pages", f"2024-01-0{d}", "p2", study("X", conditions=("Asthma",)))
    assert daily.run_daily(spark, root, wh, "2024-01-04").status == "appended"
    # Out of order, then again, then a day without pages.
    assert daily.run_daily(spark, root, wh, "2024-01-02").status == "appended"
    assert daily.run_daily(spark, root, wh, "2024-01-04").status == "nothing_new"
    assert daily.run_daily(spark, root, wh, "2024-01-09").status == "empty"
    assert _trends(spark, wh) == [("2024-01-02", "Cardiovascular", 2), ("2024-01-02", "Respiratory", 1),
                                  ("2024-01-04", "Cardiovascular", 4), ("2024-01-04", "Respiratory", 1)]
    result = daily.run_backfill(spark, root, wh, "2024-01-01", "2024-01-04")
    assert [r[0].isoformat() for r in result.skipped.collect()] == ["2024-01-02", "2024-01-04"]
    assert [t for t in _trends(spark, wh) if t[1] == "Cardiovascular"] == [
        (f"2024-01-0{d}", "Cardiovascular", d) for d in range(1, 5)]
    again = daily.run_backfill(spark, root, wh, "2024-01-01", "2024-01-04")
    assert again.status == "nothing_new"


def test_daily_command(spark, tmp_path, monkeypatch, capsys):
    from trialweave.jobs import daily as command

    for day in ("2024-01-01", "2024-01-02"):
        land_page(tmp_path / "pages", day, "p", study())

    def call(*arguments):
        monkeypatch.setattr("sys.argv", ["daily", "--pages", str(tmp_path / "pages"), "--warehouse",
                                         str(tmp_path / "wh"), *arguments])
        command.main()
        return capsys.readouterr().out

    assert call("--date", "2024-01-02").startswith("appended")
    out = call("--backfill", "2024-01-01", "2024-01-02")
    assert out.startswith("appended") and "skipped 2024-01-02" in out
    assert "rows read 2, skipped 1, appended 1" in out
    assert not list((tmp_path / "wh" / "staging").glob("*/run-*"))
    assert [t[0] for t in _trends(spark, f"{tmp_path}/wh")] == ["2024-01-01", "2024-01-02"]
    assert call().startswith("empty")


def test_daily_command_prints_every_skipped_day(spark, tmp_path, monkeypatch, capsys):
    from trialweave.jobs import daily as command

    days = [f"2024-01-{d:02d}" for d in range(1, 26)]
    for day in days:
        land_page(tmp_path / "pages", day, "p", study())
    monkeypatch.setattr("sys.argv", ["daily", "--pages", str(tmp_path / "pages"), "--warehouse",
                                     str(tmp_path / "wh"), "--backfill", days[0], days[-1]])
    command.main()
    capsys.readouterr()
    command.main()
    out = capsys.readouterr().out.splitlines()
    assert out[:2] == ["nothing_new", "rows read 25, skipped 25, appended 0"]
    assert out[2:] == [f"skipped {day}" for day in days]


def test_stages_of_runs_that_died_are_removed(spark, tmp_path):
    stage_area.write_changes(
        activity(spark, ("2024-01-05", "A", 1)), f"{tmp_path}/staging/event_date=2024-01-05/run-x", 0)
    daily.remove_old_stages(spark, str(tmp_path))
    assert not list(tmp_path.glob("staging/*/run-*"))
    daily.remove_old_stages(spark, f"{tmp_path}/none")


def test_publish_reports_the_number_of_events(spark, tmp_path):
    assert publish(event_frame(spark, event("2024-01-05"), event("2024-01-06")), str(tmp_path / "t")) == 2


def test_day_before():
    assert daily.day_before("2024-03-01") == "2024-02-29"
