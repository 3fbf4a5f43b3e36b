"""Report queries on hand-made marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from trialweave.operators import series
from trialweave.plans import report


def trends(spark, *rows):
    return spark.createDataFrame(
        list(rows), "day string, therapeutic_area string, daily_updates bigint"
    ).withColumn("activity_date", F.to_date("day"))


def landscape(spark, *rows):
    return spark.createDataFrame(
        list(rows), "therapeutic_area string, start_year int, phase string, sponsor_class string, "
        "trial_count bigint")


def lines(df):
    return [(r.activity_date.day, r.therapeutic_area, r.daily_updates)
            for r in df.orderBy("activity_date", "therapeutic_area").collect()]


def test_nine_areas_give_seven_lines_and_others(spark):
    df = trends(spark, *[("2024-01-01", f"area {i}", 10 - i) for i in range(9)])
    got = lines(report.activity_lines(df, "2024-01-01", "2024-01-01"))
    assert got == [(1, "Others", 2 + 3)] + [(1, f"area {i}", 10 - i) for i in range(7)]


def test_ties_go_to_the_first_name(spark):
    df = trends(spark, ("2024-01-01", "b", 1), ("2024-01-01", "a", 1), ("2024-01-01", "c", 1))
    top = series.top_series(df, "therapeutic_area", "daily_updates", 2)
    assert sorted(r[0] for r in top.collect()) == ["a", "b"]


def test_gaps_are_zero_and_days_outside_are_left_out(spark):
    df = trends(spark, ("2024-01-02", "a", 5), ("2024-01-02", "a", 1), ("2024-01-03", "b", 2),
                ("2023-12-31", "c", 9))
    got = lines(report.activity_lines(df, "2024-01-01", "2024-01-03"))
    assert got == [(1, "a", 0), (1, "b", 0), (2, "a", 6), (2, "b", 0), (3, "a", 0), (3, "b", 2)]


def test_missing_series_name_is_a_series(spark):
    df = trends(spark, ("2024-01-01", None, 5), ("2024-01-01", "a", 1))
    got = lines(report.activity_lines(df, "2024-01-01", "2024-01-01", shown=1))
    assert got == [(1, None, 5), (1, "Others", 1)]


def test_month_to_date():
    assert report.month_to_date("2024-02-29") == ("2024-02-01", "2024-02-29")
    assert report.month_to_date("2024-03-01") == ("2024-03-01", "2024-03-01")


def test_last_days(spark):
    days = [r[0].isoformat() for r in series.last_days(spark, "2024-03-05", 14).collect()]
    assert (len(days), days[0], days[-1]) == (14, "2024-02-21", "2024-03-05")


ROWS = [("Oncology", 2009, "Phase 1", "A", 1), ("Oncology", 2012, "Phase 1", "A", 2),
        ("Oncology", 2013, "Phase 2", "B", 4), ("Psychiatry", 2012, "Phase 1", "B", 9)]


def test_controls_are_independent(spark):
    df = landscape(spark, *ROWS)

    def total(**controls):
        return report.landscape_selection(df, **controls).agg(F.sum("trial_count")).first()[0]

    assert (total(), total(start_year=2012), total(sponsor="B"),
            total(start_year=2012, sponsor="B")) == (15, 11, 13, 9)


def test_pivot_and_lists(spark):
    df = report.landscape_selection(landscape(spark, *ROWS))
    bars = report.area_by_phase_pivot(df).collect()
    assert [(r.therapeutic_area, r["Phase 1"], r["Phase 2"], r["Phase 3"], r.trial_count)
            for r in bars] == [("Psychiatry", 9, 0, 0, 9), ("Oncology", 2, 4, 0, 6)]
    assert [tuple(r) for r in report.year_control(df).collect()] == [(2013, 4), (2012, 11)]
    assert [tuple(r) for r in report.sponsor_control(df).collect()] == [("B", 13), ("A", 2)]
    assert [tuple(r) for r in report.area_years(df, 2).collect()] == [
        ("Oncology", 2013, 4), ("Psychiatry", 2012, 9)]


def test_labels(spark):
    labels = report.relabel(landscape(spark, *ROWS), report.LANDSCAPE_LABELS).columns
    assert labels == ["Therapeutic Area", "Start Year", "Phase", "Sponsor", "Trial Count"]
    assert len(report.LANDSCAPE_LABELS) + len(report.TRENDS_LABELS) == 16
