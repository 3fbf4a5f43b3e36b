"""Keyword rules, codes and scalar expressions on hand-made values."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trialweave.functions import areas, scalars, trial_codes


def _apply(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_rule_sets():
    count = {name: sum(len(words) for _, words in rules)
             for name, rules in (("batch", areas.BATCH_RULES), ("stream", areas.STREAM_RULES))}
    assert count == {"batch": 73, "stream": 67}
    assert len(areas.AREAS) == 10
    plain = re.compile("[a-z ]+")
    assert all(plain.fullmatch(word) for _, words in areas.BATCH_RULES for word in words)


@pytest.mark.parametrize("term, area", [
    ("asthma", "Respiratory"),
    ("colorectal neoplasms", "Oncology"),
    ("shivering", "Infectious Disease"),
    ("hearing aids", "Infectious Disease"),
    ("inflammatory bowel disease", "Immunology/Rheumatology"),
    ("pancreatic disease", "Gastroenterology"),
    ("Asthma", "Other"),
    ("healthy volunteers", "Other"),
    ("", "Other"),
    (None, "Other"),
])
def test_term_area(spark, term, area):
    assert _apply(spark, [term], "string", areas.term_area) == [area]


@pytest.mark.parametrize("conditions, area", [
    (["Lung", "Disease X"], "Respiratory"),
    (["Lung", "", "Disease X"], "Other"),
    (["Lung", None, "Disease X"], "Other"),
    ([None, "Stroke"], "Cardiovascular"),
    ([None], "Other"),
    (["MULTIPLE", "sclerosis"], "Neurology"),
    (["Asthma", "Breast Cancer"], "Oncology"),
    (["pancreatic disease"], "Other"),
    (["malignant", "liver"], "Gastroenterology"),
    ([], "Other"),
    (None, "Other"),
])
def test_conditions_area(spark, conditions, area):
    assert _apply(spark, [conditions], "array<string>", areas.conditions_area) == [area]


_WORDS = ["lung", "disease", "Disease X", "multiple", "Sclerosis", "metabolic", "syndrome x",
          "mental", "disorder", "bowel", "inflammatory", "asthma", "x", "", "stroke", "old lung", None]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_WORDS), max_size=5), min_size=1, max_size=30))
def test_conditions_by_row_agree_with_lists(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "id int, conditions array<string>")
    by_list = df.select("id", areas.conditions_area(F.col("conditions")).alias("area"))
    rows = df.select("id", F.posexplode_outer("conditions").alias("pos", "condition"))
    by_row = areas.conditions_area_by_key(rows, "id", "pos", "condition")
    assert sorted(map(tuple, by_row.collect())) == sorted(map(tuple, by_list.collect()))


def test_conditions_by_row_rejects_longer_keywords(spark):
    rows = spark.createDataFrame([(1, 0, "a")], "id int, pos int, condition string")
    with pytest.raises(ValueError):
        areas.conditions_area_by_key(rows, "id", "pos", "condition", (("A", ("a b c",)),))


def test_phases(spark):
    codes = ["EARLY_PHASE1", "PHASE1", "PHASE1/PHASE2", "PHASE2/PHASE3", "PHASE3/PHASE4", "PHASE4",
             "PHASE9", "phase1", "NA", "", None]
    labels = _apply(spark, codes, "string", trial_codes.phase_label)
    none = "Not Applicable"
    assert labels == ["Early Phase 1", "Phase 1", "Phase 1/2", "Phase 2/3", "Phase 3/4", "Phase 4",
                      none, none, none, none, none]
    numbers = _apply(spark, labels, "string", trial_codes.phase_numeric)
    assert numbers == [1, 1, 1, 2, 3, 4, None, None, None, None, None]


def test_status_category(spark):
    statuses = ["Recruiting", "Active, not recruiting", "Completed", "Withdrawn", "Suspended",
                "COMPLETED", None]
    assert _apply(spark, statuses, "string", trial_codes.status_category) == [
        "Active", "Active", "Completed", "Discontinued", "Other", "Other", "Other"]


def test_status_category_normalized(spark):
    statuses = ["RECRUITING", "ACTIVE_NOT_RECRUITING", "ENROLLING_BY_INVITATION", "COMPLETED",
                "terminated", "NO_LONGER_AVAILABLE", None]
    assert _apply(spark, statuses, "string",
                  lambda c: trial_codes.status_category(c, normalize=True)) == [
        "Active", "Active", "Active", "Completed", "Discontinued", "Other", "Other"]


def test_bad_values_become_null(spark):
    assert _apply(spark, ["12", "abc", "", None, "99999999999"], "string", scalars.int_or_null) == [
        12, None, None, None, None]
    assert _apply(spark, ["12.5", "-3.99", "7.", " 8.0 ", "1.2.3", "1e3", ".5", "1,5", "99999999999.5"],
                  "string", scalars.int_or_null) == [12, -3, 7, 8, None, None, None, None, None]
    days = _apply(spark, ["2015-03-01", "2015-03", "2015-3-1", "2015-02-30", None], "string",
                  scalars.date_or_null)
    assert [d and d.isoformat() for d in days] == ["2015-03-01", None, None, None, None]


def test_text_that_cannot_be_whole_is_not_cast(spark):
    """A failing cast raises an error inside, so the text is matched first; what casts stays."""
    texts = ["\t12", "+5", "-7 ", "1\x7f", "1-", "é", "1é", "n/a", "12.\t", "+3.5", "2147483648.5"]
    expected = [12, 5, -7, 1, None, None, None, None, None, 3, None]
    assert _apply(spark, texts, "string", scalars.int_or_null) == expected
    df = spark.createDataFrame([("n/a",)], "t string").select(scalars.int_or_null(F.col("t")))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.index("RLIKE") < plan.index("cast(t")


def test_ratio_and_flag(spark):
    row = spark.range(1).select(
        scalars.ratio(F.lit(1), F.lit(4)).alias("a"),
        scalars.ratio(F.lit(1), F.lit(0)).alias("b"),
        scalars.flag(F.lit(None) == "x").alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (0.25, None, False)


def test_whole_texts_decide_their_area(spark):
    """Without the texts, or with their beginnings only, the areas of documents would change."""
    from trialweave.catalog import adapters
    from trialweave.catalog.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: r.therapeutic_area for r in QUERIES["document_areas"](spark, folder).collect()}
    texts = adapters.table(spark, folder, "documents")
    beginnings = texts.select("doc_id", areas.conditions_area(
        F.array(F.left("text", F.lit(300))), adapters.TEXT_RULES).alias("area")).collect()
    assert len(set(got.values())) >= 4
    assert sum(got[r.doc_id] != r.area for r in beginnings) >= 10
