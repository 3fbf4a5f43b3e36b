"""Snapshot files to landscape: reading, enrichment, layout, checks."""

from __future__ import annotations

import datetime as dt
import functools
import glob
import gzip
import itertools
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from trialweave.operators import quality, trials
from trialweave.plans import marts, monthly, staging
from trialweave.session import configure, scratch_path, shared_folder
from trialweave.sinks.tables import register_views, write_landscape, write_trials
from trialweave.sources import delimited, snapshots, tables

STUDY_COLUMNS = ("nct_id", "brief_title", "overall_status", "phase", "study_type", "source",
                 "enrollment", "start_date", "completion_date", "study_first_posted_date")


def studies(spark, *rows):
    """Studies from partial dicts; missing columns are null."""
    data = [tuple(row.get(c) for c in STUDY_COLUMNS) for row in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in STUDY_COLUMNS))


def sponsors(spark, *rows):
    return spark.createDataFrame(
        list(rows), "nct_id string, lead_or_collaborator string, name string")


def conditions(spark, *rows):
    return spark.createDataFrame(list(rows), "nct_id string, downcase_mesh_term string")


# --- reading -----------------------------------------------------------------------------------


def test_delimited_dialect(spark, tmp_path):
    file = tmp_path / "studies.txt"
    file.write_text('id|title|n|unused\n'
                    'A|"x|y\nz ""q"""|5|u\n'
                    'B||\n'
                    'C|""|7|\n')
    rows = delimited.read_delimited(spark, str(file)).select("id", "title", "n").collect()
    assert [tuple(r) for r in rows] == [("A", 'x|y\nz "q"', "5"), ("B", None, None),
                                        ("C", None, "7")]


_FIELDS = st.sampled_from([None, "", "x", "a|b", "two\nlines", 'say "hi"', '"', "\n", "\n\n|\n", "é",
                           "line\nNCT|2\n", '""\n"', " pad ", "#", '5" tube', 'a""b', 'x"y"', 'end"',
                           ' "pad"', '5"\n6"|7"'])


def _quoted(field):
    """Quoted where it must be; other fields keep their inner quotes as they are."""
    if field is None:
        return ""
    must = set(field) & set("|\n") or field[:1] in ("", '"')
    return '"' + field.replace('"', '""') + '"' if must else field


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(_FIELDS, _FIELDS, _FIELDS), max_size=12), min_size=1, max_size=3),
       st.integers(5, 80), st.sampled_from(["\n", "\r\n"]))
def test_split_reader_agrees_with_the_whole_file_reader(spark, tmp_path_factory, files, size, end):
    folder = tmp_path_factory.mktemp("text")
    for i, rows in enumerate(files):
        text = "".join("|".join(map(_quoted, row)) + end for row in [("id", "t", "b c"), *rows])
        (folder / f"{i}.txt").write_bytes(text.encode())
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    whole = delimited.read_delimited(own, str(folder))
    split = delimited.read_delimited_split(own, str(folder))
    assert split.columns == whole.columns
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def _both_readers(spark, folder):
    read = (delimited.read_delimited, delimited.read_delimited_split)
    return [sorted(map(tuple, r(spark, str(folder)).collect()), key=repr) for r in read]


@pytest.mark.parametrize("text", [
    'A|5" tube|"two\nlines"|6" tube\nB|1|2|3\n',
    'A|x"y"|z|\n',
    'A|x"y"|z|\nB|"two\nlines"||\n',
    'A|"p\nq"|x"y"|"a""\n""b"\n',
    "A|1|2|3",
])
def test_inner_quotes_are_read_alike_whatever_else_the_file_holds(spark, tmp_path, text):
    (tmp_path / "t.txt").write_text("id|a|b|c\n" + text)
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.maxPartitionBytes", "11")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    whole, split = _both_readers(own, tmp_path)
    assert split == whole and len(whole) == text.count("A|") + text.count("B|")


@pytest.mark.parametrize("lines, reason", [
    ('A|"x"y', "quote or carriage return"),
    ('A|"p\nq"\n"C" |x', "quote or carriage return"),
    ('A|"p\nq"r', "quote or carriage return"),
    ('A|"x""', "file ends inside a field"),
    ('A|"x\r\ny"', "quote or carriage return"),
    ("A|x\ry", "quote or carriage return"),
])
def test_split_reader_refuses_what_it_cannot_be_sure_of(spark, tmp_path, lines, reason):
    (tmp_path / "t.txt").write_bytes(f"id|t\n{lines}\nB|z\n".encode())
    with pytest.raises(Exception, match=reason):
        delimited.read_delimited_split(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("close", ["", 'Z|y"\n'])
def test_a_lost_quote_is_refused_before_its_record_is_put_together(spark, tmp_path, close):
    clean = "".join(f"{i}|clean\n" for i in range(20_000))
    (tmp_path / "t.txt").write_text(f'id|t\nA|"lost\n{clean}{close}')
    own = configure(spark.newSession())
    for size in ("1MB", "2000"):
        own.conf.set("spark.sql.files.maxPartitionBytes", size)
        own.conf.set("spark.sql.files.openCostInBytes", "0")
        with pytest.raises(ValueError, match="record too long" if close else "file ends inside"):
            delimited.read_delimited_split(own, str(tmp_path), max_record_chars=5_000)
        if close:
            # Without the limit the record is as long as it is, however the file is cut.
            whole, split = _both_readers(own, tmp_path)
            assert split == whole and len(whole) == 1


def test_the_limit_counts_whole_records(spark, tmp_path):
    """The longest record has 28 characters with the end of its last line, wherever splits begin."""
    (tmp_path / "t.txt").write_text('id|t\nA|"' + "x\n" * 11 + 'y"\nB|z\nC|"p\nq"\n')
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    for size in (3, 7, 20, 1000):
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        assert delimited.read_delimited_split(own, str(tmp_path), max_record_chars=28).count() == 3
        with pytest.raises(ValueError, match="record too long"):
            delimited.read_delimited_split(own, str(tmp_path), max_record_chars=27)


def test_a_header_may_span_splits(spark, tmp_path):
    (tmp_path / "t.txt").write_text('id|"a\nlong\nname"\nA|"x\ny"\n')
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    for size in (4, 9, 18, 100):
        own.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        out = delimited.read_delimited_split(own, str(tmp_path))
        assert out.columns == ["id", "a\nlong\nname"] and [tuple(r) for r in out.collect()] == [("A", "x\ny")]


def test_lines_of_a_record_stay_in_their_split(spark, tmp_path):
    """Text in one split has no shuffle at all; text in many shuffles only what spans splits."""
    rows = "".join(f'{i}|"two\nlines {i}"\n' for i in range(3_000))
    (tmp_path / "t.txt").write_text("id|t\n" + rows)
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    own.conf.set("spark.sql.files.maxPartitionBytes", "1g")
    one = delimited.read_delimited_split(own, str(tmp_path))
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    own.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    many = delimited.read_delimited_split(own, str(tmp_path))
    assert sorted(map(tuple, many.collect())) == sorted((str(i), f"two\nlines {i}") for i in range(3_000))
    plan = many._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    spanning = delimited._settled(
        delimited._lines(own.read.text(str(tmp_path), lineSep="\n")).mapInArrow(
            delimited._summaries, delimited._SUMMARY).collect(), None).values()
    assert 0 < sum(s.tail > 0 for s in spanning) <= len(spanning)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_quotes_are_counted_in_the_second_pass(spark, tmp_path):
    """No line is matched again, unless quotes inside an unquoted field make counting them useless."""
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.maxPartitionBytes", "37")
    rows = "".join(f'{i}|"two\n""lines"" {i}"|x\n' for i in range(40))
    for name, more, matched in (("plain", "", False), ("inner", '41|"p\nq"|5" tube\n', True)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "t.txt").write_bytes(f"id|t|u\n{rows}{more}".encode())
        split = delimited.read_delimited_split(own, str(tmp_path / name))
        assert ("RLIKE" in _plan(split)) is matched
        whole, split = _both_readers(own, tmp_path / name)
        assert split == whole and len(whole) == 40 + matched


def test_every_short_line_leads_where_its_patterns_say(spark, tmp_path):
    """Patterns are tried on some lines only; all lines of up to five characters agree with all patterns."""
    texts = ["".join(t) for n in range(6) for t in itertools.product('"|a\u2028 ', repeat=n)]
    (tmp_path / "t.txt").write_bytes("\n".join(texts).encode())
    line = F.col("line")

    def leads(*patterns):
        return functools.reduce(
            lambda told, p: told.when(line.rlike(p[0]), p[1]), patterns[1:],
            F.when(line.rlike(patterns[0][0]), patterns[0][1])).otherwise(-1)

    between = leads((delimited._BETWEEN_TO_BETWEEN, 0), (delimited._BETWEEN_TO_INSIDE, 1))
    inside = leads((delimited._INSIDE_TO_INSIDE, 1), (delimited._INSIDE_TO_BETWEEN, 0))
    got = delimited._lines(spark.read.text(str(tmp_path), lineSep="\n"))
    assert got.count() == len(texts)
    assert got.filter((F.col("between") != between) | (F.col("inside") != inside)).isEmpty()


@pytest.mark.parametrize("whole_files, suffix, shuffled", [
    (False, "", False), (True, "", True), (False, "/part.txt.gz", True)])
def test_text_in_splits_lands_where_it_was_read(spark, tmp_path, monkeypatch, whole_files, suffix, shuffled):
    """Rows are dealt anew only where a file cannot be split."""
    hints = []
    kind = type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    texts = {"studies": "|".join(STUDY_COLUMNS) + '\nA|"x\ny"||||||||\n',
             "sponsors": "nct_id|lead_or_collaborator|name\nA|lead|S\n",
             "conditions": "nct_id|downcase_mesh_term\nA|asthma\n"}
    for name, text in texts.items():
        path = tmp_path / "snap" / (snapshots.FILES[name] + suffix)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(text.encode()) if suffix else text.encode())
    snapshots.land_snapshot(spark, f"{tmp_path}/snap", f"{tmp_path}/landed", whole_files)
    assert hints == ["rebalance"] * 3 * shuffled
    landed = snapshots.read_landed(spark, f"{tmp_path}/landed")
    assert [df.collect()[0][:2] for df in landed] == [("A", "x\ny"), ("A", "lead"), ("A", "asthma")]


def test_splits_that_change_after_the_look_are_noticed(spark, tmp_path):
    (tmp_path / "t.txt").write_text("id|t\n" + "".join(f'{i}|"a\nb"\n' for i in range(50)))
    own = configure(spark.newSession())
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.maxPartitionBytes", "100")
    out = delimited.read_delimited_split(own, str(tmp_path))
    own.conf.set("spark.sql.files.maxPartitionBytes", "13")
    with pytest.raises(Exception, match="splits have changed"):
        out.collect()


def test_split_reader_takes_long_fields(spark, tmp_path):
    field = 'x' * 50_000 + '""' * 20_000 + "\n" * 1_000
    (tmp_path / "t.txt").write_text(f'id|t\nA|"{field}"\nB|z\n')
    rows = {r.id: r.t for r in delimited.read_delimited_split(spark, str(tmp_path)).collect()}
    assert rows == {"A": field.replace('""', '"'), "B": "z"}


def test_snapshot_falls_back_to_the_fixed_date(spark, tmp_path):
    for day in ("2026-03-01", "2026-04-12", "2026-05-01"):
        (tmp_path / f"snapshot_date={day}").mkdir()
    resolve = snapshots.resolve_snapshot
    assert resolve(spark, str(tmp_path), "2026-03-01").endswith("2026-03-01")
    assert resolve(spark, str(tmp_path), "2026-03-02").endswith("2026-04-12")
    today = dt.datetime.now(dt.UTC).date().isoformat()
    assert resolve(spark, str(tmp_path)).endswith("2026-04-12")
    (tmp_path / f"snapshot_date={today}").mkdir(exist_ok=True)
    assert resolve(spark, str(tmp_path)).endswith(today)


def test_only_a_missing_path_counts_as_missing(spark, tmp_path):
    assert not tables.path_exists(spark, str(tmp_path / "none"))
    assert tables.path_exists(spark, str(tmp_path))
    with pytest.raises(Exception) as error:
        tables.path_exists(spark, "nosuchscheme://bucket/x")
    assert not (isinstance(error.value, AnalysisException)
                and error.value.getCondition() == "PATH_NOT_FOUND")


# --- enrichment --------------------------------------------------------------------------------


def test_typed_studies_never_fail(spark):
    row = trials.typed_studies(studies(
        spark, {"nct_id": "A", "enrollment": "abc", "start_date": "2015-03",
                "completion_date": "2015-01-31", "study_first_posted_date": "x"})).first()
    assert row.enrollment is None and row.start_date is None and row.start_year is None
    assert row.completion_date == dt.date(2015, 1, 31) and row.first_posted_date is None
    assert row.is_completed is False and row.is_interventional is False


def test_status_case_literal_and_normalized(spark):
    df = studies(spark, {"nct_id": "A", "overall_status": "COMPLETED",
                         "study_type": "INTERVENTIONAL"})
    literal, loose = trials.typed_studies(df).first(), trials.typed_studies(df, normalize=True).first()
    assert (literal.is_completed, literal.is_interventional) == (False, False)
    assert (loose.is_completed, loose.is_interventional) == (True, True)


def test_sponsor_class_column_is_a_parameter(spark):
    df = studies(spark, {"nct_id": "A", "source": "Acme"}).withColumn("class", F.lit("INDUSTRY"))
    assert trials.typed_studies(df).first().sponsor_class == "Acme"
    assert trials.typed_studies(df, "class").first().sponsor_class == "INDUSTRY"


def test_lead_sponsors(spark):
    df = sponsors(spark, ("A", "lead", "Zeta"), ("A", "lead", "Alpha"), ("A", "collaborator", "AA"),
                  ("B", "collaborator", "X"), ("C", "lead", None))
    assert sorted(map(tuple, trials.lead_sponsors(df).collect())) == [("A", "Alpha"), ("C", None)]


AREA_ROWS = [
    ("A", "asthma"), ("A", "breast cancer"),
    ("B", "healthy"), ("B", "stroke"),
    ("C", "colorectal neoplasms"),
    ("D", None), ("D", "healthy"),
    ("E", None), ("E", "stroke"),
    ("F", "shivering"),
    (None, "asthma"),
]


def test_primary_area(spark):
    df = conditions(spark, *AREA_ROWS)
    expected = {"A": "Respiratory", "B": "Cardiovascular", "C": "Oncology", "D": "Other",
                "E": "Cardiovascular", "F": "Infectious Disease", None: "Respiratory"}
    assert {r[0]: r[1] for r in trials.primary_area(df).collect()} == expected
    assert {r[0]: r[1] for r in trials.primary_area_ranked(df).collect()} == expected


def test_trials_are_sorted_by_the_end_of_their_id(spark):
    df = conditions(spark, *AREA_ROWS)
    assert "SortAggregate(key=[_group" in _plan(trials.primary_area(df))
    assert trials.primary_area(df).columns == ["nct_id", "therapeutic_area"]
    leads = trials.lead_sponsors(sponsors(spark, ("A", "lead", "Zeta")))
    assert "SortAggregate(key=[_group" in _plan(leads) and leads.columns == ["nct_id", "lead_sponsor_name"]


def test_trials_shrink_before_their_shuffle(spark):
    df = conditions(spark, *AREA_ROWS)
    for picked, operator in ((trials.primary_area(df), "functions=[partial_min("),
                             (trials.primary_area_ranked(df), "WindowGroupLimit")):
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert operator in plan.split("Exchange hashpartitioning")[1]


def test_enriched_trials(spark):
    df = trials.enrich_trials(
        studies(spark,
                {"nct_id": "A", "start_date": "2020-01-02", "completion_date": "2020-01-01"},
                {"nct_id": "B", "start_date": "2020-01-01", "completion_date": "2020-03-01"},
                {"nct_id": "N", "start_date": "2020-01-01"},
                {"nct_id": None, "brief_title": "x"}, {"nct_id": None, "brief_title": "x"}),
        sponsors(spark, ("A", "lead", "Alpha"), ("B", "collaborator", "X"), (None, "lead", "Null")),
        conditions(spark, *AREA_ROWS))
    got = sorted(((r.nct_id, r.lead_sponsor_name, r.therapeutic_area, r.trial_duration_days)
                  for r in df.collect()), key=repr)
    assert got == [("A", "Alpha", "Respiratory", -1), ("B", None, "Cardiovascular", 60),
                   ("N", None, "Other", None), (None, None, "Other", None),
                   (None, None, "Other", None)]
    assert len(df.columns) == 16


def _skewed(spark, tmp_path):
    """Inputs in which one id, and no id at all, each hold about a third of the studies."""
    spread = spark.range(30_000)
    key = F.format_string("NCT%08d", F.col("id"))
    kind = F.col("id") / 10_000
    ids = F.when(kind < 1, key).when(kind < 2, "NCT00000007")
    base = studies(spark, {"nct_id": "x"}).drop("nct_id", "brief_title")
    base = spread.select(ids.alias("nct_id"), F.sha2(F.col("id").cast("string"), 512).alias(
        "brief_title")).join(F.broadcast(base))
    base.repartition(8).write.parquet(str(tmp_path / "studies"))
    spread.filter("id < 10000").select(
        key.alias("nct_id"), F.lit("lead").alias("lead_or_collaborator"),
        F.concat(F.lit("S"), key).alias("name")).write.parquet(str(tmp_path / "sponsors"))
    hot = F.when(F.col("id") < 10_000, "NCT00000007").otherwise(key)
    spread.select(hot.alias("nct_id"), F.concat(F.lit("stroke "), key).alias(
        "downcase_mesh_term")).write.parquet(str(tmp_path / "conditions"))
    return [spark.read.parquet(str(tmp_path / n)) for n in ("studies", "sponsors", "conditions")]


def test_oversized_ids_are_split(spark, tmp_path):
    own = configure(spark.newSession())
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }.items():
        own.conf.set(key, value)
    df = trials.enrich_trials(*_skewed(own, tmp_path))
    summary = df.groupBy().agg(
        F.count("*").alias("rows"), F.count("lead_sponsor_name").alias("with_lead"),
        F.count_if(F.col("therapeutic_area") == "Cardiovascular").alias("cardio"),
        F.countDistinct("brief_title").alias("titles"))
    [row] = summary.collect()
    plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Ids below 10,000 have sponsors; of those only the hot one has conditions.
    assert (row.rows, row.with_lead, row.titles) == (30_000, 20_000, 30_000)
    assert row.cardio == 10_001
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_unused_sponsors_are_not_read(spark):
    enriched = trials.enrich_trials(
        studies(spark, {"nct_id": "A"}), sponsors(spark, ("A", "lead", "x")),
        conditions(spark, *AREA_ROWS))
    plan = marts.trial_landscape(staging.stg_trials(enriched))._jdf.queryExecution()
    assert "lead_or_collaborator" not in plan.optimizedPlan().toString()
    assert "lead_or_collaborator" in enriched._jdf.queryExecution().optimizedPlan().toString()


def test_generated_code_stays_small_enough_to_compile(spark):
    """The JVM does not compile methods above 8,000 bytes of bytecode."""
    from trialweave.catalog.queries import QUERIES

    own = configure(spark.newSession())
    for name in ("trial_landscape", "enriched_trials", "condition_list_area", "flattened_pages"):
        df = QUERIES[name](own, "/root/testdata/sf0.001")
        own.conf.set("spark.sql.adaptive.enabled", "false")
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert 0 < max(sizes) < 8000, name


# --- staging, mart, sinks ----------------------------------------------------------------------


def test_staging_and_landscape(spark):
    enriched = trials.enrich_trials(
        studies(spark,
                {"nct_id": "A", "overall_status": "Completed", "phase": "PHASE1/PHASE2",
                 "source": "S", "enrollment": "10", "start_date": "2010-05-01",
                 "completion_date": "2010-05-11"},
                {"nct_id": "B", "overall_status": "Completed", "phase": "PHASE1/PHASE2",
                 "source": "S", "start_date": "2010-06-01"},
                {"nct_id": "C", "overall_status": "Completed", "start_date": "2009-12-31"},
                {"nct_id": "D", "overall_status": "Completed"},
                {"nct_id": None, "overall_status": "Completed", "start_date": "2011-01-01"}),
        sponsors(spark, ("A", "lead", "x")), conditions(spark, ("A", "asthma"), ("B", "asthma")))
    staged = staging.stg_trials(enriched)
    assert staged.count() == 4 and len(staged.columns) == 18
    [row] = marts.trial_landscape(staged).collect()
    assert tuple(row) == ("Respiratory", 2010, "Phase 1/2", 1, "S", "Completed", 2, 1.0, 10.0, 10.0,
                          10)
    years = {r.start_year for r in marts.trial_landscape(staged, min_year=2000).collect()}
    assert years == {2009, 2010}


def test_completion_by_phase_ignores_status_groups(spark):
    landscape = spark.createDataFrame(
        [("Oncology", "Phase 1", 3, 1.0), ("Oncology", "Phase 1", 1, 0.0)],
        "therapeutic_area string, phase string, trial_count bigint, completion_rate double")
    assert tuple(marts.completion_by_phase(landscape).first()) == ("Oncology", "Phase 1", 4, 0.75)


def _enriched(spark):
    from trialweave.catalog import adapters

    return trials.enrich_trials(*adapters.batch_inputs(spark, "/root/testdata/sf0.001"))


def test_trial_table_layout(spark, tmp_path):
    path = str(tmp_path / "trials")
    assert write_trials(_enriched(spark), path) == 1500
    assert Path(path, "start_year=__HIVE_DEFAULT_PARTITION__").exists()
    assert Path(path, "start_year=2010").exists()
    for file in glob.glob(f"{path}/start_year=2010/*.parquet"):
        frame = pq.read_table(file, columns=["therapeutic_area", "overall_status"]).to_pandas()
        assert list(frame.itertuples(index=False)) == sorted(frame.itertuples(index=False))
    query = tables.read_trials(spark, path).filter(
        "start_year BETWEEN 2009 AND 2010 AND therapeutic_area = 'Oncology'")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "(start_year" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(therapeutic_area,Oncology)" in plan
    assert write_trials(_enriched(spark).limit(10), path) == 10


def test_large_years_are_written_by_several_tasks(spark, tmp_path):
    own = configure(spark.newSession())
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    one_year = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("nct_id"))
    one_year.repartition(8).write.parquet(str(tmp_path / "ids"))
    ids = own.read.parquet(str(tmp_path / "ids"))
    from trialweave import schemas

    rows = ids.select("nct_id", *[
        (F.lit(2015) if f.name == "start_year" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.TRIALS.fields if f.name != "nct_id"])
    assert write_trials(rows, str(tmp_path / "t")) == 15000
    assert len(glob.glob(f"{tmp_path}/t/start_year=2015/*.parquet")) > 2


def test_views(spark, tmp_path):
    own = spark.newSession()
    write_trials(_enriched(own), f"{tmp_path}/trials")
    stored = staging.stg_trials(tables.read_trials(own, f"{tmp_path}/trials"))
    write_landscape(marts.trial_landscape(stored), f"{tmp_path}/mart_trial_landscape")
    register_views(own, str(tmp_path))
    total, = own.sql("SELECT sum(trial_count) FROM mart_trial_landscape").first()
    expected, = own.sql("SELECT count(*) FROM stg_trials WHERE start_year >= 2010").first()
    assert total == expected > 0


# --- checks ------------------------------------------------------------------------------------


def _table(spark, *rows):
    return spark.createDataFrame(list(rows), "nct_id string, therapeutic_area string")


def test_checks_pass_and_fail(spark):
    good = _table(spark, ("A", "Oncology"), ("B", None), ("C", "Other"))
    report = quality.run_checks(good, quality.TRIAL_CHECKS, "trials")
    assert [r.failures for r in report.collect()] == [0, 0, 0]
    quality.require_clean(report)

    bad = _table(spark, ("A", "Oncology"), ("A", "Cancer"), ("A", "Cancer"), ("B", "Pain"),
                 (None, "Other"), (None, "Other"))
    report = quality.run_checks(bad, quality.TRIAL_CHECKS, "trials")
    assert {r.check_name: r.failures for r in report.collect()} == {
        "unique_nct_id": 1, "not_null_nct_id": 2, "accepted_values_therapeutic_area": 2}
    with pytest.raises(quality.QualityError, match="trials.unique_nct_id: 1"):
        quality.require_clean(report)
    failing = quality.failing_values(bad, quality.TRIAL_CHECKS[2])
    assert sorted(map(tuple, failing.collect())) == [("Cancer", 2), ("Pain", 1)]


def test_checks_of_an_empty_table(spark):
    empty = _table(spark, ("A", "Oncology")).limit(0)
    report = quality.run_checks(empty, quality.TRIAL_CHECKS, "trials")
    assert [r.failures for r in report.collect()] == [0, 0, 0]


# --- whole run ---------------------------------------------------------------------------------


def _snapshot(folder: Path, duplicate=False):
    folder.mkdir(parents=True)
    extra = "NCT1|again||||||||\n" if duplicate else ""
    (folder / "studies.txt").write_text(
        "nct_id|brief_title|overall_status|phase|study_type|source|enrollment|start_date|"
        "completion_date|study_first_posted_date|unused\n"
        'NCT1|"a|b\nc"|Completed|PHASE3|Interventional|Acme|100|2012-01-01|2012-12-31|2011-12-01|z\n'
        "NCT2|d|Recruiting|NA|Observational|Uni||2013-02-01|||\n" + extra)
    (folder / "sponsors.txt").write_text(
        "id|nct_id|agency_class|lead_or_collaborator|name\n"
        "1|NCT1|I|lead|Acme\n2|NCT1|I|collaborator|Other Co\n")
    (folder / "browse_conditions.txt").write_text(
        "id|nct_id|mesh_term|downcase_mesh_term|mesh_type\n"
        "1|NCT1|Stroke|stroke|m\n2|NCT1|Asthma|asthma|m\n")


def test_monthly_run(spark, tmp_path):
    _snapshot(tmp_path / "snap" / "snapshot_date=2026-05-01")
    assert monthly.run_monthly(spark, f"{tmp_path}/snap", f"{tmp_path}/wh", "2026-05-01") == 2
    trial = tables.read_trials(spark, f"{tmp_path}/wh/trials").filter("nct_id = 'NCT1'").first()
    assert trial.brief_title == "a|b\nc" and trial.therapeutic_area == "Respiratory"
    assert trial.lead_sponsor_name == "Acme" and trial.trial_duration_days == 365
    mart = tables.read_landscape(spark, f"{tmp_path}/wh/mart_trial_landscape")
    assert mart.agg(F.sum("trial_count")).first()[0] == 2


def test_monthly_run_stops_on_failed_checks(spark, tmp_path):
    _snapshot(tmp_path / "snap" / "snapshot_date=2026-04-12", duplicate=True)
    with pytest.raises(quality.QualityError, match="unique_nct_id"):
        monthly.run_monthly(spark, f"{tmp_path}/snap", f"{tmp_path}/wh", "2026-05-01")


@pytest.mark.parametrize("flags", [[], ["--whole-files", "--normalize"]])
def test_monthly_command(spark, tmp_path, monkeypatch, capsys, flags):
    from trialweave.jobs import monthly as command

    _snapshot(tmp_path / "snap" / "snapshot_date=2026-04-12")
    monkeypatch.setattr("sys.argv", ["monthly", "--snapshots", f"{tmp_path}/snap", "--warehouse",
                                     f"{tmp_path}/wh", "--date", "1999-01-01", *flags])
    command.main()
    assert "wrote 2 trials" in capsys.readouterr().out


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(f"{folder}/trialweave/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
