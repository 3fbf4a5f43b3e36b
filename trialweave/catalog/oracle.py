"""The SQL each named query must agree with, written independently of the operators."""

from __future__ import annotations

# --- registry-shaped inputs --------------------------------------------------------------------

_TRIAL_ID = "'NCT' || repeat('0', 8 - length({key}::VARCHAR)) || {key}::VARCHAR"
_ORDER_ID = _TRIAL_ID.format(key="o_orderkey")
_ITEM_ID = _TRIAL_ID.format(key="l_orderkey")

_STUDIES = f"""
raw_studies AS (
  SELECT *, (o_orderdate + INTERVAL 12 YEAR)::DATE AS started,
         (floor(o_totalprice / 500) - 100)::INTEGER AS days
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
),
studies AS (
  SELECT {_ORDER_ID} AS nct_id,
         o_orderpriority || '|line' || chr(10) || '"' || o_orderkey || '"' AS brief_title,
         CASE WHEN o_orderstatus = 'F' THEN 'Completed'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'
                THEN 'Active, not recruiting'
              WHEN o_orderstatus = 'O' THEN 'Recruiting'
              WHEN o_orderpriority = '5-LOW' THEN 'Suspended'
              ELSE 'Terminated' END AS overall_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'PHASE1' WHEN '2-HIGH' THEN 'PHASE1/PHASE2'
              WHEN '3-MEDIUM' THEN 'PHASE3' WHEN '4-NOT SPECIFIED' THEN 'NA'
              WHEN '5-LOW' THEN 'EARLY_PHASE1' END AS phase,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Observational'
              ELSE 'Interventional' END AS study_type,
         c_mktsegment AS sponsor_class,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE floor(o_totalprice / 1000)::INTEGER END AS enrollment,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN NULL
              ELSE started END AS start_date,
         CASE WHEN o_orderstatus <> 'O' THEN started + days END AS completion_date,
         started - 30 AS first_posted_date
  FROM raw_studies
),
typed AS (
  SELECT *, year(start_date)::INTEGER AS start_year,
         overall_status = 'Completed' AS is_completed,
         study_type = 'Interventional' AS is_interventional
  FROM studies
)"""

_SPONSORS = f"""
sponsors AS (
  SELECT {_ITEM_ID} AS nct_id, s_name AS name,
         CASE WHEN l_linenumber = 1 THEN 'lead' ELSE 'collaborator' END AS lead_or_collaborator
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
),
leads AS (
  SELECT nct_id, min(name) AS lead_sponsor_name
  FROM sponsors WHERE lead_or_collaborator = 'lead' GROUP BY nct_id
)"""

# Areas in priority order with the keywords that select them.
_BATCH_PATTERNS = [
    ("Oncology",
     "neoplasm|carcinoma|cancer|tumor|lymphoma|leukemia|melanoma|sarcoma|glioma|malignant"),
    ("Cardiovascular",
     "heart|cardiac|coronary|hypertension|stroke|vascular|artery|atherosclerosis|atrial"),
    ("Neurology",
     "alzheimer|parkinson|epilepsy|multiple sclerosis|neuropathy|neurological|brain|dementia"),
    ("Respiratory", "asthma|copd|pulmonary|respiratory|lung disease|pneumonia|bronchial"),
    ("Endocrine/Metabolic",
     "diabetes|insulin|obesity|metabolic syndrome|thyroid|endocrine|hyperglycemia"),
    ("Infectious Disease",
     "hiv|aids|infection|bacterial|viral|sepsis|hepatitis|tuberculosis|covid"),
    ("Immunology/Rheumatology",
     "arthritis|lupus|autoimmune|rheumatoid|inflammatory bowel|psoriasis|scleroderma"),
    ("Psychiatry",
     "depression|anxiety|schizophrenia|bipolar|psychiatric|mental disorder|addiction"),
    ("Gastroenterology",
     "crohn|colitis|gastric|intestinal|bowel|liver|hepatic|pancreatic|colorectal"),
]
# Keywords that only the rules for the snapshot files have.
_NOT_IN_UPDATES = (
    "malignant", "atherosclerosis", "neurological", "scleroderma", "addiction", "pancreatic"
)


def _area(text: str, updates: bool = False) -> str:
    cases = []
    for area, pattern in _BATCH_PATTERNS:
        if updates:
            pattern = "|".join(w for w in pattern.split("|") if w not in _NOT_IN_UPDATES)
        cases.append(f"WHEN regexp_matches({text}, '{pattern}') THEN '{area}'")
    return f"CASE {' '.join(cases)} ELSE 'Other' END"


_CONDITIONS = f"""
conditions AS (
  SELECT {_ITEM_ID} AS nct_id,
         split_part(p_name, ' ', 1) || ' ' || CASE split_part(p_name, ' ', 2)
           WHEN 'anvil' THEN 'lung neoplasms' WHEN 'bolt' THEN 'colorectal neoplasms'
           WHEN 'gear' THEN 'hypertension' WHEN 'gizmo' THEN 'asthma'
           WHEN 'plate' THEN 'viral hepatitis' WHEN 'ring' THEN 'type 2 diabetes'
           WHEN 'rod' THEN 'shivering' WHEN 'widget' THEN 'healthy volunteers' END
           AS downcase_mesh_term
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
),
classified AS (
  SELECT nct_id, downcase_mesh_term, {_area('downcase_mesh_term')} AS therapeutic_area
  FROM conditions
),
areas AS (
  SELECT nct_id, therapeutic_area FROM (
    SELECT nct_id, therapeutic_area, row_number() OVER (
             PARTITION BY nct_id
             ORDER BY CASE WHEN therapeutic_area <> 'Other' THEN 0 ELSE 1 END,
                      downcase_mesh_term NULLS FIRST) AS rn
    FROM classified)
  WHERE rn = 1
)"""

_ENRICHED = f"""{_STUDIES},{_SPONSORS},{_CONDITIONS},
trials AS (
  SELECT nct_id, brief_title, overall_status, phase, study_type, sponsor_class, enrollment,
         start_date, completion_date, first_posted_date, start_year, is_completed,
         is_interventional, lead_sponsor_name,
         coalesce(therapeutic_area, 'Other') AS therapeutic_area,
         (completion_date - start_date)::INTEGER AS trial_duration_days
  FROM typed LEFT JOIN leads USING (nct_id) LEFT JOIN areas USING (nct_id)
)"""

# The phase and status codes below, and their labels, are fixed values.
_STAGED = f"""{_ENRICHED},
labelled AS (
  SELECT * REPLACE (CASE phase
           WHEN 'EARLY_PHASE1' THEN 'Early Phase 1' WHEN 'PHASE1' THEN 'Phase 1'
           WHEN 'PHASE2' THEN 'Phase 2' WHEN 'PHASE3' THEN 'Phase 3' WHEN 'PHASE4' THEN 'Phase 4'
           WHEN 'PHASE1/PHASE2' THEN 'Phase 1/2' WHEN 'PHASE2/PHASE3' THEN 'Phase 2/3'
           WHEN 'PHASE3/PHASE4' THEN 'Phase 3/4' ELSE 'Not Applicable' END AS phase)
  FROM trials WHERE nct_id IS NOT NULL
),
stg_trials AS (
  SELECT nct_id, brief_title, overall_status,
         CASE WHEN overall_status IN ('Recruiting', 'Not yet recruiting', 'Active, not recruiting',
                                      'Enrolling by invitation') THEN 'Active'
              WHEN overall_status = 'Completed' THEN 'Completed'
              WHEN overall_status IN ('Terminated', 'Withdrawn') THEN 'Discontinued'
              ELSE 'Other' END AS status_category,
         phase,
         CASE WHEN phase LIKE '%Phase 1%' THEN 1 WHEN phase LIKE '%Phase 2%' THEN 2
              WHEN phase LIKE '%Phase 3%' THEN 3 WHEN phase LIKE '%Phase 4%' THEN 4
              END::INTEGER AS phase_numeric,
         study_type, is_interventional, sponsor_class, lead_sponsor_name, enrollment, start_date,
         completion_date, first_posted_date, start_year, therapeutic_area, is_completed,
         trial_duration_days
  FROM labelled
)"""

_LANDSCAPE = f"""{_STAGED},
landscape AS (
  SELECT therapeutic_area, start_year, phase, phase_numeric, sponsor_class, status_category,
         count(*) AS trial_count,
         count(*) FILTER (is_completed)::DOUBLE / count(*) AS completion_rate,
         avg(enrollment) AS avg_enrollment,
         avg(trial_duration_days) AS avg_duration_days,
         sum(enrollment)::BIGINT AS total_planned_enrollment
  FROM stg_trials WHERE start_year >= 2010 AND therapeutic_area IS NOT NULL
  GROUP BY ALL
)"""

_EVENTS = f"""
updates AS (
  SELECT {_TRIAL_ID.format(key='event_id')} AS nct_id,
         CASE WHEN value < 10 THEN 'COMPLETED' WHEN value < 50 THEN 'RECRUITING'
              ELSE 'UNKNOWN' END AS overall_status,
         'PHASE2' AS phase,
         CASE event_type WHEN 'signup' THEN 'Oncology' WHEN 'view' THEN 'Cardiovascular'
              WHEN 'purchase' THEN 'Neurology' WHEN 'click' THEN 'Infectious Disease' END
           AS therapeutic_area,
         CASE WHEN grade < 33 THEN 'INDUSTRY' WHEN grade < 66 THEN 'NIH' END AS sponsor_class,
         floor(value)::INTEGER AS enrollment,
         strftime(ts, '%Y-%m-%d') AS event_date,
         'Sponsor ' || user_id AS lead_sponsor,
         date_trunc('day', ts)::TIMESTAMP AS event_time
  FROM (SELECT *, regexp_extract(props, '"k": *([0-9]+)', 1)::INTEGER AS grade FROM events)
)"""


def _pulse(source: str) -> str:
    return f"""
activity AS (
  SELECT event_time AS window_start, event_time + INTERVAL 1 DAY AS window_end, therapeutic_area,
         count(*) AS update_count,
         count(*) FILTER (sponsor_class = 'INDUSTRY') AS industry_sponsored,
         avg(enrollment::DOUBLE) AS avg_enrollment,
         count(*) FILTER (overall_status = 'COMPLETED') AS completed_count
  FROM {source} WHERE event_time IS NOT NULL
  GROUP BY ALL
)"""


_ACTIVITY = f"{_EVENTS},{_pulse('updates')}"

_STAGED_ACTIVITY = f"""{_ACTIVITY},
stg_activity AS (
  SELECT *, industry_sponsored::DOUBLE / nullif(update_count, 0) AS industry_share,
         window_start::DATE AS activity_date
  FROM activity WHERE therapeutic_area IS NOT NULL AND update_count > 0
)"""

_TRENDS = f"""{_STAGED_ACTIVITY},
trends AS (
  SELECT therapeutic_area, activity_date, sum(update_count)::BIGINT AS daily_updates,
         sum(industry_sponsored)::BIGINT AS industry_updates,
         avg(avg_enrollment) AS avg_enrollment,
         sum(industry_sponsored)::DOUBLE / nullif(sum(update_count), 0) AS industry_share,
         sum(completed_count)::BIGINT AS completed_count
  FROM stg_activity GROUP BY therapeutic_area, activity_date
)"""

_KNOWN = f"""{_ACTIVITY},
known AS (
  SELECT * FROM activity
  WHERE window_start < TIMESTAMP '2024-01-16' AND therapeutic_area = 'Oncology'
)"""

_PAGE_TRENDS = f"""{_EVENTS},
page_updates AS (
  SELECT * REPLACE (coalesce(therapeutic_area, 'Other') AS therapeutic_area) FROM updates
),
{_pulse('page_updates').lstrip()}"""

_PAGES = f"""
page_orders AS (
  SELECT *, strftime(o_orderdate + INTERVAL 12 YEAR, '%Y-%m-%d') AS event_date,
         lower(CASE o_orderpriority WHEN '1-URGENT' THEN 'Lung' WHEN '2-HIGH' THEN 'Multiple'
                 WHEN '3-MEDIUM' THEN 'Type 2 Diabetes' WHEN '5-LOW' THEN 'Healthy' END
               || ' ' ||
               CASE o_orderstatus WHEN 'F' THEN 'Disease X' WHEN 'O' THEN 'Sclerosis'
                 WHEN 'P' THEN 'Stroke' END) AS conditions
  FROM orders
),
page_studies AS (
  SELECT {_ORDER_ID} AS nct_id,
         CASE WHEN o_orderstatus = 'O' THEN 'UNKNOWN' ELSE o_orderstatus END AS overall_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'PHASE1' WHEN '5-LOW' THEN 'N/A'
              ELSE 'PHASE3' END AS phase,
         {_area('conditions', updates=True)} AS therapeutic_area,
         CASE WHEN o_orderstatus = 'F' THEN 'INDUSTRY' ELSE 'Other' END AS sponsor_class,
         CASE WHEN o_orderstatus = 'P' THEN 0
              ELSE floor(o_totalprice / 1000)::INTEGER END AS enrollment,
         event_date, 'Sponsor ' || o_custkey AS lead_sponsor
  FROM page_orders
  UNION ALL
  SELECT '', 'UNKNOWN', 'N/A', 'Other', 'Other', 0, event_date, ''
  FROM page_orders WHERE o_orderpriority = '5-LOW'
)"""

_FAILED_CHECKS = """
duplicates AS (
  SELECT nct_id AS value, count(*) AS n FROM conditions
  WHERE nct_id IS NOT NULL GROUP BY nct_id HAVING count(*) > 1
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


_ACTIVITY_COLUMNS = (
    "window_start, window_end, therapeutic_area, update_count, industry_sponsored, "
    "avg_enrollment, completed_count"
)
_AREA_LIST = ", ".join(f"'{area}'" for area, _ in _BATCH_PATTERNS) + ", 'Other'"
_CONDITION_AREAS = _with(_PAGES, f"""
SELECT {_ORDER_ID} AS nct_id, {_area('words', updates=True)} AS therapeutic_area
FROM (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN replace(replace(replace(replace(conditions,
                       'lung ', 'lung  '), 'multiple ', 'multiple  '), '2 diabetes ', '2 diabetes  '),
                       'healthy ', 'healthy  ')
                     ELSE conditions END AS words FROM page_orders)""")
# The labels of phases.
_PHASES = (
    "Early Phase 1", "Phase 1", "Phase 2", "Phase 3", "Phase 4", "Phase 1/2", "Phase 2/3",
    "Phase 3/4", "Not Applicable",
)

ORACLE_SQL: dict[str, str] = {
    "trial_landscape": _with(_LANDSCAPE, "SELECT * FROM landscape"),
    "typed_studies": _with(_STUDIES, "SELECT * FROM typed"),
    "lead_sponsors": _with(_SPONSORS, "SELECT * FROM leads"),
    "classified_terms": _with(_CONDITIONS, "SELECT * FROM classified"),
    "primary_area": _with(_CONDITIONS, "SELECT * FROM areas"),
    "primary_area_ranked": _with(_CONDITIONS, "SELECT * FROM areas"),
    "enriched_trials": _with(_ENRICHED, "SELECT * FROM trials"),
    "stg_trials": _with(_STAGED, "SELECT * FROM stg_trials"),
    "completion_by_phase": _with(_STAGED, """
SELECT therapeutic_area, phase, count(*) AS trial_count,
       round(count(*) FILTER (is_completed)::DOUBLE / count(*), 6) AS completion_rate
FROM stg_trials WHERE start_year >= 2010 GROUP BY ALL"""),
    "delimited_studies": _with(_STUDIES, "SELECT * FROM typed"),
    "delimited_studies_split": _with(_STUDIES, "SELECT * FROM typed"),
    "landed_conditions": _with(_CONDITIONS, "SELECT * FROM areas"),
    "monthly_run": _with(_LANDSCAPE, "SELECT * FROM landscape"),
    "stored_trials": _with(_ENRICHED, "SELECT * FROM trials"),
    "load_row_count": "SELECT count(*) AS rows_written FROM orders",
    "years_of_area": _with(_ENRICHED, """
SELECT * FROM trials
WHERE start_year BETWEEN 2009 AND 2011 AND therapeutic_area = 'Oncology'"""),
    "stored_landscape": _with(_LANDSCAPE, "SELECT * FROM landscape"),
    "stored_trends": _with(_TRENDS, "SELECT * FROM trends"),
    "views_sql": _with(_STAGED, """
SELECT status_category, count(*) AS trials, sum(phase_numeric)::BIGINT AS phase_sum
FROM stg_trials WHERE start_year >= 2010 GROUP BY status_category"""),
    "flattened_pages": _with(_PAGES, "SELECT * FROM page_studies"),
    "flattened_pages_nulls": _with(_PAGES, """
SELECT * REPLACE (
         CASE WHEN nct_id = '' OR overall_status <> 'UNKNOWN' THEN overall_status END AS overall_status,
         CASE WHEN nct_id = '' OR sponsor_class <> 'Other' THEN sponsor_class END AS sponsor_class)
FROM page_studies"""),
    "pages_activity": _with(
        f"""{_PAGES},
timed AS (SELECT *, event_date::TIMESTAMP AS event_time FROM page_studies),{_pulse('timed')}""",
        "SELECT * FROM activity",
    ),
    "condition_list_area": _CONDITION_AREAS,
    "condition_rows_area": _CONDITION_AREAS,
    "document_areas": """
SELECT doc_id, CASE WHEN regexp_matches(words, 'berheit|lichver') THEN 'North'
                    WHEN regexp_matches(words, 'ciónll') THEN 'South'
                    WHEN regexp_matches(words, 'eauaux|oiaux') THEN 'West'
                    WHEN regexp_matches(words, 'erstwh|ionthou|whthst') THEN 'East'
                    ELSE 'Other' END AS therapeutic_area
FROM (SELECT doc_id, lower(text) AS words FROM documents)""",
    "activity_views_sql": _with(_TRENDS, """
SELECT therapeutic_area, activity_date, daily_updates, update_count, a.completed_count
FROM trends JOIN stg_activity a USING (therapeutic_area, activity_date)"""),
    "normalized_statuses": _with(_STAGED, """
SELECT status_category, is_completed, is_interventional, count(*) AS trials
FROM stg_trials GROUP BY ALL"""),
    "late_events_stream": _with(f"""{_EVENTS},
numbered AS (SELECT *, substr(nct_id, 4)::BIGINT % 2 AS run FROM updates),
in_time AS (
  SELECT * FROM numbered
  WHERE run = 0
     OR event_time >= (SELECT max(event_time) FROM numbered WHERE run = 0) - INTERVAL 1 DAY
),{_pulse('in_time')}""", "SELECT * FROM activity"),
    "merge_duplicate_versions": _with(_ACTIVITY, "SELECT * FROM activity"),
    "sync_report": _with(_KNOWN, """
SELECT count(*) AS rows_read, count(*) FILTER (seen) AS rows_skipped,
       count(*) FILTER (NOT seen) AS rows_appended
FROM (SELECT window_start::DATE IN (SELECT window_start::DATE FROM known) AS seen FROM activity)"""),
    "sync_steps": _with(_ACTIVITY, """
SELECT status, rows FROM (SELECT count(*) AS n FROM activity),
  LATERAL (VALUES ('empty', 0), ('appended', n), ('nothing_new', n)) AS steps(status, rows)"""),
    "encoded_events": _with(_EVENTS, "SELECT * FROM updates"),
    "daily_activity": _with(_ACTIVITY, "SELECT * FROM activity"),
    "daily_activity_stream": _with(_ACTIVITY, "SELECT * FROM activity"),
    "quarantined_stream": _with(f"""{_EVENTS},
numbered AS (SELECT *, substr(nct_id, 4)::BIGINT % 3 = 0 AS cut FROM updates),
whole AS (SELECT * FROM numbered WHERE NOT cut),{_pulse('whole')}""", """
SELECT *, (SELECT count(*) FROM numbered WHERE cut) AS set_aside FROM activity"""),
    "stg_daily_activity": _with(_STAGED_ACTIVITY, "SELECT * FROM stg_activity"),
    "activity_trends": _with(_TRENDS, "SELECT * FROM trends"),
    "enrollment_by_month": _with(_STAGED_ACTIVITY, """
SELECT therapeutic_area, date_trunc('month', activity_date)::DATE AS activity_month,
       sum(update_count)::BIGINT AS update_count, round(avg(avg_enrollment), 6) AS avg_enrollment,
       round(sum(avg_enrollment * update_count)
             / nullif(sum(update_count) FILTER (avg_enrollment IS NOT NULL), 0), 6) AS weighted_enrollment
FROM stg_activity GROUP BY ALL"""),
    "sync_skip_date": _with(_KNOWN, """
SELECT * FROM known UNION ALL
SELECT * FROM activity
WHERE window_start::DATE NOT IN (SELECT window_start::DATE FROM known)"""),
    "sync_upsert": _with(_ACTIVITY, "SELECT * FROM activity"),
    "sync_repeated_upserts": _with(_ACTIVITY, """
SELECT * REPLACE (update_count + CASE WHEN day(window_start) % 2 = 0 THEN 1 ELSE 0 END AS update_count)
FROM activity"""),
    "new_day_rows": _with(_KNOWN, """
SELECT * FROM activity
WHERE window_start::DATE NOT IN (SELECT window_start::DATE FROM known)"""),
    "known_day_rows": _with(_KNOWN, """
SELECT * FROM activity WHERE window_start::DATE IN (SELECT window_start::DATE FROM known)"""),
    "skipped_days": _with(_KNOWN, """
SELECT DISTINCT window_start::DATE AS activity_date FROM activity
WHERE window_start::DATE IN (SELECT window_start::DATE FROM known)"""),
    "backfill": _with(_KNOWN, """
SELECT * FROM known UNION ALL
SELECT * FROM activity
WHERE window_start::DATE BETWEEN DATE '2024-01-18' AND DATE '2024-01-31'
  AND window_start::DATE NOT IN (SELECT window_start::DATE FROM known)"""),
    "backfill_run": _with(_PAGE_TRENDS, """
SELECT therapeutic_area, window_start::DATE AS activity_date, update_count AS daily_updates,
       industry_sponsored AS industry_updates, avg_enrollment,
       industry_sponsored::DOUBLE / update_count AS industry_share, completed_count
FROM activity"""),
    "backfill_days": _with(_TRENDS, """
SELECT day AS activity_date, day - 1 AS fetched_date,
       coalesce(sum(daily_updates), 0)::BIGINT AS updates
FROM (SELECT d::DATE AS day FROM generate_series(DATE '2024-01-18', DATE '2024-01-31',
                                                 INTERVAL 1 DAY) AS g(d))
LEFT JOIN trends ON activity_date = day GROUP BY day"""),
    "quality_report": _with(f"{_ENRICHED},{_ACTIVITY}", f"""
SELECT 'trials' AS table_name, 'unique_nct_id' AS check_name,
       (SELECT count(*) FROM (SELECT nct_id FROM trials WHERE nct_id IS NOT NULL
                              GROUP BY nct_id HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'trials', 'not_null_nct_id', (SELECT count(*) FROM trials WHERE nct_id IS NULL)
UNION ALL SELECT 'trials', 'accepted_values_therapeutic_area',
       (SELECT count(DISTINCT therapeutic_area) FROM trials
        WHERE therapeutic_area NOT IN ({_AREA_LIST}))
UNION ALL SELECT 'daily_activity', 'not_null_therapeutic_area',
       (SELECT count(*) FROM activity WHERE therapeutic_area IS NULL)
UNION ALL SELECT 'daily_activity', 'not_null_update_count',
       (SELECT count(*) FROM activity WHERE update_count IS NULL)"""),
    "duplicate_ids": _with(f"{_CONDITIONS},{_FAILED_CHECKS}", "SELECT * FROM duplicates"),
    "unaccepted_statuses": _with(_STUDIES, """
SELECT overall_status AS value, count(*) AS n FROM studies
WHERE overall_status NOT IN ('Completed', 'Recruiting') GROUP BY overall_status"""),
    "area_counts": _with(_ENRICHED, """
SELECT therapeutic_area, count(*) AS trial_count FROM trials GROUP BY therapeutic_area"""),
    "area_years_top20": _with(_LANDSCAPE, """
SELECT therapeutic_area, start_year, sum(trial_count)::BIGINT AS n FROM landscape
GROUP BY ALL ORDER BY start_year DESC, n DESC, therapeutic_area LIMIT 20"""),
    "daily_totals": _with(_TRENDS, """
SELECT activity_date, sum(daily_updates)::BIGINT AS total FROM trends GROUP BY activity_date"""),
    "tile1_area_by_phase": _with(_LANDSCAPE, """
SELECT therapeutic_area, phase, sum(trial_count)::BIGINT AS trial_count FROM landscape
GROUP BY ALL"""),
    "tile1_pivot": _with(_LANDSCAPE, f"""
SELECT therapeutic_area, sum(trial_count)::BIGINT AS trial_count,
       {', '.join(f'''coalesce(sum(trial_count) FILTER (phase = '{p}'), 0)::BIGINT AS "{p}"'''
                  for p in _PHASES)}
FROM landscape GROUP BY therapeutic_area"""),
    "tile1_selected": _with(_LANDSCAPE, """
SELECT therapeutic_area, phase, sum(trial_count)::BIGINT AS trial_count FROM landscape
WHERE start_year = 2012 AND sponsor_class = 'MACHINERY' GROUP BY ALL"""),
    "tile1_year_control": _with(_LANDSCAPE, """
SELECT start_year, sum(trial_count)::BIGINT AS trial_count FROM landscape GROUP BY start_year"""),
    "tile1_sponsor_control": _with(_LANDSCAPE, """
SELECT sponsor_class, sum(trial_count)::BIGINT AS trial_count FROM landscape
GROUP BY sponsor_class"""),
    "labelled_landscape": _with(_LANDSCAPE, """
SELECT therapeutic_area AS "Therapeutic Area", start_year AS "Start Year", phase AS "Phase",
       phase_numeric AS "Phase (Numeric)", sponsor_class AS "Sponsor", status_category AS "Status",
       trial_count AS "Trial Count", completion_rate AS "Completion Rate",
       avg_enrollment AS "Avg Enrollment", avg_duration_days AS "Avg Duration (Days)",
       total_planned_enrollment
FROM landscape"""),
    "labelled_trends": _with(_TRENDS, """
SELECT therapeutic_area AS "Therapeutic Area", activity_date AS "Activity Date",
       daily_updates AS "Daily Updates", industry_updates AS "Industry Updates",
       avg_enrollment AS "Avg Enrollment", industry_share AS "Industry Share", completed_count
FROM trends"""),
    "tile2_by_area": _with(_TRENDS, """
SELECT activity_date, therapeutic_area, daily_updates FROM trends
WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"""),
    "tile2_lines": _with(_TRENDS, """,
in_range AS (
  SELECT * FROM trends WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
),
top_areas AS (
  SELECT therapeutic_area FROM in_range GROUP BY therapeutic_area
  ORDER BY sum(daily_updates) DESC, therapeutic_area LIMIT 2
),
lines AS (
  SELECT activity_date,
         CASE WHEN therapeutic_area IN (SELECT therapeutic_area FROM top_areas)
              THEN therapeutic_area ELSE 'Others' END AS therapeutic_area,
         daily_updates
  FROM in_range
),
days AS (
  SELECT d::DATE AS activity_date
  FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS g(d)
)
SELECT activity_date, therapeutic_area, coalesce(sum(daily_updates), 0)::BIGINT AS daily_updates
FROM (SELECT DISTINCT therapeutic_area FROM lines) CROSS JOIN days
LEFT JOIN lines USING (activity_date, therapeutic_area)
GROUP BY ALL"""),
}
