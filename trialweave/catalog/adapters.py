"""Registry-shaped inputs derived from the star-schema tables.

Orders play studies, line items play their sponsors and condition terms, events play trial updates.
Every row of a table is used. The values cover the awkward cases: text that needs quoting, numbers
and dates that do not parse, missing parts, negative durations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIORITY_PHASE = {
    "1-URGENT": "PHASE1",
    "2-HIGH": "PHASE1/PHASE2",
    "3-MEDIUM": "PHASE3",
    "4-NOT SPECIFIED": "NA",
    "5-LOW": "EARLY_PHASE1",
}
NOUN_TERM = {
    "anvil": "lung neoplasms",
    "bolt": "colorectal neoplasms",
    "gear": "hypertension",
    "gizmo": "asthma",
    "plate": "viral hepatitis",
    "ring": "type 2 diabetes",
    "rod": "shivering",
    "widget": "healthy volunteers",
}
EVENT_AREA = {
    "signup": "Oncology",
    "view": "Cardiovascular",
    "purchase": "Neurology",
    "click": "Infectious Disease",
}
PRIORITY_CONDITION = {
    "1-URGENT": "Lung",
    "2-HIGH": "Multiple",
    "3-MEDIUM": "Type 2 Diabetes",
    "5-LOW": "Healthy",
}
# Rules over whole texts: pieces of words that some texts hold, many of them far from the beginning.
TEXT_RULES = (
    ("North", ("berheit", "lichver")),
    ("South", ("ciónll",)),
    ("West", ("eauaux", "oiaux")),
    ("East", ("erstwh", "ionthou", "whthst")),
)
EVENT_CONDITION = {
    "signup": "Breast Cancer",
    "view": "Stroke",
    "purchase": "Parkinson Disease",
    "click": "HIV Infections",
}
STATUS_CONDITION = {"F": "Disease X", "O": "Sclerosis", "P": "Stroke"}


# The columns used of each table; given, so that no job reads a footer to find them.
COLUMNS = {
    "customer": "c_custkey bigint, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string",
    "supplier": "s_suppkey bigint, s_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(key: Column, values: dict[str, str]) -> Column:
    parts = [F.lit(part) for pair in values.items() for part in pair]
    return F.element_at(F.create_map(*parts), key)


def _trial_id(key: str) -> Column:
    digits = F.col(key).cast("string")
    return F.concat(F.lit("NCT"), F.repeat(F.lit("0"), 8 - F.length(digits)), digits)


def _start(order_date: str = "o_orderdate") -> Column:
    """Order dates run 1995-2001; twelve years later they straddle the landscape's first year."""
    return F.add_months(F.to_date(order_date), 144)


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns text, as in the export."""
    orders = table(spark, sf_dir, "orders")
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("source")
    )
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice")

    def text(date: Column) -> Column:
        return date.cast("string")

    no_day = (priority == "2-HIGH") & (status == "O")
    duration = (F.floor(price / 500) - 100).cast("int")
    return orders.join(segments, "o_custkey", "left").select(
        _trial_id("o_orderkey").alias("nct_id"),
        F.concat(priority, F.lit('|line\n"'), key, F.lit('"')).alias("brief_title"),
        F.when(status == "F", "Completed")
        .when((status == "O") & (priority == "1-URGENT"), "Active, not recruiting")
        .when(status == "O", "Recruiting")
        .when(priority == "5-LOW", "Suspended")
        .otherwise("Terminated")
        .alias("overall_status"),
        _lookup(priority, PRIORITY_PHASE).alias("phase"),
        F.when(priority == "4-NOT SPECIFIED", "Observational")
        .otherwise("Interventional")
        .alias("study_type"),
        "source",
        F.when((status == "P") & (priority == "1-URGENT"), "n/a")
        .when(priority == "2-HIGH", F.concat(F.floor(price / 1000).cast("string"), F.lit(".75")))
        .otherwise(F.floor(price / 1000).cast("string"))
        .alias("enrollment"),
        F.when(no_day, F.left(text(_start()), F.lit(7))).otherwise(text(_start())).alias(
            "start_date"
        ),
        F.when(status != "O", text(F.date_add(_start(), duration))).alias("completion_date"),
        text(F.date_sub(_start(), 30)).alias("study_first_posted_date"),
    )


def sponsors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("name")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(names, "l_suppkey", "left")
        .select(
            _trial_id("l_orderkey").alias("nct_id"),
            F.when(F.col("l_linenumber") == 1, "lead")
            .otherwise("collaborator")
            .alias("lead_or_collaborator"),
            "name",
        )
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    terms = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(
            " ", F.get(words, F.lit(0)), _lookup(F.get(words, F.lit(1)), NOUN_TERM)
        ).alias("downcase_mesh_term"),
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(terms, "l_partkey", "left")
        .select(_trial_id("l_orderkey").alias("nct_id"), "downcase_mesh_term")
    )


def batch_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return studies(spark, sf_dir), sponsors(spark, sf_dir), conditions(spark, sf_dir)


def trial_updates(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """The eight event columns; events of type error have no area."""
    grade = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        _trial_id("event_id").alias("nct_id"),
        F.when(value < 10, "COMPLETED")
        .when(value < 50, "RECRUITING")
        .otherwise("UNKNOWN")
        .alias("overall_status"),
        F.lit("PHASE2").alias("phase"),
        _lookup(F.col("event_type"), EVENT_AREA).alias("therapeutic_area"),
        F.when(grade < 33, "INDUSTRY").when(grade < 66, "NIH").alias("sponsor_class"),
        F.floor(value).cast("int").alias("enrollment"),
        F.to_date("ts").cast("string").alias("event_date"),
        F.concat(F.lit("Sponsor "), F.col("user_id").cast("string")).alias("lead_sponsor"),
        *extra,
    )


def _conditions_of_order() -> Column:
    return F.when(
        F.col("o_orderpriority") != "4-NOT SPECIFIED",
        F.array(
            _lookup(F.col("o_orderpriority"), PRIORITY_CONDITION),
            _lookup(F.col("o_orderstatus"), STATUS_CONDITION),
        ),
    )


def condition_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text conditions per trial as an array; some trials have none, some a null between two."""
    conditions = _conditions_of_order()
    parted = F.array(F.get(conditions, F.lit(0)), F.lit(None).cast("string"), F.get(conditions, F.lit(1)))
    apart = conditions.isNotNull() & (F.col("o_custkey") % 2 == 0)
    return table(spark, sf_dir, "orders").select(
        _trial_id("o_orderkey").alias("nct_id"),
        F.when(apart, parted).otherwise(conditions).alias("conditions"),
    )


def condition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same conditions, one numbered row each."""
    return condition_lists(spark, sf_dir).select(
        "nct_id", F.posexplode_outer("conditions").alias("position", "condition")
    )


def pages(spark: SparkSession, sf_dir: str, nulls: bool = False) -> DataFrame:
    """A response page per order: its study and, for some, a second one without any field.

    With ``nulls`` what a study does not have is there as null, else it is missing.
    """
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    phases = (
        F.when(priority == "1-URGENT", F.array(F.lit("PHASE1"), F.lit("PHASE2")))
        .when(priority == "5-LOW", F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("PHASE3")))
    )
    enrollment = F.when(status != "P", F.floor(F.col("o_totalprice") / 1000).cast("int"))
    lead_name = F.concat(F.lit("Sponsor "), F.col("o_custkey").cast("string"))

    def study(present: bool) -> Column:
        def module(*fields: Column) -> Column:
            filled = F.struct(*fields)
            return filled if present else F.when(F.lit(False), filled)

        section = F.struct(
            module(_trial_id("o_orderkey").alias("nctId")).alias("identificationModule"),
            module(F.when(status != "O", F.upper(status)).alias("overallStatus")).alias(
                "statusModule"
            ),
            module(
                phases.alias("phases"), F.struct(enrollment.alias("count")).alias("enrollmentInfo")
            ).alias("designModule"),
            module(_conditions_of_order().alias("conditions")).alias("conditionsModule"),
            module(
                F.struct(
                    lead_name.alias("name"), F.when(status == "F", "INDUSTRY").alias("class")
                ).alias("leadSponsor")
            ).alias("sponsorCollaboratorsModule"),
        )
        return F.struct(section.alias("protocolSection"))

    studies_of_page = F.when(
        priority == "5-LOW", F.array(study(True), study(False))
    ).otherwise(F.array(study(True)))
    return table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(studies_of_page.alias("studies")), {"ignoreNullFields": str(not nulls).lower()}
        ).alias("value"),
        _start().cast("string").alias("event_date"),
    )


def update_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response page per event, of the day of the event."""
    condition = _lookup(F.col("event_type"), EVENT_CONDITION)
    updates = trial_updates(spark, sf_dir, condition.alias("condition"))
    section = F.struct(
        F.struct(F.col("nct_id").alias("nctId")).alias("identificationModule"),
        F.struct(F.col("overall_status").alias("overallStatus")).alias("statusModule"),
        F.struct(
            F.array("phase").alias("phases"),
            F.struct(F.col("enrollment").alias("count")).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(
            F.when(F.col("condition").isNotNull(), F.array("condition")).alias("conditions")
        ).alias("conditionsModule"),
        F.struct(
            F.struct(
                F.col("lead_sponsor").alias("name"), F.col("sponsor_class").alias("class")
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
    )
    page = F.struct(F.array(F.struct(section.alias("protocolSection"))).alias("studies"))
    return updates.select(F.to_json(page).alias("value"), "event_date")
