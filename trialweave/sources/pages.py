"""Registry response pages: JSON documents landed under ``event_date=YYYY-MM-DD``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trialweave import schemas
from trialweave.functions.areas import conditions_area

# What a missing field of a study becomes.
DEFAULTS = {
    "nct_id": "",
    "overall_status": "UNKNOWN",
    "phase": "N/A",
    "sponsor_class": "Other",
    "enrollment": 0,
    "lead_sponsor": "",
}


def read_pages(
    spark: SparkSession,
    root: str,
    first_day: str | None = None,
    last_day: str | None = None,
    per_line: bool = False,
) -> DataFrame:
    """Landed pages as ``(value, event_date)``, all pages of a day together.

    The day is the one that was asked for, hence the folder and not a field of the document. The
    bounds prune folders. A page is one response and so of bounded size: it is read as a whole file
    or, with ``per_line``, as a line, which spares the file system many small files.
    """
    columns = schemas.struct(value=StringType(), event_date=StringType())
    pages = spark.read.schema(columns).text(root, wholetext=not per_line)
    if first_day is not None:
        pages = pages.filter(F.col("event_date") >= first_day)
    if last_day is not None:
        pages = pages.filter(F.col("event_date") <= last_day)
    return pages


def flatten_pages(pages: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """One flat trial-update event per study in ``(value, event_date)`` pages.

    A page that is not JSON fails the read: dropping it would lose studies silently. A field that
    is present but null is treated as missing and gets its default.

    With ``keep_nulls`` it stays null: id, status, sponsor class and name that are present but null, and a
    first phase that is. Only a field itself counts, not a null section above it. An enrollment of null is 0
    and a null list is empty in either case. Pages are then parsed a second time, as ``VARIANT``,
    which tells a null from a field that is not there.
    """
    parsed = F.from_json("value", schemas.PAGE, {"mode": "FAILFAST"})
    study = parsed["studies"]
    if keep_nulls:
        raw = F.variant_get(F.parse_json("value"), "$.studies", "array<variant>")
        study = F.arrays_zip(study.alias("study"), raw.alias("raw"))
        section = pages.select("event_date", F.explode(study).alias("row")).select(
            "event_date", F.col("row.study.protocolSection").alias("s"), F.col("row.raw").alias("raw")
        )
    else:
        section = pages.select("event_date", F.explode(study).alias("study")).select(
            "event_date", F.col("study.protocolSection").alias("s")
        )

    def field(path: str, name: str) -> Column:
        value = F.coalesce(F.col(f"s.{path}"), F.lit(DEFAULTS[name]))
        if keep_nulls:
            found = F.variant_get(F.col("raw"), f"$.protocolSection.{path}", "variant")
            value = F.when(~F.is_variant_null(found), value).when(found.isNull(), value)
        return value.alias(name)

    phases = F.col("s.designModule.phases")
    phase = F.coalesce(F.get(phases, F.lit(0)), F.lit(DEFAULTS["phase"]))
    if keep_nulls:
        phase = F.when(F.size(phases) > 0, F.get(phases, F.lit(0))).otherwise(F.lit(DEFAULTS["phase"]))
    count = F.col("s.designModule.enrollmentInfo.count")
    return section.select(
        field("identificationModule.nctId", "nct_id"),
        field("statusModule.overallStatus", "overall_status"),
        phase.alias("phase"),
        conditions_area(F.col("s.conditionsModule.conditions")).alias("therapeutic_area"),
        field("sponsorCollaboratorsModule.leadSponsor.class", "sponsor_class"),
        F.coalesce(count, F.lit(DEFAULTS["enrollment"])).alias("enrollment"),
        F.col("event_date").cast("string").alias("event_date"),
        field("sponsorCollaboratorsModule.leadSponsor.name", "lead_sponsor"),
    )
