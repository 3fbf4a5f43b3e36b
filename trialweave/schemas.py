"""Explicit schemas of every table, file and event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


TRIALS = struct(
    nct_id=StringType(),
    brief_title=StringType(),
    overall_status=StringType(),
    phase=StringType(),
    study_type=StringType(),
    sponsor_class=StringType(),
    enrollment=IntegerType(),
    start_date=DateType(),
    completion_date=DateType(),
    first_posted_date=DateType(),
    start_year=IntegerType(),
    is_completed=BooleanType(),
    is_interventional=BooleanType(),
    lead_sponsor_name=StringType(),
    therapeutic_area=StringType(),
    trial_duration_days=IntegerType(),
)

LANDSCAPE = struct(
    therapeutic_area=StringType(),
    start_year=IntegerType(),
    phase=StringType(),
    phase_numeric=IntegerType(),
    sponsor_class=StringType(),
    status_category=StringType(),
    trial_count=LongType(),
    completion_rate=DoubleType(),
    avg_enrollment=DoubleType(),
    avg_duration_days=DoubleType(),
    total_planned_enrollment=LongType(),
)

DAILY_ACTIVITY = struct(
    window_start=TimestampType(),
    window_end=TimestampType(),
    therapeutic_area=StringType(),
    update_count=LongType(),
    industry_sponsored=LongType(),
    avg_enrollment=DoubleType(),
    completed_count=LongType(),
)

TRENDS = struct(
    therapeutic_area=StringType(),
    activity_date=DateType(),
    daily_updates=LongType(),
    industry_updates=LongType(),
    avg_enrollment=DoubleType(),
    industry_share=DoubleType(),
    completed_count=LongType(),
)

TRIAL_UPDATE = struct(
    nct_id=StringType(),
    overall_status=StringType(),
    phase=StringType(),
    therapeutic_area=StringType(),
    sponsor_class=StringType(),
    enrollment=IntegerType(),
    event_date=StringType(),
    lead_sponsor=StringType(),
)

# The part of a registry response that is read; other fields are skipped by the JSON parser.
_PROTOCOL = struct(
    identificationModule=struct(nctId=StringType()),
    statusModule=struct(overallStatus=StringType()),
    designModule=struct(
        phases=ArrayType(StringType()), enrollmentInfo=struct(count=IntegerType())
    ),
    conditionsModule=struct(conditions=ArrayType(StringType())),
    sponsorCollaboratorsModule=struct(
        leadSponsor=StructType(
            [StructField("name", StringType()), StructField("class", StringType())]
        )
    ),
)
PAGE = struct(
    studies=ArrayType(struct(protocolSection=_PROTOCOL)), nextPageToken=StringType()
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` to exactly the columns, order and types of ``schema``."""
    return df.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields]
    )
