"""Trial-update events: JSON messages from a topic or from landed line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trialweave import schemas
from trialweave.functions.scalars import timestamp_or_null

CORRUPT = "_corrupt"


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    *,
    topic: str | None = None,
    servers: str | None = None,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """Raw messages as one ``value`` string column, from JSON-line files or a Kafka topic.

    A topic is read from its earliest message; a streaming query continues from its checkpoint, a
    batch read ends at the latest offset. Files are read as text so both decode the same way.
    """
    reader = spark.readStream if streaming else spark.read
    if topic is not None:
        kafka = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
        )
        return kafka.options(**options).load().select(F.col("value").cast("string").alias("value"))
    if path is None:
        raise ValueError("give a path or a topic")
    # recursiveFileLookup keeps an event_date= folder name from becoming a second column.
    return reader.option("recursiveFileLookup", True).options(**options).text(path)


def decode_events(messages: DataFrame) -> DataFrame:
    """Typed event columns, ``event_time`` and ``_corrupt`` (the raw text of a bad message).

    The event is unfolded by a generator. Filters on its fields then stay above it; they would
    otherwise be pushed below the projection and parse every message once more.
    """
    schema = StructType([*schemas.TRIAL_UPDATE.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    event = F.from_json("value", schema, options)
    return messages.select(F.inline(F.array(event))).withColumn(
        "event_time", timestamp_or_null(F.col("event_date"))
    )


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(decoded: DataFrame) -> DataFrame:
    """The messages that could not be decoded, to be kept aside."""
    return decoded.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
