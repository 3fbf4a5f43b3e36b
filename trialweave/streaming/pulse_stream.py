"""The daily aggregation as a bounded streaming run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from trialweave import schemas
from trialweave.operators.pulse import daily_pulse
from trialweave.session import configure, make_folder
from trialweave.sources.events import decode_events, good_events, quarantined, read_messages
from trialweave.streaming.staging import write_changes

# State holds one small row per open day and area, whatever the event volume.
STATE_PARTITIONS = 16


def streaming_session(
    spark: SparkSession, state_partitions: int = STATE_PARTITIONS
) -> SparkSession:
    """A session on the same application with its own number of state partitions."""
    own = configure(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def run_pulse(
    events: DataFrame, staging: str, write: Callable[[DataFrame, int], None] | None = None
) -> StreamingQuery:
    """Aggregate everything that is queued, stage the changed groups, and stop.

    Update mode emits open windows too, so the newest day is staged without waiting for a later
    event to close it. The checkpoint holds the read position and the window state: the next run
    continues, and a late event re-emits its day with complete totals. Window state is dropped once
    the watermark has passed the window; later events for it are counted by :func:`dropped_late`.

    ``write`` replaces the staging folder as the sink (see ``sinks.jdbc``).
    """

    def stage(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, staging, batch_id)

    query = (
        daily_pulse(events)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{staging}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(write or stage)
        .start()
    )
    query.awaitTermination()
    return query


def run_intake(decoded: DataFrame, staging: str, quarantine: str) -> StreamingQuery:
    """Bring what is queued into the staging folder: read and parsed once, good and bad messages apart.

    Micro-batch N writes ``staging/events/batch_id=N`` and ``quarantine/messages/batch_id=N``. A replayed
    micro-batch overwrites its own folders, so that every message is kept once.
    """

    def part(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for rows, folder in ((good_events(batch), f"{staging}/events"), (quarantined(batch), f"{quarantine}/messages")):
                rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    query = (
        decoded.writeStream.option("checkpointLocation", f"{staging}/intake")
        .trigger(availableNow=True)
        .foreachBatch(part)
        .start()
    )
    query.awaitTermination()
    return query


def staged_events(spark: SparkSession, staging: str) -> DataFrame:
    """The good events of :func:`run_intake` as a stream. Files are removed once they have been read."""
    folder = f"{staging}/events"
    make_folder(spark, folder)
    events = StructType([*schemas.TRIAL_UPDATE.fields, StructField("event_time", TimestampType())])
    reader = spark.readStream.schema(events).option("cleanSource", "delete")
    return reader.option("recursiveFileLookup", True).parquet(folder)


def pulse_from_messages(
    spark: SparkSession,
    staging: str,
    quarantine: str | None = None,
    *,
    write: Callable[[DataFrame, int], None] | None = None,
    state_partitions: int = STATE_PARTITIONS,
    **source: str,
) -> StreamingQuery:
    """:func:`run_pulse` over queued messages (see ``read_messages`` for ``source``).

    With ``quarantine`` messages that cannot be decoded are kept there: :func:`run_intake` reads the queue
    and the aggregation reads its events. Without, the aggregation reads the queue and leaves them out.
    A checkpoint keeps the number of state partitions it was begun with.
    """
    own = streaming_session(spark, state_partitions)
    decoded = decode_events(read_messages(own, streaming=True, **source))
    if quarantine is None:
        return run_pulse(good_events(decoded), staging, write)
    run_intake(decoded, staging, quarantine)
    return run_pulse(staged_events(own, staging), staging, write)


def dropped_late(query: StreamingQuery) -> int:
    """Events of a run that came after their window was closed."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
