"""Publishing events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trialweave import schemas

# Fixed value: the topic of trial updates.
TOPIC = "trial-updates"


def encode_events(events: DataFrame) -> DataFrame:
    """One JSON ``value`` per event; null fields are written, messages carry no key."""
    names = schemas.TRIAL_UPDATE.names
    return events.select(
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")
    )


def publish(
    events: DataFrame,
    path: str | None = None,
    *,
    servers: str | None = None,
    topic: str = TOPIC,
    mode: str = "append",
) -> int:
    """Write events to a folder of line files or append them to a topic; returns their number.

    Nothing is written when there are none. They are counted by the job that writes them.
    """
    if events.isEmpty():
        return 0
    written = Observation()
    messages = encode_events(events).observe(written, F.count("*").alias("events"))
    if path is not None:
        messages.write.mode(mode).text(path)
    else:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )
    return written.get["events"]
