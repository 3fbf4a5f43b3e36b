"""A relational staging table instead of the staging folder.

Beside the table of rows there is a ledger, ``<table>_batches``, with one row per micro-batch: its key, its
number, its time and how many rows it has. The ledger row is written after the rows, so a micro-batch counts
as staged only when the ledger names it and all its rows are there. Every attempt at a micro-batch has a key
of its own: what a writer that died has left is never taken for a whole batch.

Needs the database's JDBC driver on the class path (also the driver's, ``--driver-class-path``); none
ships with Spark.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave import schemas
from trialweave.operators.merge import ACTIVITY_KEY

TABLE = "daily_activity"
_BATCH = [
    T.StructField("batch_key", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("staged_at", T.TimestampType()),
]
STAGED = T.StructType([*schemas.DAILY_ACTIVITY.fields, *_BATCH])
LEDGER = T.StructType([*_BATCH, T.StructField("row_count", T.LongType())])


def ledger_of(table: str) -> str:
    return f"{table}_batches"


def jdbc_writer(url: str, table: str = TABLE, **options: str) -> Callable[[DataFrame, int], None]:
    """A sink for ``run_pulse``. Inserts only: the table has no key.

    A replayed micro-batch inserts its rows again, and a later run newer totals of the same windows.
    Both carry their number and time, and the sync keeps the newest row per window and area.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        key, staged_at = uuid.uuid4().hex, dt.datetime.now(dt.UTC)
        rows = schemas.conform(batch, schemas.DAILY_ACTIVITY).withColumns(
            {
                "batch_key": F.lit(key),
                "batch_id": F.lit(batch_id).cast("long"),
                "staged_at": F.lit(staged_at).cast("timestamp"),
            }
        )
        rows = rows.persist()
        try:
            append_jdbc(rows, url, table, **options)
            entry = [(key, batch_id, staged_at, _windows(rows))]
            ledger = batch.sparkSession.createDataFrame(entry, LEDGER)
            append_jdbc(ledger, url, ledger_of(table), **options)
        finally:
            rows.unpersist()

    return write


def _windows(rows: DataFrame) -> int:
    return rows.select(*ACTIVITY_KEY).distinct().count()


def append_jdbc(rows: DataFrame, url: str, table: str, **options: str) -> None:
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def read_jdbc(
    spark: SparkSession, url: str, table: str, schema: T.StructType, **options: str
) -> DataFrame:
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return schemas.conform(rows, schema)


def complete_batches(staged: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger's batches all of whose rows are staged.

    A task that inserts its rows and is repeated inserts them twice, so windows and areas are counted,
    each once, not rows.
    """
    found = staged.groupBy("batch_key").agg(
        F.count_distinct(F.struct(*ACTIVITY_KEY)).alias("found")
    )
    return (
        ledger.dropDuplicates(["batch_key"])
        .join(found, "batch_key", "left")
        .filter(F.coalesce("found", F.lit(0)) == F.col("row_count"))
        .drop("found")
    )


def unfinished_batches(staged: DataFrame, ledger: DataFrame, before: dt.datetime) -> DataFrame:
    """Keys of batches the ledger does not name although they were begun before a time.

    Their writers have died, if ``before`` is far enough back; ``delete_jdbc_batches`` removes them.
    """
    old = staged.filter(F.col("staged_at") < F.lit(before).cast("timestamp"))
    return old.select("batch_key").distinct().join(ledger, "batch_key", "left_anti")


def delete_jdbc_batches(
    spark: SparkSession, url: str, keys: Iterable[str], table: str = TABLE, **options: str
) -> None:
    """Delete batches from both tables in one transaction; all other rows stay.

    Spark has no such command, so the driver opens one connection of its own.
    """
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    keys = list(keys)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        for name in (ledger_of(table), table):
            statement = connection.prepareStatement(f"DELETE FROM {name} WHERE batch_key = ?")
            for key in keys:
                statement.setString(1, key)
                statement.addBatch()
            statement.executeBatch()
            statement.close()
        connection.commit()
    finally:
        connection.close()
