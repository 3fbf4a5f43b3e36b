"""Registry snapshots: pipe-delimited text files landed under ``snapshot_date=YYYY-MM-DD``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialweave.sources.delimited import read_delimited, read_delimited_split
from trialweave.sources.tables import path_exists

# Fixed value: the snapshot to use when the requested one is missing.
FALLBACK_SNAPSHOT = "2026-04-12"

# The files of a snapshot.
FILES = {
    "studies": "studies.txt",
    "sponsors": "sponsors.txt",
    "conditions": "browse_conditions.txt",
}


def resolve_snapshot(
    spark: SparkSession,
    root: str,
    requested: str | None = None,
    fallback: str = FALLBACK_SNAPSHOT,
) -> str:
    """Folder of the requested snapshot (today in UTC by default), else of the fixed fallback date."""
    day = requested or dt.datetime.now(dt.UTC).date().isoformat()
    folder = f"{root}/snapshot_date={day}"
    return folder if path_exists(spark, folder) else f"{root}/snapshot_date={fallback}"


# Files under these names are decompressed from their beginning, so each is one split.
_ONE_SPLIT = (".deflate", ".gz", ".lz4", ".snappy", ".zst")


def land(df: DataFrame, path: str, spread: bool = True) -> None:
    """Write parsed text once as evenly sized parquet files, so later reads split and prune.

    Rebalancing without keys spreads the rows of an unsplittable file over the cluster, whatever
    the keys in it look like. Text read in splits is even as it is: without ``spread`` every split
    is written where it was read, and no row is shuffled.
    """
    (df.hint("rebalance") if spread else df).write.mode("overwrite").parquet(path)


def land_snapshot(
    spark: SparkSession, folder: str, target: str, whole_files: bool = False, max_record_chars: int | None = None
) -> None:
    """Land the three files of a snapshot, keeping only the columns that are used.

    Files are read in many tasks each. ``whole_files`` reads one file per task instead, for text
    that ``read_delimited_split`` refuses; ``max_record_chars`` makes that one refuse longer records.
    """

    def read(spark: SparkSession, path: str) -> DataFrame:
        if whole_files:
            return read_delimited(spark, path)
        return read_delimited_split(spark, path, max_record_chars)

    used = {
        "studies": [
            "nct_id", "brief_title", "overall_status", "phase", "study_type", "source",
            "enrollment", "start_date", "completion_date", "study_first_posted_date",
        ],
        "sponsors": ["nct_id", "lead_or_collaborator", "name"],
        "conditions": ["nct_id", "downcase_mesh_term"],
    }
    for table, columns in used.items():
        text = read(spark, f"{folder}/{FILES[table]}")
        spread = whole_files or any(name.endswith(_ONE_SPLIT) for name in text.inputFiles())
        land(text.select(*[F.col(name) for name in columns]), f"{target}/{table}", spread)


def read_landed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Studies, sponsors and conditions of a landed snapshot."""
    return tuple(spark.read.parquet(f"{path}/{table}") for table in FILES)
