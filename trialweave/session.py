"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators count on, put on any session they run in.
SETTINGS = {
    # Window boundaries and date casts are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split an oversized join partition even if the next join then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "trialweave", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session, also to one that somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting and get a temporary folder: there the driver's
    disk is the executors' disk. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="trialweave-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders (and files) a glob pattern names, on whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in system.globStatus(path) or ())


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder; one that is there already is fine."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the parent of the new name is made, the new name must be free."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    if system.exists(path(target)) or not system.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is; a missing one is fine."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/trialweave/{label}-{uuid.uuid4().hex}"
