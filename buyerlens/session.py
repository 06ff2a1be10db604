"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(
    app_name: str = "buyerlens",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on; ``settings`` override the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Sums of whole cents must stop on overflow, not wrap.
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session
    without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="buyerlens-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/buyerlens-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for something this application writes and reads again."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path, for what has no DataFrame call: listing, deleting."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def delete_path(spark: SparkSession, path: str) -> None:
    files, found = file_system(spark, path)
    files.delete(found, True)


def clear_scratch(spark: SparkSession, *keep: str) -> None:
    """Delete what this application has written to its scratch paths, but for the paths in ``keep``.

    Results that have not been computed or written yet may still need it, so this is for
    whoever owns the application and knows that they have been.
    """
    files, path = file_system(spark, _scratch(spark))
    if files.exists(path):
        names = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
        for status in files.listStatus(path):
            if status.getPath().getName() not in names:
                files.delete(status.getPath(), True)
