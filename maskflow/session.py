"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """The session for the command line. Cluster sizing is left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster it
    would be a different folder on each machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="maskflow-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never used twice.

    All paths of an application lie in one folder, which is deleted when its JVM ends.
    """
    context = spark.sparkContext
    home = f"{shared_root(spark)}/maskflow/{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(home)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{home}/{name}-{uuid.uuid4().hex}"
