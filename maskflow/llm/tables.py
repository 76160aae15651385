"""Small helpers that the operators share: scratch tables and guarded broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.session import scratch_path, shared_root

#: A side is broadcast only when it was counted and has at most so many bytes.
BROADCAST_BYTES = 32 << 20

#: A key is hot when it has more than this share of the rows. At most 1 / HOT_SHARE
#: keys can be hot, whatever the data, so the list of hot keys may be broadcast.
HOT_SHARE = 1 / 1000


def lean_batches(spark: SparkSession) -> None:
    """Let Spark hand whole texts to Python in batches of a few MB.

    The usual limit counts rows, and ten thousand long texts fill a worker's memory.
    A limit that differs from Spark's own is kept.
    """
    for key, usual, value in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(4 << 20)),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "4000"),
    ):
        if spark.conf.get(key) == usual:
            spark.conf.set(key, value)


def stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared scratch folder and read it back.

    Cuts lineage without depending on any executor: the files are in the folder
    that the cluster names in ``spark.checkpoint.dir``.
    """
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete scratch tables that :func:`stored` made and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = shared_root(spark) + "/maskflow/"
    for frame in frames:
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()):
                path.getFileSystem(conf).delete(path, True)


def small(frame: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``frame`` with a broadcast hint when its counted size is within the bound.

    Above the bound the frame is returned as it is and the join shuffles, with the
    same result.
    """
    return F.broadcast(frame) if rows * row_bytes <= BROADCAST_BYTES else frame


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and hash of the text are not in ``gone`` (``_gone``, ``_digest``)."""
    return docs.join(
        small(gone, gone.count(), 24),
        (F.col(id_col).cast("bigint") == F.col("_gone"))
        & (F.xxhash64(F.col(text_col).cast("string")) == F.col("_digest")),
        "left_anti",
    )


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join ``rows`` with ``keyed`` (one row per key, ``size`` rows each) on ``key``.

    Keys with more than ``HOT_SHARE`` of ``total`` rows are met by a broadcast of
    those keys alone (at most 1 / HOT_SHARE of them), so that a key with a third of
    all rows is never moved to one task. All other keys are joined by shuffle.
    """
    limit = max(1.0, total * HOT_SHARE)
    hot = F.broadcast(keyed.filter(F.col(size) > limit))
    rest = keyed.filter(F.col(size) <= limit)
    marked = rows.join(hot.select(key), key, "left_semi").join(hot, key)
    other = rows.join(hot.select(key), key, "left_anti").join(rest, key, "left")
    return marked.unionByName(other)
