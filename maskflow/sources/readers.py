"""Readers that give the same columns in a batch and in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICRO_BATCH_BYTES = 64 << 30
MICRO_BATCH_RECORDS = 50_000_000


def read_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    streaming: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The values of one topic as text, in a column ``value``.

    Without ``startingOffsets`` a stream starts at the latest record, as Spark
    does, and a batch at the earliest. A stream takes ``MICRO_BATCH_RECORDS`` at a
    time unless ``maxOffsetsPerTrigger`` says otherwise, so that a restart after a
    long stop is not one micro-batch; ``minPartitions`` spreads few topic partitions over more
    tasks. Headers are not fetched, since no column is made of them.
    """
    options = dict(options or {})
    if streaming:
        options.setdefault("maxOffsetsPerTrigger", str(MICRO_BATCH_RECORDS))
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_files(
    spark: SparkSession,
    path: str,
    format: str,
    schema: T.StructType,
    streaming: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Files of one format by a declared schema; a stream tails the folder.

    ``json`` is read as lines of text in a column ``value``, to be decoded like
    the values of a topic. Every other format gives the declared columns.

    A stream takes ``MICRO_BATCH_BYTES`` of files at a time unless the options
    say otherwise, so that a folder with a long history is not one micro-batch.
    """
    options = dict(options or {})
    if streaming and not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        options["maxBytesPerTrigger"] = str(MICRO_BATCH_BYTES)
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if format == "json":
        return reader.text(path)
    return reader.format(format).schema(schema).load(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup table: Parquet, with its own schema."""
    return spark.read.parquet(path)
