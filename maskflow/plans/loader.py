"""Loading a file of records into a topic, or into a folder a stream tails."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..sources.decode import CORRUPT, parse_once, with_reasons


def load_records(
    spark: SparkSession, path: str, schema: T.StructType, primary: str
) -> tuple[DataFrame, DataFrame]:
    """Check every line of the files at ``path`` against the declared schema.

    Returns the good records as ``(key, value)``: the primary value as text and
    the line as it is, fields beyond the schema included. The other lines, and
    those without a primary value, are returned as ``(file, value, reasons)``: what is wrong
    with which field.
    """
    lines = spark.read.text(path)
    return check_records(
        lines.select(F.col("value"), F.col("_metadata.file_path").alias("file")),
        schema,
        primary,
    )


def check_records(
    lines: DataFrame, schema: T.StructType, primary: str
) -> tuple[DataFrame, DataFrame]:
    """The same check on any table with a column ``value`` of text, and ``file``."""
    record = parse_once(F.col("value"), schema)
    parsed = lines.select("value", "file", record.alias("record"))
    key = F.col("record")[primary]
    good = F.col("record")[CORRUPT].isNull() & key.isNotNull()
    bad = parsed.where(~F.coalesce(good, F.lit(False))).select("file", "value")
    return (
        parsed.where(good).select(key.cast("string").alias("key"), "value"),
        with_reasons(bad, schema, "value", primary),
    )


def write_topic(records: DataFrame, brokers: str, topic: str) -> None:
    """Send ``(key, value)`` records to a topic; one key keeps its order."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def write_folder(records: DataFrame, path: str) -> None:
    """Add the values, one per line, to a folder that a file source tails."""
    records.select("value").write.mode("append").text(path)


def write_quarantine(bad: DataFrame, path: str) -> DataFrame:
    """Add rejected lines to a folder under an id of their own; returns those of this run."""
    leaf = f"{path.rstrip('/')}/run_id={uuid.uuid4()}"
    bad.write.json(leaf)
    return bad.sparkSession.read.schema(bad.schema).json(leaf)


def run_loader(
    spark: SparkSession,
    store: spec.Store,
    pipeline_id: str,
    default_env: dict[str, str] | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Load the pipeline's file; returns the lines that were left out, all of them.

    With ``folder`` the records go there instead of the topic. Where the pipeline
    names a quarantine, the lines left out are written there as JSON with their
    file, and what is returned reads them back.
    """
    pipeline = store.pipeline(pipeline_id)
    if not isinstance(pipeline, spec.LoaderPipeline):
        raise ValueError(f"pipeline {pipeline_id!r} loads no file; use run_stream")
    connector_id, topic_name = spec.split_topic(pipeline.sink_topic)
    schema = store.schema_named(store.topic(connector_id, topic_name).topic_schema)
    path = spec.from_env(pipeline.source_filepath_env, default_env)
    good, bad = load_records(spark, path, schema.spark_schema(), schema.primary_field)
    if folder is not None:
        write_folder(good, folder)
    else:
        brokers = spec.from_env(store.connector(connector_id).broker_env, default_env)
        write_topic(good, brokers, topic_name)
    if pipeline.quarantine_filepath_env is None:
        return bad
    kept = spec.from_env(pipeline.quarantine_filepath_env, default_env)
    return write_quarantine(bad, kept)
