"""Tables written one micro-batch at a time, safe to write again.

A table is a folder with one leaf per micro-batch,
``query_id=<id>/batch_id=<n>``. A batch overwrites its own leaf and nothing
else, so a batch that is replayed after a failure leaves the table as it was.
The query id comes with the checkpoint: a query started on a new checkpoint
counts its batches from 0 again, but under a new id, so it adds rows and never
overwrites those of an earlier query.

Rows of two batches are never merged: the same record sent twice is two rows.

Old leaves are put together by :func:`merge_batches` into ranges, ``_ranges/query_id=<id>/
upto=<n>``, whose rows carry their batch number. A range counts once it is written whole. From
then on readers take it in place of the leaves up to ``n``, and a batch that is replayed below
``n`` writes nothing, as its rows are in the range.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import folders
from ..functions import named

QUERY_ID = "query_id"
BATCH_ID = "batch_id"
INSERTED_AT = "inserted_at"
RANGES = "_ranges"
UPTO = "upto"

# Columns the leaf folders already divide by: one value in a leaf at most.
PER_BATCH = (QUERY_ID, BATCH_ID, INSERTED_AT)


# Text formats write milliseconds unless they are told otherwise.
_MICROSECONDS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def with_batch_metadata(df: DataFrame, query_id: str, batch_id: int) -> DataFrame:
    """Add query id, batch number and time of writing, one value for the whole batch."""
    return df.withColumns(
        {
            QUERY_ID: F.lit(query_id),
            BATCH_ID: F.lit(batch_id).cast("int"),
            INSERTED_AT: F.current_timestamp(),
        }
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, by name and with the declared types."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"declared columns {missing} not found in {df.columns}")
    return df.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, format: str) -> None:
    """Create an empty table, if there is none, that readers can already open."""
    leaf = [T.StructField(QUERY_ID, T.StringType()), T.StructField(BATCH_ID, T.IntegerType())]
    stored = [f for f in schema.fields if f.name not in (QUERY_ID, BATCH_ID)]
    whole = T.StructType(stored + leaf)
    try:
        spark.read.schema(whole).format(format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Adding no rows makes the folder and writes no file into it.
        spark.createDataFrame([], whole).write.mode("append").format(format).partitionBy(
            QUERY_ID, BATCH_ID
        ).save(path)


def write_batch(
    df: DataFrame,
    path: str,
    query_id: str,
    batch_id: int,
    format: str = "parquet",
    partition_on: str | None = None,
    coalesce: int | None = None,
) -> None:
    """Write one batch to its own leaf, in place of what is there.

    The leaf is written as a folder of its own, so no sort by partition columns
    is needed and the tasks write straight to files. ``partition_on`` divides a
    leaf further. ``coalesce`` makes that many files of a leaf, or more where
    they would grow beyond Spark's advisory size: only the rows to be written
    are moved, so the work before the write keeps all its tasks.
    """
    merged = folders.committed(df.sparkSession, _ranges(path, query_id), UPTO)
    if merged and batch_id <= merged[-1]:
        return
    leaf = f"{path.rstrip('/')}/{QUERY_ID}={query_id}/{BATCH_ID}={batch_id}"
    rows = df.drop(QUERY_ID, BATCH_ID)
    if coalesce:
        rows = rows.hint("rebalance", coalesce)
    _save(rows, leaf, format, partition_on)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet"
) -> DataFrame:
    """The declared columns of a table, the leaf's own columns typed as declared."""
    columns = {f.name: f for f in schema.fields}
    leaf = [
        columns.get(QUERY_ID, T.StructField(QUERY_ID, T.StringType())),
        columns.get(BATCH_ID, T.StructField(BATCH_ID, T.IntegerType())),
    ]
    table = spark.read.schema(T.StructType(_stored(schema) + leaf)).format(format).load(path)
    for query_id in _query_ids(spark, f"{path.rstrip('/')}/{RANGES}"):
        ends = folders.committed(spark, _ranges(path, query_id), UPTO)
        if not ends:
            continue
        # Leaves that are not deleted yet are left out by their folder, before any file is read.
        own = F.col(QUERY_ID).cast("string") == unquote(query_id)
        table = table.where(~(own & (F.col(BATCH_ID) <= ends[-1])))
        merged = _read_ranges(spark, path, query_id, ends, schema, format)
        table = table.unionByName(merged.select(*[named(f.name).cast(f.dataType) for f in table.schema]))
    return conform(table, schema)


def merge_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    partition_on: str | None = None,
    keep: int = 1,
) -> dict[str, int]:
    """Write the finished batches of every query id as one range; returns the batches merged.

    The newest ``keep`` batches of a query id, one at least, are left alone: a stream may still
    replay them. Files of a range have Spark's advisory size. The leaves are deleted after
    the range is whole; if that fails, readers pass them over and the next merge deletes them.
    No reader may be at work on the leaves meanwhile.
    """
    if keep < 1:
        raise ValueError("the newest batch of a query may be replayed and cannot be merged")
    path = path.rstrip("/")
    merged = {}
    for query_id in _query_ids(spark, path):
        own = f"{path}/{QUERY_ID}={query_id}"
        done = folders.committed(spark, own, BATCH_ID)
        ends = folders.committed(spark, _ranges(path, query_id), UPTO)
        last = ends[-1] if ends else -1
        closed = [b for b in done[:-keep] if b > last]
        if closed:
            rows = _read_leaves(spark, path, query_id, closed, schema, format)
            _save(rows.hint("rebalance"), f"{_ranges(path, query_id)}/{UPTO}={closed[-1]}", format, partition_on)
            merged[query_id], last = len(closed), closed[-1]
        for batch_id in done:
            if batch_id <= last:
                folders.delete(spark, f"{own}/{BATCH_ID}={batch_id}")
    return merged


def _save(rows: DataFrame, leaf: str, format: str, partition_on: str | None) -> None:
    writer = rows.write.mode("overwrite").format(format)
    if format in ("json", "csv"):
        writer = writer.options(**_MICROSECONDS)
    if partition_on and partition_on not in PER_BATCH:
        writer = writer.partitionBy(partition_on)
    writer.save(leaf)


def _stored(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in (QUERY_ID, BATCH_ID)]


def _ranges(path: str, query_id: str) -> str:
    return f"{path.rstrip('/')}/{RANGES}/{QUERY_ID}={query_id}"


def _query_ids(spark: SparkSession, path: str) -> list[str]:
    found = [re.fullmatch(rf"{QUERY_ID}=(.+)", name) for name in folders.names(spark, path)]
    return [own[1] for own in found if own]


def _read_leaves(
    spark: SparkSession, path: str, query_id: str, batches: list[int], schema: T.StructType, format: str
) -> DataFrame:
    """Rows of some batches, with their batch number."""
    whole = T.StructType([*_stored(schema), T.StructField(BATCH_ID, T.IntegerType())])
    own = f"{path}/{QUERY_ID}={query_id}"
    reader = spark.read.schema(whole).format(format).option("basePath", own)
    return reader.load([f"{own}/{BATCH_ID}={b}" for b in batches])


def _read_ranges(
    spark: SparkSession, path: str, query_id: str, ends: list[int], schema: T.StructType, format: str
) -> DataFrame:
    whole = T.StructType([*_stored(schema), T.StructField(BATCH_ID, T.IntegerType())])
    own = _ranges(path, query_id)
    rows = spark.read.schema(whole).format(format).option("basePath", own).load([f"{own}/{UPTO}={n}" for n in ends])
    return rows.drop(UPTO).withColumn(QUERY_ID, F.lit(unquote(query_id)))
