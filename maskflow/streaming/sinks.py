"""Where the records and the audit trail go."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import folders
from ..functions import named, unit_hash
from ..operators.sampling import sample_uniform, sample_weighted, weighted_draw
from ..session import scratch_path
from .tables import BATCH_ID, QUERY_ID, conform, ensure_table, read_table, with_batch_metadata, write_batch


@dataclass(frozen=True)
class TableSink:
    """A table with a declared schema, including the batch columns it declares."""

    path: str
    schema: T.StructType
    format: str = "parquet"
    partition_on: str | None = None
    trigger_seconds: int | None = None
    coalesce: int | None = None

    def prepare(self, spark: SparkSession) -> None:
        ensure_table(spark, self.path, self.schema, self.format)

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        stamped = with_batch_metadata(df, query_id, batch_id)
        rows = conform(stamped, self.schema)
        write_batch(
            rows, self.path, query_id, batch_id, self.format, self.partition_on, self.coalesce
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.schema, self.format)


@dataclass(frozen=True)
class FileSink:
    """Files of any format Spark writes, with the columns as they come."""

    path: str
    schema: T.StructType
    format: str = "json"
    trigger_seconds: int | None = None
    coalesce: int | None = None

    def prepare(self, spark: SparkSession) -> None:
        ensure_table(spark, self.path, self.schema, self.format)

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        write_batch(
            df, self.path, query_id, batch_id, self.format, coalesce=self.coalesce
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """Read by the declared schema: JSON leaves null fields out of the files."""
        return read_table(spark, self.path, self.schema, self.format)


@dataclass
class MemorySink:
    """A named table to look at while the query runs.

    It is kept as files and not in the driver's memory, where Spark's own memory
    sink would gather every row. A stream keeps it beside its checkpoint, so a
    restart that resumes there finds the rows of the runs before; a batch keeps
    it in the scratch folder. ``snapshot`` gives what has been committed so far,
    also as a view under the query's name.
    """

    query_name: str
    query_interval: int = 10
    duration_seconds: int = 120
    path: str | None = None
    schema: T.StructType | None = None

    trigger_seconds = None

    def prepare(self, spark: SparkSession) -> None:
        self.path = self.path or scratch_path(spark, self.query_name)
        ensure_table(spark, self.path, self.schema, "parquet")

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        write_batch(df, self.path, query_id, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.schema)

    def snapshot(self, spark: SparkSession, n: int | None = None) -> DataFrame:
        table = self.read(spark)
        table.createOrReplaceTempView(self.query_name)
        return table if n is None else table.limit(n)


Sink = TableSink | FileSink | MemorySink


@dataclass
class Paced:
    """A sink that is slower than the batches it gets: it writes a range of them as one.

    Each batch is put aside in a folder of its own that readers do not see. When the sink's
    time has come, the batches after its last leaf are written as one leaf under the id of the
    newest. A range begins where the leaf before it ended, which the folders tell, so a
    batch that is replayed, or a run that goes on after a failure, writes the same range
    again. Rows that are put aside stay until the leaf after theirs is there.
    """

    spark: SparkSession
    sink: Sink
    written: float = field(default_factory=time.monotonic)
    newest: tuple[str, int] | None = None

    def resume(self, query_id: str) -> None:
        """Take up what an earlier run put aside and did not write."""
        waiting = self._ids(self._aside(query_id))
        if self.newest is None and waiting:
            self.newest = query_id, waiting[-1]

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self._aside(query_id)}/{BATCH_ID}={batch_id}")
        self.newest = query_id, batch_id
        due = time.monotonic() - self.written >= self.sink.trigger_seconds
        # A leaf of this id is there when the batch is replayed.
        if due or batch_id in self._ids(f"{self.sink.path}/{QUERY_ID}={query_id}"):
            self.flush()

    def flush(self) -> None:
        """Write what was put aside since the last leaf."""
        if self.newest is None:
            return
        query_id, batch_id = self.newest
        leaves = self._ids(f"{self.sink.path}/{QUERY_ID}={query_id}")
        last = max((i for i in leaves if i < batch_id), default=-1)
        aside = self._aside(query_id)
        waiting = [i for i in self._ids(aside) if last < i <= batch_id]
        if waiting:
            first = self.spark.read.parquet(f"{aside}/{BATCH_ID}={waiting[-1]}").schema
            rows = self.spark.read.schema(first).parquet(*[f"{aside}/{BATCH_ID}={i}" for i in waiting])
            self.sink.write(rows, query_id, batch_id)
        for done in self._ids(aside):
            if done <= last:
                self._delete(f"{aside}/{BATCH_ID}={done}")
        self.written, self.newest = time.monotonic(), None

    def _aside(self, query_id: str) -> str:
        return f"{self.sink.path.rstrip('/')}/_aside/{QUERY_ID}={query_id}"

    def _folder(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _ids(self, path: str) -> list[int]:
        """Ids of the batches that were written whole, in order."""
        folder, files = self._folder(path)
        if not files.exists(folder):
            return []
        found = []
        for entry in files.listStatus(folder):
            own = re.fullmatch(rf"{BATCH_ID}=(\d+)", entry.getPath().getName())
            done = self.spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if own and files.exists(done):
                found.append(int(own[1]))
        return sorted(found)

    def _delete(self, path: str) -> None:
        folder, files = self._folder(path)
        files.delete(folder, True)


@dataclass(frozen=True)
class SampleSink:
    """A sample of all that a stream has brought so far, without keeping the stream.

    The sample is the ``n`` rows with the smallest draw, and such samples merge: a batch
    writes the sample of the newest one and its own rows, under its own id. After any number
    of batches it equals ``sample_uniform``, or with ``weight`` ``sample_weighted``, over all rows
    with the same seed. A batch is cut by the largest draw of the sample before it, so of a long
    stream few rows are looked at twice. A batch that is replayed starts from the sample before
    it and writes the same; older samples are deleted when the next one is whole. A new query id
    starts a sample of its own, and :meth:`read` merges them.
    """

    path: str
    schema: T.StructType
    n: int
    key: str
    seed: int | str
    weight: str | None = None
    algorithm: str = "xxhash64"
    trigger_seconds: int | None = None

    def prepare(self, spark: SparkSession) -> None:
        ensure_table(spark, self.path, self.schema, "parquet")

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        spark, own = df.sparkSession, f"{self.path.rstrip('/')}/{QUERY_ID}={query_id}"
        rows = conform(df, self.schema)
        older = [b for b in folders.committed(spark, own, BATCH_ID) if b < batch_id]
        if older:
            before = spark.read.schema(self.schema).parquet(f"{own}/{BATCH_ID}={older[-1]}")
            # No more than n rows are kept, so those that come last decide for the batch.
            reached = before.agg(F.count("*"), F.max(self._draw())).first()
            if reached[0] == self.n:
                rows = rows.where(self._draw() <= F.lit(reached[1]))
            rows = before.unionByName(rows)
        self._sample(rows).write.mode("overwrite").parquet(f"{own}/{BATCH_ID}={batch_id}")
        for done in older[:-1]:
            folders.delete(spark, f"{own}/{BATCH_ID}={done}")

    def read(self, spark: SparkSession) -> DataFrame:
        newest = []
        for name in folders.names(spark, self.path):
            ids = folders.committed(spark, f"{self.path}/{name}", BATCH_ID) if name.startswith(f"{QUERY_ID}=") else []
            newest += [f"{self.path}/{name}/{BATCH_ID}={ids[-1]}"] if ids else []
        if not newest:
            return spark.createDataFrame([], self.schema)
        return self._sample(spark.read.schema(self.schema).parquet(*newest))

    def _draw(self) -> Column:
        if self.weight is None:
            return unit_hash(self.seed, named(self.key), algorithm=self.algorithm)
        return weighted_draw(self.key, self.weight, self.seed, self.algorithm)

    def _sample(self, rows: DataFrame) -> DataFrame:
        if self.weight is None:
            return sample_uniform(rows, self.n, self.key, self.seed, self.algorithm)
        return sample_weighted(rows, self.n, self.key, self.weight, self.seed, self.algorithm)
