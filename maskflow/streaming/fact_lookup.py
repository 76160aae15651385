"""A lookup of most common values, kept up to date by batches of facts.

Facts are counted per (key, value) and a batch of them adds its counts, so no fact is read
twice. A published lookup is a version of its own; a stream takes the newest one at the
start of a micro-batch and keeps it to the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import folders
from ..functions import named
from ..operators import Lookup, prepare_lookup
from .tables import ensure_table, merge_batches, read_table, write_batch

_N, _VERSION = "__n", "version"


@dataclass
class FactLookup:
    """Counts and published lookups of one (key, value) below ``path``."""

    path: str
    key: T.StructField
    value: T.StructField
    trigger_seconds: int | None = None
    _pinned: tuple[int, Lookup] | None = field(default=None, repr=False)

    @property
    def _counts(self) -> tuple[str, T.StructType]:
        return f"{self.path.rstrip('/')}/counts", T.StructType([self.key, self.value, T.StructField(_N, T.LongType())])

    def prepare(self, spark: SparkSession) -> None:
        ensure_table(spark, *self._counts, "parquet")

    def write(self, df: DataFrame, query_id: str, batch_id: int) -> None:
        """Add the counts of a batch; the same batch again changes nothing.

        Facts without a key are left out. A value that is null is counted as none, so a key
        with null values only is known and gets null.
        """
        key, value = named(self.key.name), named(self.value.name)
        facts = df.where(key.isNotNull()).select(
            key.cast(self.key.dataType).alias(self.key.name), value.cast(self.value.dataType).alias(self.value.name)
        )
        counted = facts.groupBy(key, value).agg(F.count(value).alias(_N))
        write_batch(counted, self._counts[0], query_id, batch_id)

    def latest(self, spark: SparkSession) -> DataFrame:
        """The most common value of each key over all batches; the smallest one on a tie."""
        key, value = named(self.key.name), named(self.value.name)
        counted = read_table(spark, *self._counts).groupBy(key, value).agg(F.sum(_N).alias(_N))
        # A null value never wins over one that occurs.
        rank = F.struct((-F.col(_N)).alias("n"), value.alias("v"))
        best = counted.groupBy(key).agg(F.min(rank).alias("best"))
        return best.select(key, F.col("best.v").alias(self.value.name))

    def publish(self, spark: SparkSession) -> int:
        """Write the lookup as it is now under the next version, which readers then take."""
        version = max(self.versions(spark), default=0) + 1
        self.latest(spark).write.mode("overwrite").parquet(self._at(version))
        return version

    def versions(self, spark: SparkSession) -> list[int]:
        return folders.committed(spark, f"{self.path.rstrip('/')}/lookup", _VERSION)

    def current(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """A published lookup, the newest one unless a version is given."""
        version = version or max(self.versions(spark), default=0)
        if not version:
            return spark.createDataFrame([], T.StructType([self.key, self.value]))
        return spark.read.schema(T.StructType([self.key, self.value])).parquet(self._at(version))

    def per_batch(self, apply: Callable[[DataFrame, Lookup], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        """``apply(batch, lookup)`` with the newest version, measured once per version.

        For the ``prepare`` of a stream: a version that is published while a micro-batch
        runs is seen by the next one.
        """

        def run(batch: DataFrame) -> DataFrame:
            spark = batch.sparkSession
            newest = max(self.versions(spark), default=0)
            if self._pinned is None or self._pinned[0] != newest:
                rows = self.current(spark, newest)
                self._pinned = newest, prepare_lookup(rows, self.key.name, self.value.name, "error", salts=1)
            return apply(batch, self._pinned[1])

        return run

    def tidy(self, spark: SparkSession, keep: int = 2) -> None:
        """Merge old counts and delete all but the newest ``keep`` versions."""
        merge_batches(spark, *self._counts)
        for version in self.versions(spark)[: -max(keep, 1)]:
            folders.delete(spark, self._at(version))

    def _at(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/lookup/{_VERSION}={version}"
