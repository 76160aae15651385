"""A table kept by key, where an upsert reads and writes only what its source hits.

Rows lie in a fixed number of buckets by a hash of their key. An upsert is a version: one
folder with the buckets that it made again, ``version=<v>/bucket=<b>``, and a reader takes
of each bucket the newest version that was written whole. So

* a source that hits one bucket reads one bucket and writes one, whatever the table's size;
* a version shows whole or not at all, as its folder is marked by one file at the end;
* a version that is written again starts from the versions before it, so it may be repeated.

The driver holds a number for each bucket and nothing of the rows. Buckets should be of some
hundred megabytes; their number is set when the table is made.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import folders
from ..functions import named
from .upsert import upsert

_BUCKET, _VERSION = "bucket", "version"


class BucketTable:
    """A keyed table at ``path``; see :meth:`create`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        layout = spark.read.schema("keys array<string>, buckets int, columns string").json(f"{self.path}/layout").first()
        self.keys, self.buckets = list(layout["keys"]), layout["buckets"]
        self.schema = T.StructType.fromJson(json.loads(layout["columns"]))

    @classmethod
    def create(cls, df: DataFrame, path: str, keys: list[str], buckets: int) -> BucketTable:
        """A new table of the rows of ``df``. A null key matches nothing, ever."""
        clash = [c for c in df.columns if c.lower() in (_BUCKET, _VERSION)]
        if clash:
            raise ValueError(f"columns {clash} are names of the table's own folders")
        if buckets < 1:
            raise ValueError(f"a table needs a bucket, not {buckets}")
        absent = [k for k in keys if k not in df.columns]
        if absent or not keys:
            raise ValueError(f"keys {keys} are not among the columns {df.columns}")
        spark, path = df.sparkSession, path.rstrip("/")
        row = [(keys, buckets, df.schema.json())]
        written = spark.createDataFrame(row, "keys array<string>, buckets int, columns string")
        written.coalesce(1).write.json(f"{path}/layout")
        table = cls(spark, path)
        table._write(df, 0)
        return table

    def read(self) -> DataFrame:
        """All rows, as the newest whole versions have them."""
        return self._rows(self._newest())

    def upsert(self, source: DataFrame, latest: str | None = None, version: int | None = None) -> list[int]:
        """Replace and add rows as :func:`upsert` does; returns the buckets written.

        ``version`` is the number to write: that of an earlier, unfinished or finished run
        does the same again. Without it the one after the newest is taken.
        """
        done = folders.committed(self.spark, self.path, _VERSION)
        version = done[-1] + 1 if version is None else version
        if version < 1 or (done and version < done[-1]):
            raise ValueError(f"version {version} would change what version {done[-1]} was made from")
        placed = source.withColumn("__bucket", self._bucket_of())
        # At most one number for each bucket.
        hit = sorted(row[0] for row in placed.select("__bucket").distinct().collect())
        if not hit:
            return []
        newest = self._newest(before=version)
        before = self._rows({b: newest[b] for b in hit if b in newest})
        self._write(upsert(before, source, self.keys, latest), version)
        return hit

    def tidy(self) -> int:
        """Delete buckets that newer versions replace; no reader may still be on them.

        What the newest version was made from stays, so that it can be written again.
        """
        done = folders.committed(self.spark, self.path, _VERSION)
        needed = set(self._newest().items()) | set(self._newest(before=done[-1]).items())
        gone = 0
        for version in done[:-1]:
            for bucket in self._buckets_in(version):
                if (bucket, version) not in needed:
                    folders.delete(self.spark, self._leaf(bucket, version))
                    gone += 1
        return gone

    def files(self) -> dict[int, list[str]]:
        """The data files of each bucket, as a reader takes them now."""
        out = {}
        for bucket, version in self._newest().items():
            inside = folders.names(self.spark, self._leaf(bucket, version))
            out[bucket] = [f"{version}/{name}" for name in inside if not name.startswith(("_", "."))]
        return out

    def _bucket_of(self) -> Column:
        keys = [named(k).cast(self.schema[k].dataType) for k in self.keys]
        some_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
        # Rows without a key are never looked for: dealt by their content, not to one bucket.
        content = F.to_json(F.struct(*[named(f.name) for f in self.schema]))
        mix = F.when(some_null, F.xxhash64(content)).otherwise(F.xxhash64(*keys))
        return F.pmod(mix, F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, version: int) -> None:
        columns = [named(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        placed = rows.select(*columns).withColumn(_BUCKET, self._bucket_of())
        # Buckets travel whole but for those beyond the advisory size, which are divided.
        placed.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(
            f"{self.path}/{_VERSION}={version}"
        )

    def _newest(self, before: int | None = None) -> dict[int, int]:
        """The version to read of each bucket."""
        newest = {}
        for version in folders.committed(self.spark, self.path, _VERSION):
            if before is None or version < before:
                newest |= dict.fromkeys(self._buckets_in(version), version)
        return newest

    def _buckets_in(self, version: int) -> list[int]:
        found = [re.fullmatch(rf"{_BUCKET}=(\d+)", n) for n in folders.names(self.spark, f"{self.path}/{_VERSION}={version}")]
        return [int(own[1]) for own in found if own]

    def _leaf(self, bucket: int, version: int) -> str:
        return f"{self.path}/{_VERSION}={version}/{_BUCKET}={bucket}"

    def _rows(self, chosen: dict[int, int]) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._leaf(b, v) for b, v in sorted(chosen.items())])

