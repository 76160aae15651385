"""Row numbers and positional joins without a single-task sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import named
from ..session import scratch_path
from .lookup import heavy_keys

# Up to this many rows a table may be gathered and sorted by one task.
ONE_TASK_ROWS = 1_000_000
# Rows of a range, about, sampled rows for each range, and the most ranges: as many tasks sort
# at once, each with spilling. Splitters are part of the plan, so their number is bounded.
RANGE_ROWS = 4_000_000
SAMPLED = 16
MOST_RANGES = 8192


def row_id(
    df: DataFrame, *order: str | Column, name: str = "row_id", at_most: int | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, … without gaps in the given order.

    Splitters are drawn once from a sample of the order's columns and kept as a
    small table. A row finds its range among them by binary search, in every pass the
    same one, so the ranges need not be written: one pass counts the rows of each range,
    and a row's number is its position in its range plus the rows of all ranges before.
    The count reads the order's columns only.

    Ties: where a sketch finds order values that very many rows share, a hash of
    the whole row goes into the order, so such a value is cut into several ranges. Where
    very many rows are the same in all columns, one of them stands for all: it is a range of
    its own, and its copies are made again in blocks, with numbers from its count.

    ``at_most`` is for tables with a proven bound, such as a sample of n rows:
    up to ``ONE_TASK_ROWS`` they are numbered in one task, without the folder.
    """
    content = [named(f.name) for f in df.schema.fields if not _has_map(f.dataType)]
    if at_most is not None and at_most <= ONE_TASK_ROWS:
        order_by = [named(o) if isinstance(o, str) else o for o in order]
        whole = Window.orderBy(*order_by, F.xxhash64(*content))
        return df.withColumn(name, F.row_number().over(whole).cast("long") - 1)

    spark = df.sparkSession
    whole_order = [_part(spark, o) for o in order]
    directions = [_sorted(value, ascending, nulls_first) for value, ascending, nulls_first in whole_order]
    # Ranges are cut by the columns before the first nested one; the rest only sorts in a range.
    flat = next((i for i, (v, _, _) in enumerate(whole_order) if _nested(df, v)), len(order))
    parts = [_comparable(df, *part) for part in whole_order[:flat]]
    values = [value for value, _, _ in parts]
    shared = heavy_keys(df, F.xxhash64(*values)) if flat == len(order) else []
    hashed = F.xxhash64(*content)
    copied: list = []
    if shared:
        tied = df.where(F.xxhash64(*values).isin(shared))
        copied = heavy_keys(tied, hashed)
    tie = hashed if shared else F.lit(0).cast("long")

    total = df.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MOST_RANGES, max(tasks, math.ceil(total / RANGE_ROWS)))
    splitters = _splitters(df, parts, tie, ranges, total, copied)
    ranged = df.withColumn("__range", _range_of(splitters, parts, tie, bool(shared)))
    counts = _kept(spark, ranged.groupBy("__range").agg(F.count("*").alias("__rows")), "range-counts")
    # One row per range, so the broadcast is bounded by their number.
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("__base", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).cast("long"))

    columns = [named(c) for c in df.columns]
    single = ranged.where(~hashed.isin(copied)) if copied else ranged
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*directions, tie))
    out = (
        single.withColumn("__place", place)
        .join(F.broadcast(bases), "__range")
        .select(*columns, (F.col("__base") + F.col("__place") - 1).alias(name))
    )
    return out.unionByName(_copies(ranged.where(hashed.isin(copied)), bases, columns, name, total, tasks)) if copied else out


def _copies(same: DataFrame, bases: DataFrame, columns: list[Column], name: str, total: int, tasks: int) -> DataFrame:
    """Rows that are the same in all columns, made again from one of each, spread over all tasks."""
    one = same.groupBy("__range").agg(F.first(F.struct(*columns)).alias("row")).join(F.broadcast(bases), "__range")
    block = max(1, math.ceil(total / (8 * tasks)))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1, F.lit(block).cast("long")))
    blocks = one.select("row", "__base", "__rows", first.alias("__first")).repartition(tasks, "__base", "__first")
    last = F.least(F.col("__first") + block, F.col("__rows")) - 1
    each = blocks.select("row", "__base", F.explode(F.sequence("__first", last)).alias("__copy"))
    return each.select("row.*", (F.col("__base") + F.col("__copy")).alias(name))


def _part(spark: SparkSession, order: str | Column) -> tuple[Column, bool, bool]:
    """The value that an order looks at, whether it ascends, and whether nulls come first."""
    if isinstance(order, str):
        return named(order), True, True
    node = order._jc.node()
    if node.getClass().getSimpleName() != "SortOrder":
        return order, True, True
    value = Column(spark._jvm.org.apache.spark.sql.Column(node.child()))
    ascending = "Ascending" in node.sortDirection().toString()
    return value, ascending, "First" in node.nullOrdering().toString()


def _nested(df: DataFrame, value: Column) -> bool:
    return isinstance(df.select(value.alias("v")).schema["v"].dataType, (T.StructType, T.ArrayType, T.MapType))


def _comparable(df: DataFrame, value: Column, ascending: bool, nulls_first: bool) -> tuple[Column, bool, bool]:
    """Times as numbers or text of the same order, so that a splitter is the same in every time zone."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return value, ascending, nulls_first


def _sorted(value: Column, ascending: bool, nulls_first: bool) -> Column:
    if ascending:
        return value.asc_nulls_first() if nulls_first else value.asc_nulls_last()
    return value.desc_nulls_first() if nulls_first else value.desc_nulls_last()


def _kept(spark: SparkSession, frame: DataFrame, folder: str) -> DataFrame:
    path = scratch_path(spark, folder)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _splitters(df: DataFrame, parts, tie: Column, ranges: int, total: int, copied: list) -> list:
    """Places between ranges, in order, from a small stored table.

    Each row's content that is in ``copied`` gets a range of its own, between itself
    and itself ``after``.
    """
    spark = df.sparkSession
    keys = df.select(*[value.alias(f"o{i}") for i, (value, _, _) in enumerate(parts)], tie.alias("tie"))
    share = min(1.0, 1.2 * SAMPLED * ranges / max(1, total))
    by = [_sorted(F.col(f"o{i}"), up, nulls) for i, (_, up, nulls) in enumerate(parts)]
    whole = Window.orderBy(*by, "tie")
    drawn = keys.sample(share, 7).withColumns({"i": F.row_number().over(whole), "n": F.count("*").over(Window.partitionBy())})
    step = F.greatest(F.ceil(F.col("n") / ranges), F.lit(1))
    found = drawn.where((F.col("i") % step == 0) & (F.col("i") < F.col("n"))).drop("i", "n").withColumn("after", F.lit(0))
    if copied:
        points = keys.where(F.col("tie").isin(copied)).groupBy("tie").agg(
            *[F.first(f"o{i}").alias(f"o{i}") for i in range(len(parts))]
        ).select(*keys.columns, F.explode(F.array(F.lit(0), F.lit(1))).alias("after"))
        found = found.unionByName(points)
    return _kept(spark, found.distinct(), "splitters").orderBy(*by, "tie", "after").collect()


def _range_of(splitters: list, parts, tie: Column, tied: bool) -> Column:
    """How many splitters a row is not before: a binary search as nested conditions."""

    def reached(s) -> Column:
        out = F.lit(s["after"] == 0)
        if tied:
            out = F.when(tie > s["tie"], True).when(tie == s["tie"], out).otherwise(False)
        for i, (value, up, nulls_first) in reversed(list(enumerate(parts))):
            own = s[f"o{i}"]
            if own is None:
                out = F.when(value.isNull(), out).otherwise(nulls_first)
            else:
                past = value > F.lit(own) if up else value < F.lit(own)
                out = F.when(value.isNull(), not nulls_first).when(past, True).when(value == F.lit(own), out).otherwise(False)
        return out

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(reached(splitters[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(splitters))


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash, wherever in a column they are."""
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def zip_rows(
    left: DataFrame,
    right: DataFrame,
    left_order: list[str | Column],
    right_order: list[str | Column],
    name: str = "row_id",
    at_most: int | None = None,
) -> DataFrame:
    """Put two tables side by side by position, as long as the shorter one.

    Numbers are unique on both sides, so the join has no hot key.
    """
    return row_id(left, *left_order, name=name, at_most=at_most).join(
        row_id(right, *right_order, name=name, at_most=at_most), name
    )
