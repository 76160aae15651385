"""Grouped reductions that hold up when one group has most of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import named
from ..session import scratch_path

#: Parts of a histogram's round, rows beyond n that may be ranked, and bytes of a name looked at.
PARTS, SLACK, LONGEST = 4096, 1_000, 256


def most_common(df: DataFrame, key: str, value: str) -> DataFrame:
    """The value that occurs most often for each key; the smallest one on a tie.

    Null keys are left out and null values are not counted, so a key with null
    values only gets null. Counting per (key, value) first lets every map task
    combine its rows, so a key with very many rows or values stays spread out.
    """
    counted = (
        df.where(named(key).isNotNull())
        .groupBy(named(key), named(value))
        .agg(F.count(named(value)).alias("__n"))
    )
    # Fewer occurrences sort later; at equal counts the smaller value comes first.
    rank = F.struct((-F.col("__n")).alias("n"), named(value).alias("v"))
    best = counted.groupBy(named(key)).agg(F.min(rank).alias("__best"))
    return best.select(named(key), F.col("__best.v").alias(value))


def n_rarest(df: DataFrame, group: str, name: str, measure: str, n_by_group: dict) -> DataFrame:
    """For each listed group, the n names whose greatest measure is smallest.

    Returns ``(group, name, peak)``; ties are settled by name. Groups are few and
    large, so the n-th place of each is narrowed down by histograms, all groups at once:
    by a logarithmic scale of the measure, then by equal parts of what is left, and where
    only one measure is left by the bytes of the names. Each round counts about ``PARTS``
    parts of a group, and the last one leaves n rows and ``SLACK`` more to be ranked.
    """
    wanted = {g: n for g, n in n_by_group.items() if n > 0}
    peaks = (
        df.where(named(group).isin(list(wanted)))
        .groupBy(named(group), named(name))
        .agg(F.max(named(measure)).alias("peak"))
        .where(F.col("peak").isNotNull() & named(name).isNotNull())
    )
    spark = df.sparkSession
    path = scratch_path(spark, "peaks")
    peaks.write.parquet(path)
    stored = spark.read.schema(peaks.schema).parquet(path)
    near = F.lit(False)
    for g, place in _nth(stored, group, name, wanted).items():
        near = near | ((named(group) == F.lit(g)) & place)
    overall = Window.partitionBy(named(group)).orderBy(F.col("peak"), named(name))
    limit = F.lit(None).cast("int")
    for g, n in wanted.items():
        limit = F.when(named(group) == F.lit(g), F.lit(n)).otherwise(limit)
    # The literal lets every task keep its first rows only.
    return (
        stored.where(near)
        .withColumn("__rank", F.row_number().over(overall))
        .where((F.col("__rank") <= max(wanted.values(), default=0)) & (F.col("__rank") <= limit))
        .select(named(group), named(name), "peak")
    )


def _nth(peaks: DataFrame, group: str, name: str, wanted: dict) -> dict:
    """For each group a condition that holds for its first n rows, and for ``SLACK`` more at most.

    ``below`` are rows already known to come first; ``inside`` is where the n-th lies.
    """
    peak, number = F.col("peak"), F.col("peak").cast("double")
    names = F.hex(named(name).cast("string"))
    text = isinstance(peaks.select(named(name)).schema[0].dataType, T.StringType)
    need = dict(wanted)
    below = {g: F.lit(False) for g in wanted}
    inside = {g: F.lit(True) for g in wanted}
    part = {g: _level(number) for g in wanted}
    stage, prefix = dict.fromkeys(wanted, "measure"), dict.fromkeys(wanted, "")
    left = set(wanted)
    while left:
        place, within = F.lit(None).cast("string"), F.lit(False)
        for g in left:
            own = named(group) == F.lit(g)
            place = F.when(own, part[g].cast("string")).otherwise(place)
            within = within | (own & inside[g])
        counts = (
            peaks.where(within).groupBy(named(group).alias("g"), place.alias("part"))
            .agg(F.count("*").alias("n"), F.min("peak").alias("low"), F.max("peak").alias("high")).collect()
        )
        for g in list(left):
            rows = [r for r in counts if r.g == g]
            rows.sort(key=lambda r: r.part if stage[g] == "name" else int(r.part))
            last = None
            for last in rows:
                if last.n >= need[g]:
                    break
                need[g] -= last.n
            else:
                # There are n rows or fewer: all of them.
                below[g] = below[g] | inside[g]
                inside[g] = F.lit(False)
                left.discard(g)
                continue
            if stage[g] == "measure":
                first = F.lit(last.part).cast("long")
                below[g] = below[g] | (inside[g] & (part[g] < first))
                inside[g] = inside[g] & (part[g] == first)
            else:
                below[g] = below[g] | (inside[g] & (part[g] < F.lit(last.part)))
                inside[g] = inside[g] & (part[g] == F.lit(last.part))
                prefix[g] += last.part
            if last.n <= need[g] + SLACK:
                left.discard(g)
                continue
            low, high = float(last.low), float(last.high)
            if stage[g] == "measure" and last.low != last.high and low < high and math.isfinite(high - low):
                step = (high - low) / PARTS
                part[g] = F.floor((number - F.lit(low)) / F.lit(step)).cast("long") if step > 0 else _exact(peak, last)
            elif (last.low == last.high or (low != low and high != high)) and text and len(prefix[g]) < 2 * LONGEST:
                # One measure, many names: by their next two bytes.
                stage[g] = "name"
                part[g] = F.substr(names, F.lit(len(prefix[g]) + 1), F.lit(4))
            else:
                left.discard(g)
    return {g: below[g] | inside[g] for g in wanted}


def _exact(peak: Column, row) -> Column:
    """Two parts where the measures left are too close for more."""
    return F.when(peak == F.lit(row.low), 0).otherwise(1).cast("long")


def _level(value: Column) -> Column:
    """A number of some thousand values that rises with ``value``: sign, then magnitude."""
    size = F.greatest(F.floor(F.log2(F.abs(value)) * 16) + 20_000, F.lit(1)).cast("long")
    infinite = F.abs(value) == float("inf")
    size = F.when(infinite, F.lit(50_000)).otherwise(size)
    return (
        F.when(F.isnan(value), F.lit(60_000))
        .when(value > 0, size)
        .when(value < 0, -size)
        .otherwise(F.lit(0))
        .cast("long")
    )
