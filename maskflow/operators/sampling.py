"""Exact samples without replacement, repeatable by seed.

Every row gets a number from a hash of the seed and its key, and the sample is
the n rows with the smallest number. ``key`` should identify a row: rows that
share a key also share their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import named, unit_hash
from .rows import ONE_TASK_ROWS, row_id

_DRAW = "__draw"
_LEVELS_PER_OCTAVE = 16
_LAST_LEVEL = 1 << 20  # above every level a double can have
_LEAST = 2.2250738585072014e-308  # of normal doubles


def sample_uniform(
    df: DataFrame, n: int, key: str, seed: int | str, algorithm: str = "xxhash64"
) -> DataFrame:
    """n rows, all equally likely; all rows when there are fewer.

    ``algorithm`` is that of ``unit_hash``: ``md5`` for draws that another
    engine is to repeat.
    """
    return smallest(df, n, unit_hash(seed, named(key), algorithm=algorithm), key)


def sample_weighted(
    df: DataFrame,
    n: int,
    key: str,
    weight: str,
    seed: int | str,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """n rows, drawn one after the other with chances in proportion to weight.

    Exponential keys (Efraimidis and Spirakis 2006): -ln(u) / weight, smallest
    first. Rows whose weight is null, NaN, zero or negative are never chosen;
    rows of infinite weight come before all others.
    """
    w = named(weight).cast("double")
    drawn = weighted_draw(key, weight, seed, algorithm)
    return smallest(df.where((w > 0) & ~F.isnan(w)), n, drawn, key)


def weighted_draw(key: str, weight: str, seed: int | str, algorithm: str = "xxhash64") -> Column:
    """The exponential key of a row with a positive weight; the smallest are drawn."""
    # The smallest of doubles stands for zero, so an infinite weight has a measure too,
    # and the greatest one for what a tiny weight would make infinite.
    # A filter on the draw may run before that on the weight, so zero must not be an error.
    drawn = F.try_divide(-F.ln(unit_hash(seed, named(key), algorithm=algorithm)), named(weight).cast("double"))
    return F.greatest(F.least(drawn, F.lit(1.7976931348623157e308)), F.lit(_LEAST))


def smallest(df: DataFrame, n: int, measure: Column, *ties: str) -> DataFrame:
    """The n rows with the smallest positive measure, exactly.

    A plain sort-and-limit sends n rows of every input partition to one task.
    Here a first pass counts the rows on a logarithmic scale of the measure,
    reading only the columns it needs; the second pass keeps the levels up to
    the one that reaches n, so about 1.05 n rows are left to sort in all. The
    counts are exact, so this holds for every distribution of the measure.
    """
    measured = df.withColumn(_DRAW, measure)
    level = F.floor(F.log2(F.col(_DRAW)) * _LEVELS_PER_OCTAVE)
    # Rows without a measure count last, and the second pass leaves them out.
    counted = F.coalesce(level, F.lit(_LAST_LEVEL))
    counts = measured.groupBy(counted.alias("level")).agg(F.count("*").alias("n"))
    # A double has a few thousand levels at most, whatever the table's size.
    running = F.sum("n").over(Window.orderBy("level"))
    enough = (
        counts.withColumn("upto", running)
        .where(F.col("upto") >= n)
        .agg(F.min("level"))
    )
    last = F.coalesce(enough.scalar(), F.lit(_LAST_LEVEL))
    near = measured.where(level <= last)
    if n <= ONE_TASK_ROWS:
        return near.orderBy(_DRAW, *ties).limit(n).drop(_DRAW)
    return row_id(near, _DRAW, *ties, name="__rank").where(F.col("__rank") < n).drop(
        _DRAW, "__rank"
    )


def preview(
    df: DataFrame,
    n: int = 30,
    seed: int | str | None = None,
    key: str | None = None,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """n random rows to look at; the same ones again when seed and key are given."""
    if seed is not None and key is not None:
        return sample_uniform(df, n, key, seed, algorithm)
    return df.orderBy(F.rand(seed)).limit(n)
