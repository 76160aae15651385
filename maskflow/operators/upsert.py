"""Update-all / insert-all of one table by another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import named


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], latest: str | None = None
) -> DataFrame:
    """The target after every source row replaced its match or was added.

    Columns are those of the target, taken from the source by name. A null key
    matches nothing: the target row stays and the source row is added. A key
    must not come twice in the source, as two rows cannot replace one: with
    ``latest`` the row with the greatest value of that column is taken, otherwise
    repeated keys are an error.
    """
    if latest is not None:
        source = _latest(source, keys, latest)
    else:
        whole = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])
        repeated = source.where(whole).groupBy(*[named(k) for k in keys]).count().where("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"the source has several rows for one value of {keys}")
    columns = [named(c) for c in target.columns]
    match = reduce(
        lambda a, b: a & b,
        [F.col("t." + _quoted(k)) == F.col("s." + _quoted(k)) for k in keys],
    )
    arriving = source.select(*[named(k) for k in keys])
    kept = target.alias("t").join(arriving.alias("s"), match, "left_anti")
    return kept.select(*columns).unionByName(source.select(*columns))


def _latest(source: DataFrame, keys: list[str], latest: str) -> DataFrame:
    """One row per key; rows with a null in their key are all kept."""
    whole = reduce(lambda a, b: a & b, [named(k).isNotNull() for k in keys])
    row = F.struct(*[named(c) for c in source.columns])
    # Combined before the shuffle; rows of equal rank are told apart by their content.
    newest = F.max_by(row, F.struct(named(latest), F.xxhash64(*[named(c) for c in source.columns])))
    kept = source.where(whole).groupBy(*[named(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    return kept.agg(newest.alias("row")).select("row.*").unionByName(source.where(~whole))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
