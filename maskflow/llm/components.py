"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.llm.tables import drop_stored, stored


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) with the least of u and its neighbours; combined before the shuffle."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each of ``pairs`` of columns: ``rows`` stand in the plan once."""
    both = F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in pairs))
    return rows.select(F.explode(both).alias("pair")).select("pair.u", "pair.v")


def _large_star(edges: DataFrame) -> DataFrame:
    both = _each(edges, ("u", "v"), ("v", "u"))
    return _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _each(_least(down), ("v", "m"), ("u", "m")).filter("u != v")


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the least node that each node with an edge can reach.

    Each round is two group-and-join steps over the edges. Either is written to the
    shared folder, so that no plan holds more than one of them, however many read it;
    the number of rounds grows with the logarithm of the size of a component. Loops
    and repeated edges are allowed, null ends are ignored.
    """
    pairs = (
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter("u is not null and v is not null and u != v")
        .distinct()
    )
    pairs = stored(spark, pairs, "edges")
    mark = None
    while True:
        large = stored(spark, _large_star(pairs), "edges")
        step = stored(spark, _small_star(large).distinct(), "edges")
        new = step.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        drop_stored(spark, pairs, large)
        pairs = step
        if tuple(new) == mark:
            break
        mark = tuple(new)
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    ).dropDuplicates(["node"])
