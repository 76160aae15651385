import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskflow.functions import unit_hash
from maskflow.operators import (
    preview,
    row_id,
    sample_uniform,
    sample_weighted,
    smallest,
    zip_rows,
)
from maskflow.operators import rows as rows_module
from maskflow.operators import sampling as sampling_module


def keys(df):
    return sorted(r.id for r in df.collect())


def test_uniform_sample_is_exact_and_repeatable(spark):
    df = spark.range(0, 5000, 1, 7)
    first = keys(sample_uniform(df, 321, "id", 1))
    assert len(first) == len(set(first)) == 321
    # Neither order nor partitions of the input matter.
    assert keys(sample_uniform(df.orderBy(F.desc("id")).repartition(3), 321, "id", 1)) == first
    assert keys(sample_uniform(df, 321, "id", 2)) != first
    drawn = df.select("id", unit_hash(1, F.col("id")).alias("u")).collect()
    assert first == sorted(r.id for r in sorted(drawn, key=lambda r: r.u)[:321])


@pytest.mark.parametrize("n", [0, 1, 10, 11])
def test_sample_of_a_small_table(spark, n):
    assert len(keys(sample_uniform(spark.range(10), n, "id", 1))) == min(n, 10)


def test_large_sample_takes_the_distributed_way(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 5)
    gathered = keys(sample_uniform(df, 700, "id", 3))
    monkeypatch.setattr(sampling_module, "ONE_TASK_ROWS", 100)
    spread = sample_uniform(df, 700, "id", 3)
    assert spread.columns == ["id"]
    assert keys(spread) == gathered


def test_smallest_with_one_value_for_most_rows(spark):
    df = spark.range(1000).withColumn(
        "m", F.when(F.col("id") < 10, F.col("id") + 1).otherwise(F.lit(50)).cast("double")
    )
    assert keys(smallest(df, 5, F.col("m"), "id")) == [0, 1, 2, 3, 4]
    assert keys(smallest(df, 400, F.col("m"), "id")) == list(range(400))


def test_smallest_leaves_out_rows_without_a_measure(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "id int, m double")
    assert keys(smallest(df, 3, F.col("m"), "id")) == [1, 3]


def test_smallest_over_the_whole_range_of_doubles(spark):
    values = [5e-324, 1e-300, 1e-12, 1.0, 3.5, 1e12, 1.7e308]
    df = spark.createDataFrame(list(enumerate(values)), "id int, m double")
    for n in range(1, len(values) + 1):
        assert keys(smallest(df, n, F.col("m"), "id")) == list(range(n))


def test_weighted_sample_never_takes_weightless_rows(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, 0.0), (3, None), (4, -1.0), (5, 1e-9)], "id int, w double"
    )
    assert keys(sample_weighted(df, 10, "id", "w", 1)) == [1, 5]


def test_inclusion_rises_with_weight(spark):
    weights = [1, 2, 4, 8]
    df = spark.createDataFrame(
        [(seed * 4 + i, seed, w) for seed in range(4000) for i, w in enumerate(weights)],
        "id int, seed int, w int",
    )
    # One row of every group of four, by the same keys sample_weighted orders by.
    key = -F.ln(unit_hash(9, F.col("id"))) / F.col("w")
    chosen = df.withColumn("k", key).groupBy("seed").agg(F.min_by("w", "k").alias("w"))
    counts = {r.w: r["count"] for r in chosen.groupBy("w").count().collect()}
    for w in weights:
        assert counts[w] / 4000 == pytest.approx(w / sum(weights), abs=0.03)


def test_preview(spark):
    df = spark.range(100)
    assert preview(df).count() == 30
    assert keys(preview(df, 5, seed=1, key="id")) == keys(preview(df, 5, seed=1, key="id"))


def test_row_id_is_gapless_in_order(spark):
    df = spark.range(0, 10_000, 1, 9).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(97)))
    found = row_id(df, "v", "id").collect()
    assert [r.row_id for r in sorted(found, key=lambda r: (r.v, r.id))] == list(range(10_000))


@pytest.fixture
def every_range(spark):
    """Small neighbouring ranges are left apart, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_row_id_with_one_value_for_a_third_of_all_rows(spark, every_range):
    df = spark.range(0, 9000, 1, 9).withColumn(
        "v", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id"))
    )
    numbered = row_id(df, "v")
    found = numbered.collect()
    assert sorted(r.row_id for r in found) == list(range(9000))
    in_order = sorted(found, key=lambda r: r.row_id)
    assert [r.v for r in in_order] == sorted(r.v for r in found)
    # The shared value is cut into several ranges.
    parts = numbered.where("v = 500").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2500


def test_row_id_with_exact_copies(spark, every_range):
    df = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("v")
    )
    numbered = row_id(df, "v")
    assert sorted(r.row_id for r in numbered.collect()) == list(range(6000))
    parts = numbered.where("v = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1


def test_row_id_of_a_bounded_table(spark, monkeypatch):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "v string")
    bounded = row_id(df, "v", at_most=3).collect()
    assert {r.v: r.row_id for r in bounded} == {None: 0, "a": 1, "b": 2}
    monkeypatch.setattr(rows_module, "ONE_TASK_ROWS", 2)
    assert {r.v: r.row_id for r in row_id(df, "v", at_most=3).collect()} == {
        None: 0, "a": 1, "b": 2,
    }


def test_row_id_of_nothing(spark):
    assert row_id(spark.range(0), "id").count() == 0


def test_zip_rows_ends_with_the_shorter_side(spark):
    left, right = spark.range(10), spark.range(100, 104).withColumnRenamed("id", "other")
    zipped = zip_rows(left, right, [F.desc("id")], ["other"])
    assert sorted(map(tuple, zipped.select("row_id", "id", "other").collect())) == [
        (i, 9 - i, 100 + i) for i in range(4)
    ]


def test_unit_hash_stays_inside_the_open_interval(spark):
    found = spark.range(20_000).select(unit_hash(1, F.col("id")).alias("u"))
    low, high, mean = found.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 < low < 0.001 and 0.999 < high < 1 and math.isclose(mean, 0.5, abs_tol=0.01)
    assert Counter(found.select(F.isnull("u")).collect())[(False,)] == 20_000


def test_weighted_sample_of_odd_weights(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, 1.0) for i in range(20)] + [(100, nan), (101, None), (102, 0.0), (103, -1.0)]
    df = spark.createDataFrame(rows, "id int, w double")
    for seed in range(5):
        assert all(r.id < 20 for r in sample_weighted(df, 1, "id", "w", seed).collect())
    assert sample_weighted(df, 50, "id", "w", 1).count() == 20
    more = df.unionAll(spark.createDataFrame([(200, inf), (201, 1e-320)], "id int, w double"))
    first = [r.id for r in sample_weighted(more, 1, "id", "w", 3).collect()]
    assert first == [200]
    assert {r.id for r in sample_weighted(more, 50, "id", "w", 3).collect()} == {*range(20), 200, 201}


def test_row_id_with_maps_inside(spark):
    df = spark.sql("select id, array(map('a', id)) as m, struct(map(id, 1) as x) as s from range(5)")
    assert sorted(r.row_id for r in row_id(df, "id").collect()) == [0, 1, 2, 3, 4]


def test_row_id_by_times_nested_values_and_directions(spark):
    df = spark.sql(
        """select id, timestamp_ntz '2024-03-31 02:30:00' + make_dt_interval(0, 0, 0, id % 50) as t, array(id % 7, id) as a,
                  if(id % 5 = 0, null, id % 11) as v, struct(id) as s from range(0, 3000, 1, 5)"""
    )
    last, first = (lambda r: (r.v is None, -(r.v or 0))), (lambda r: (r.v is not None, -(r.v or 0)))
    cases = [
        (["t", "id"], lambda r: (r.t, r.id)),
        (["a"], lambda r: tuple(r.a)),
        (["v", "s"], lambda r: (r.v is not None, r.v or 0, r.id)),
        ([F.desc("v"), "id"], lambda r: (*last(r), r.id)),
        ([F.desc_nulls_first("v"), F.desc("id")], lambda r: (*first(r), -r.id)),
        ([F.col("id") % 13, "id"], lambda r: (r.id % 13, r.id)),
    ]
    for order, key in cases:
        found = row_id(df, *order).collect()
        assert [r.row_id for r in sorted(found, key=key)] == list(range(3000)), order


def test_row_id_writes_splitters_and_counts_only(spark, monkeypatch, tmp_path):
    written = []
    monkeypatch.setattr(rows_module, "scratch_path", lambda s, name: written.append(f"{tmp_path}/{name}{len(written)}") or written[-1])
    df = spark.range(0, 200_000, 1, 8).withColumn("v", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")))
    assert row_id(df, "v").agg(F.sum("row_id")).first()[0] == 200_000 * 199_999 // 2
    assert sum(spark.read.parquet(p).count() for p in written) < 100
