"""One key holds a third of all rows: is its work divided, and the result whole?"""

import pytest
from pyspark.sql import functions as F

from maskflow.operators import lookup as lookup_module
from maskflow.operators import prepare_lookup, translate

ROWS = 60_000
HOT = -1


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which these tables count as large."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def records(spark):
    key = F.when(F.col("id") % 3 == 0, HOT).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, ROWS, 1, 24).select("id", key.alias("k"))


@pytest.fixture
def table(spark):
    return spark.range(-1, ROWS).select(
        F.col("id").alias("key"), F.concat(F.lit("v"), F.col("id")).alias("value")
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def expected(records):
    value = F.when(F.col("k").isNotNull(), F.concat(F.lit("v"), F.col("k")))
    return sorted(map(tuple, records.select("id", "k", value).collect()))


def test_adaptive_execution_splits_the_hot_key(spark, small_partitions, records, table):
    out = translate(records, "k", "v", table, "key", "value", broadcast_limit=0, hot_share=None)
    assert sorted(map(tuple, out.collect())) == expected(records)
    assert "SortMergeJoin(skew=true)" in final_plan(out)


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("cache", [False, True])
@pytest.mark.parametrize("budget", [0, 16 << 30])
def test_hot_keys_are_broadcast_at_any_size(spark, records, table, monkeypatch, adaptive, cache, budget):
    """With or without adaptive execution, pinned or not, with or without room for copies."""
    monkeypatch.setattr(lookup_module, "REPLICATION_BUDGET_BYTES", budget)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    lookup = prepare_lookup(table, "key", "value", broadcast_limit=0, cache=cache)
    try:
        out = translate(records, "k", "v", lookup)
        assert sorted(map(tuple, out.collect())) == expected(records)
        if adaptive == "false":
            assert largest_share(out) < 0.15
            # The lookup's rows of hot keys, and no others.
            assert "BroadcastHashJoin" in final_plan(out)
    finally:
        lookup.close()
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sketch_names_every_hot_key(spark):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("hot"), F.col("id") % 100)).otherwise(F.col("id").cast("string")).alias("k")
    )
    found = set(lookup_module.heavy_keys(rows, F.col("k")))
    assert {f"hot{k}" for k in range(0, 100, 4)} <= found and len(found) < 40
    assert lookup_module.heavy_keys(rows.where("false"), F.col("k")) == []
    assert lookup_module.heavy_keys(rows.select(F.array("k").alias("k")), F.col("k"))


def test_hot_keys_missing_from_the_lookup_and_with_several_rows(spark, records):
    table = spark.createDataFrame([(HOT, "a"), (HOT, None), (1, "b"), (4, None)], "key long, value string")
    for share in (lookup_module.HOT_SHARE, None):
        lookup = prepare_lookup(table, "key", "value", broadcast_limit=0, hot_share=share, salts=1)
        counts = {r["v"]: r["count"] for r in translate(records, "k", "v", lookup).groupBy("v").count().collect()}
        assert counts == {"a": 20_000, None: 60_000 - 1, "b": 1}
    absent = prepare_lookup(table.where("key > 0"), "key", "value", broadcast_limit=0)
    assert translate(records, "k", "v", absent).where("v is null").count() == ROWS - 1


def test_salts_spread_the_hot_key_without_it(spark, records, table):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        out = translate(records, "k", "v", table, "key", "value", broadcast_limit=0)
        assert sorted(map(tuple, out.collect())) == expected(records)
        # A third of the rows has one key and a third has none.
        assert largest_share(out) < 0.15
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_pinned_lookup_is_laid_out_once(spark, records, table):
    lookup = prepare_lookup(table, "key", "value", broadcast_limit=0, cache=True, hot_share=None)
    assert lookup.salts > 1
    out = translate(records, "k", "v", lookup)
    assert sorted(map(tuple, out.collect())) == expected(records)
    plan = final_plan(out)
    joined = plan[plan.index("SortMergeJoin") : plan.index("Initial Plan")]
    # Only the records are shuffled; the lookup is read as it was laid out.
    outside_the_cache = joined[: joined.index("InMemoryRelation")]
    assert outside_the_cache.count("Exchange hashpartitioning") == 1
    lookup.close()


def test_hot_key_in_the_lookup_is_divided_into_chunks(spark, small_partitions, table):
    hot = spark.range(0, 20_000).select(F.lit(HOT).alias("key"), F.lit("x").alias("value"))
    lookup = prepare_lookup(
        table.where("key >= 0").unionByName(hot.select(F.col("key").cast("long"), "value")),
        "key", "value", broadcast_limit=0, group_rows=1000, mark_first=False,
    )
    assert lookup.chunks.collect()[0]["__lookup_chunks"] == 20
    per_chunk = lookup.rows.where(F.col("__lookup_key") == HOT).groupBy("__lookup_chunk").count()
    assert per_chunk.agg(F.max("count")).first()[0] < 1500
    records = spark.createDataFrame([(1, HOT), (2, 5), (3, None)], "id int, k long")
    out = translate(records, "k", "v", lookup)
    counts = {r.id: r["count"] for r in out.groupBy("id").count().collect()}
    assert counts == {1: 20_000, 2: 1, 3: 1}
