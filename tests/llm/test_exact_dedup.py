import uuid

import __spark_entry__ as driver
from maskflow.llm.exact_dedup import dedup_batch, keep_first
from maskflow.session import scratch_path
from tests.llm.conftest import TEXTS, clashing
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.01"


def index(spark):
    return f"digests_{uuid.uuid4().hex}", scratch_path(spark, "index")


def test_query_matches_sql(spark):
    name = "op2_exact_dedup"
    assert_same(driver.queries()[name](spark, SF), connect(SF), driver.oracle_sql()[name])


def test_nulls_spaces_and_repeated_rows(spark):
    rows = [(1, "a b"), (2, "a \t b"), (None, "a\nb"), (3, None), (4, ""), (1, "a b"), (None, "q"), (None, "r")]
    df = clashing(spark.createDataFrame(rows, TEXTS))
    found = dedup_batch(spark, df, *index(spark)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert (by_id[2].keep_id, by_id[2].group_size, by_id[2].kept) == (1, 4, False)
    assert (by_id[4].keep_id, by_id[4].kept) == (3, False)
    kept = keep_first(spark, df, *index(spark))
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "q"), (0, "r"), (1, "a b"), (3, "")]


def test_batches_meet_the_same_index(spark):
    table, path = index(spark)
    first = spark.createDataFrame([(5, "x"), (6, "y")], TEXTS)
    second = spark.createDataFrame([(1, "x"), (7, "z"), (8, "z")], TEXTS)
    assert keep_first(spark, first, table, path).count() == 2
    found = {r.doc_id: (r.keep_id, r.kept) for r in dedup_batch(spark, second, table, path).collect()}
    assert found == {1: (5, False), 7: (7, True), 8: (7, False)}
    assert keep_first(spark, second, table, path).count() == 1  # run again: 7 stays what it was
    assert spark.table(table).count() == 3
    # The index outlives the catalog's entry.
    spark.sql(f"DROP TABLE {table}")
    assert keep_first(spark, first, f"{table}_again", path).count() == 2


def test_anti_join_reads_the_index_by_bucket(spark):
    table, path = index(spark)
    keep_first(spark, spark.createDataFrame([(1, "x")], TEXTS), table, path)
    plan = spark.table(table).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], TEXTS)
    assert dedup_batch(spark, df, *index(spark)).count() == 0
    assert keep_first(spark, df, *index(spark)).count() == 0


def test_a_group_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', cast(id as string)) as text")
    found = dedup_batch(spark, df, *index(spark))
    assert found.filter("kept").count() == 20_001
    assert found.filter("group_size = 10000 and keep_id = 0").count() == 10_000
