"""Tables that grow by batches: buckets by key, merged leaves, running samples, lookups of facts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow import catalog, folders
from maskflow.operators import BucketTable, sample_uniform, sample_weighted, translate
from maskflow.plans.pipeline import _check_steps, canonical_steps
from maskflow.sources import flag_malformed, with_reasons
from maskflow.streaming import FactLookup, SampleSink, merge_batches, read_table, write_batch


def rows(df):
    return Counter(map(tuple, df.collect()))


# --- a table by key ---------------------------------------------------------------


def test_upsert_writes_only_the_buckets_it_hits(spark, tmp_path):
    # A third of the rows has no key; they are spread and never replaced.
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"), F.col("id").alias("n"))
    kept = BucketTable.create(df, f"{tmp_path}/t", ["id"], 8)
    before = kept.files()
    assert len(before) == 8
    nulls = kept.read().where("id is null")
    assert nulls.count() == 100 and nulls.select(F.input_file_name()).distinct().count() > 4
    source = spark.createDataFrame([(-1, 4), (-2, 1000), (-3, None)], "n long, id long")
    hit = kept.upsert(source)
    after = kept.files()
    assert {b for b in after if after[b] != before.get(b)} == set(hit)
    expected = {(k if k % 3 else None, k) for k in range(300)} - {(4, 4)} | {(4, -1), (1000, -2), (None, -3)}
    assert rows(kept.read()) == Counter(expected)


def test_a_version_written_again_changes_nothing(spark, tmp_path):
    df = spark.range(50).withColumn("v", F.lit("old"))
    kept = BucketTable.create(df, f"{tmp_path}/t", ["id"], 4)
    source = spark.createDataFrame([(1, "new"), (99, "new")], "id long, v string")
    kept.upsert(source, version=1)
    once = rows(kept.read())
    kept.upsert(source, version=1)
    assert rows(BucketTable(spark, f"{tmp_path}/t").read()) == once
    kept.upsert(spark.createDataFrame([(1, "newer")], "id long, v string"), version=2)
    with pytest.raises(ValueError, match="would change"):
        kept.upsert(source, version=1)
    assert kept.tidy() >= 0
    kept.upsert(spark.createDataFrame([(1, "newer")], "id long, v string"), version=2)
    assert rows(kept.read())[(1, "newer")] == 1 and kept.read().count() == 51


def test_an_order_numbered_zero_and_its_mirror_are_two_rows(spark, tmp_path):
    orders = [(0, 7, "O"), (1, 7, "F"), (2, 8, "O"), (10, 9, "P")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    expected = [(0, 7, "two"), (1, 7, "F"), (2, 8, "one"), (10, 9, "two"), (0, 7, "one"), (-2, 8, "one"), (-10, 9, "one")]
    assert rows(catalog.upsert_versions(spark, str(tmp_path))) == Counter(expected)


def test_a_version_that_is_not_whole_is_not_seen(spark, tmp_path):
    kept = BucketTable.create(spark.range(20), f"{tmp_path}/t", ["id"], 2)
    kept.upsert(spark.range(20, 40))
    folders.delete(spark, f"{tmp_path}/t/version=1/_SUCCESS")
    assert kept.read().count() == 20
    kept.upsert(spark.range(20, 40))
    assert kept.read().count() == 40


def test_tables_by_key_of_odd_shape(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, `b.c` string")
    kept = BucketTable.create(empty, f"{tmp_path}/e", ["a", "b.c"], 3)
    assert kept.read().count() == 0 and kept.upsert(empty) == []
    kept.upsert(spark.createDataFrame([(1, "x"), (1, None), (1, None)], "a int, `b.c` string"))
    assert rows(kept.read()) == Counter({(1, "x"): 1, (1, None): 2})
    twice = spark.createDataFrame([(1, "x"), (1, "x")], "a int, `b.c` string")
    with pytest.raises(ValueError, match="several rows"):
        kept.upsert(twice)
    for df, keys in ((empty.withColumn("Bucket", F.lit(1)), ["a"]), (empty, ["z"]), (empty, [])):
        with pytest.raises(ValueError):
            BucketTable.create(df, f"{tmp_path}/bad", keys, 2)


# --- merged leaves ------------------------------------------------------------------


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_two_hundred_leaves_become_a_few(spark, tmp_path, format):
    schema = T.StructType.fromDDL("id long, at timestamp_ntz, query_id string, batch_id int")
    path = f"{tmp_path}/t"
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00.123456'").alias("at")
    for number in range(30):
        write_batch(spark.range(number * 3, number * 3 + 3).coalesce(1).select("id", at), path, "a b", number, format)
    write_batch(spark.range(3).select("id", at), path, "other", 0, format)
    before = rows(read_table(spark, path, schema, format))
    assert merge_batches(spark, path, schema, format) == {"a b": 29}
    assert rows(read_table(spark, path, schema, format)) == before and sum(before.values()) == 93
    assert folders.committed(spark, f"{path}/query_id=a b", "batch_id") == [29]
    # A batch of the range comes again, then new ones, then another merge.
    write_batch(spark.range(3).select("id", at), path, "a b", 0, format)
    assert rows(read_table(spark, path, schema, format)) == before
    write_batch(spark.range(500, 501).select("id", at), path, "a b", 30, format)
    assert merge_batches(spark, path, schema, format) == {"a b": 1}
    assert merge_batches(spark, path, schema, format) == {}
    found = read_table(spark, path, schema, format)
    assert found.count() == 94 and found.where("batch_id = 7 and query_id = 'a b'").count() == 3
    with pytest.raises(ValueError):
        merge_batches(spark, path, schema, format, keep=0)


def test_leaves_left_by_a_merge_that_failed_are_passed_over(spark, tmp_path, monkeypatch):
    schema = T.StructType.fromDDL("id long, kind string, query_id string, batch_id int")
    path = f"{tmp_path}/t"
    for number in range(5):
        df = spark.range(number, number + 2).withColumn("kind", F.lit(f"k{number % 2}"))
        write_batch(df, path, "q", number, partition_on="kind")
    before = rows(read_table(spark, path, schema))
    with monkeypatch.context() as m:
        m.setattr(folders, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            merge_batches(spark, path, schema, partition_on="kind")
    assert len(folders.committed(spark, f"{path}/query_id=q", "batch_id")) == 5
    assert rows(read_table(spark, path, schema)) == before
    merge_batches(spark, path, schema, partition_on="kind")
    assert len(folders.committed(spark, f"{path}/query_id=q", "batch_id")) == 1
    assert rows(read_table(spark, path, schema)) == before


# --- running samples ----------------------------------------------------------------


@pytest.mark.parametrize("weight", [None, "w"])
def test_a_running_sample_equals_that_of_all_rows(spark, tmp_path, weight):
    odd = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, 0.0).otherwise(F.col("id") % 5 + 1.0)
    df = spark.range(2_000).withColumn("w", odd.cast("double"))
    sink = SampleSink(f"{tmp_path}/s", df.schema, 50, "id", 3, weight)
    sink.prepare(spark)
    assert sink.read(spark).count() == 0
    seen = None
    for number in (0, 1, 1, 2, 3, 4):
        part = df.where(F.col("id") % 5 == number)
        sink.write(part if number < 3 else part.where("id >= 0"), "q", number)
        seen = df.where(F.col("id") % 5 <= number)
        whole = sample_uniform(seen, 50, "id", 3) if weight is None else sample_weighted(seen, 50, "id", weight, 3)
        assert rows(sink.read(spark)) == rows(whole)
    sink.write(df.limit(0), "q", 5)
    assert rows(sink.read(spark)) == rows(whole)
    # The sample before the newest stays for a replay; older ones are gone.
    assert folders.committed(spark, f"{tmp_path}/s/query_id=q", "batch_id") == [4, 5]


# --- lookups of facts -----------------------------------------------------------------


def test_a_stream_takes_a_new_lookup_at_a_batch_border(spark, tmp_path):
    key, value = T.StructField("k", T.LongType()), T.StructField("v", T.StringType())
    lookup = FactLookup(f"{tmp_path}/l", key, value)
    lookup.prepare(spark)
    facts = lambda *pairs: spark.createDataFrame(list(pairs), "k long, v string")
    assert lookup.current(spark).count() == 0
    lookup.write(facts((1, "a"), (2, None), (None, "z")), "f", 0)
    lookup.publish(spark)
    assert rows(lookup.current(spark)) == Counter({(1, "a"): 1, (2, None): 1})
    data = f"{tmp_path}/in"
    spark.range(1, 3).coalesce(1).write.parquet(f"{data}/n=1")
    out = []
    apply = lookup.per_batch(lambda batch, now: translate(batch, "id", "v", now))

    def write(batch, number):
        found = apply(batch)
        lookup.write(facts((1, "b"), (1, "b"), (2, "c")), "f", 1)
        lookup.publish(spark)
        out.append(sorted((r["id"], r["v"]) for r in found.collect()))

    for turn in range(2):
        stream = spark.readStream.schema("id long").parquet(f"{data}/*")
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/c").trigger(
            availableNow=True
        ).start().awaitTermination()
        if turn == 0:
            spark.range(1, 3).coalesce(1).write.parquet(f"{data}/n=2")
    assert out == [[(1, "a"), (2, None)], [(1, "b"), (2, "c")]]
    lookup.tidy(spark)
    assert len(lookup.versions(spark)) == 2
    assert rows(lookup.latest(spark)) == Counter({(1, "b"): 1, (2, "c"): 1})


# --- reasons ---------------------------------------------------------------------------


def test_reasons_name_the_fields_that_do_not_fit(spark):
    schema = T.StructType.fromDDL("id long, name string, v double, `a'b` boolean, t timestamp_ntz")
    expected = {
        '{"id":1,"name":"x"}': [],
        '{"id":"1x"}': [("id", "wrong type: STRING")],
        '{"id":1.5}': [("id", "wrong type: DECIMAL")],
        '{"id":1,"name":{"a":1},"v":"q","a\'b":3}': [("v", "wrong type: STRING"), ("a'b", "wrong type: BIGINT")],
        '{"id":1': [(None, "no JSON")],
        "not json": [(None, "no JSON")],
        "[1,2]": [(None, "no object")],
        "3": [(None, "no object")],
        "": [(None, "empty")],
        "  ": [(None, "empty")],
        None: [(None, "empty")],
        '{"name":"x"}': [("id", "missing")],
        '{"id":null}': [("id", "null")],
        '{"id":1,"id":2}': [(None, "not readable")],
        '{"id":1,"t":"nope"}': [("t", "wrong type: STRING")],
        '{"id":9223372036854775808}': [("id", "wrong type: DECIMAL")],
    }
    df = spark.createDataFrame([(k, 1) for k in expected], "value string, record int")
    found = with_reasons(df, schema, "value", "id")
    assert found.columns == ["value", "record", "reasons"]
    assert {r["value"]: [tuple(e) for e in r["reasons"]] for r in found.collect()} == expected
    # Every text that decoding flags has a reason.
    flagged = flag_malformed(df, schema).where("__corrupt is not null").withColumnRenamed("__corrupt", "c")
    assert with_reasons(flagged.select("c"), schema, "c").where("size(reasons) = 0").count() == 0


# --- steps under a checkpoint -------------------------------------------------------------


@pytest.mark.parametrize("change", ["order", "value", "lookup"])
def test_other_steps_are_refused(spark, tmp_path, change):
    from maskflow.spec import Store

    store = Store.load(filepath="maskflow/examples/orders.yml")
    pipeline = next(p.id for p in store.pipelines if hasattr(p, "transforms"))
    names = {t.fixture_filepath_env: "lookup-a" for t in store.pipeline(pipeline).transforms if hasattr(t, "fixture_filepath_env")}
    steps = canonical_steps(store, pipeline, names)
    checkpoint = f"{tmp_path}/c"
    _check_steps(spark, checkpoint, steps, "refuse")
    _check_steps(spark, checkpoint, list(steps), "refuse")
    other = store.model_copy(deep=True)
    transforms = other.pipeline(pipeline).transforms
    if change == "order":
        transforms[0], transforms[1] = transforms[1], transforms[0]
    elif change == "value":
        next(t for t in transforms if hasattr(t, "replace_with")).replace_with = "other"
    else:
        names = dict.fromkeys(names, "lookup-b")
    changed = canonical_steps(other, pipeline, names)
    with pytest.raises(ValueError, match="other steps"):
        _check_steps(spark, checkpoint, changed, "refuse")
    _check_steps(spark, checkpoint, changed, "accept")
    with pytest.raises(ValueError, match="other steps"):
        _check_steps(spark, checkpoint, steps, "refuse")
    with pytest.raises(ValueError, match="changed_steps"):
        _check_steps(spark, checkpoint, steps, "maybe")
