import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskflow.operators import aggregates as aggregates_module
from maskflow.operators import most_common, n_rarest, upsert

SLOW = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
texts = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@SLOW
@given(st.lists(st.tuples(texts, texts), max_size=30))
def test_most_common_against_counting(spark, pairs):
    groups = defaultdict(Counter)
    for key, value in pairs:
        if key is not None:
            groups[key].update([] if value is None else [value])
    expected = {
        k: min(c, key=lambda v: (-c[v], v)) if c else None for k, c in groups.items()
    }
    df = spark.createDataFrame(pairs, "k string, v string")
    assert {r.k: r.v for r in most_common(df, "k", "v").collect()} == expected


def test_most_common_of_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 1000).alias("v"),
    )
    found = {r.k: r.v for r in most_common(df, "k", "v").collect()}
    assert len(found) == 20_001 and found["hot"] == 0 and found["1"] == 1


def test_n_rarest_against_sorting(spark):
    rows = [
        ("boy" if i % 3 else "girl", f"n{i % 40}", ((i * 37) % 11) / 10) for i in range(400)
    ] + [("other", "n1", 0.0), ("boy", None, 0.0), ("boy", "nothing", None)]
    df = spark.createDataFrame(rows, "sex string, name string, percent double")
    peaks = defaultdict(dict)
    for sex, name, percent in rows:
        if name is not None and percent is not None:
            peaks[sex][name] = max(percent, peaks[sex].get(name, percent))
    for wanted in ({"boy": 7, "girl": 4}, {"boy": 1, "girl": 0}, {"boy": 1000, "girl": 3}):
        expected = {
            (sex, name, peak)
            for sex, n in wanted.items()
            for peak, name in sorted((p, m) for m, p in peaks[sex].items())[:n]
        }
        found = n_rarest(df, "sex", "name", "percent", wanted)
        assert {tuple(r) for r in found.collect()} == expected


def test_n_rarest_of_odd_measures(spark):
    values = [float("inf"), float("nan"), -1.5, 0.0, -0.0, 5e-324, -float("inf"), 1e300, 2.0, -2.0]
    df = spark.createDataFrame([("g", f"n{i}", v) for i, v in enumerate(values)], "g string, n string, v double")
    found = n_rarest(df, "g", "n", "v", {"g": 6})
    assert {r.n for r in found.collect()} == {"n6", "n9", "n2", "n3", "n4", "n5"}


def test_n_rarest_ranks_few_rows(spark):
    """Of 100,000 names about n reach the last sort."""
    df = spark.range(100_000).selectExpr("'g' as g", "cast(id as string) as n", "id + 1.0 as v")
    found = n_rarest(df, "g", "n", "v", {"g": 50})
    assert found.count() == 50
    place = aggregates_module._nth(df.withColumnRenamed("v", "peak"), "g", "n", {"g": 50})["g"]
    assert 50 <= df.withColumnRenamed("v", "peak").where(place).count() <= 50 + aggregates_module.SLACK


def test_upsert_with_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "old", 0), (4, "old", 0)], "id int, v string, at int")
    source = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "c", 1), (2, "c", 1), (None, "d", 1), (None, "e", 1)], "id int, v string, at int"
    )
    with pytest.raises(ValueError, match="several rows"):
        upsert(target, source, ["id"])
    found = Counter((r.id, r.v) for r in upsert(target, source, ["id"], latest="at").collect())
    assert found == Counter([(4, "old"), (1, "b"), (2, "c"), (None, "d"), (None, "e")])


def test_upsert_updates_and_adds(spark):
    target = spark.createDataFrame(
        [(0, 1, "old"), (0, 2, "old"), (1, 1, "old"), (0, None, "old")],
        "batch_id int, id int, v string",
    )
    source = spark.createDataFrame(
        [("new", 0, 1, "x"), ("new", 0, 3, "x"), ("new", 0, None, "x")],
        "v string, batch_id int, id int, extra string",
    )
    found = upsert(target, source, ["batch_id", "id"])
    assert found.columns == target.columns
    assert Counter(map(tuple, found.collect())) == Counter(
        [
            (0, 1, "new"), (0, 2, "old"), (1, 1, "old"), (0, None, "old"),
            (0, 3, "new"), (0, None, "new"),
        ]
    )


def test_upsert_again_changes_nothing(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string")
    source = spark.createDataFrame([(2, "new"), (3, "new")], "id int, v string")
    once = upsert(target, source, ["id"])
    twice = upsert(once, source, ["id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@pytest.mark.parametrize("same", ["target", "copy"])
def test_upsert_of_a_table_by_itself(spark, same):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = target if same == "target" else target.where("id = 1")
    assert upsert(target, source, ["id"]).count() == 2


@pytest.mark.parametrize("slack", [0, 3, 10_000])
def test_n_rarest_narrows_down_to_the_last_tie(spark, monkeypatch, slack):
    monkeypatch.setattr(aggregates_module, "SLACK", slack)
    monkeypatch.setattr(aggregates_module, "PARTS", 7)
    inf, nan = float("inf"), float("nan")
    g = random.Random(6)
    odd = [0.0, -0.0, -inf, inf, nan, 1e-320, 5e-324, 1.0, 1.0 + 2**-52, 1e300, -1e300]
    rows = [("a", f"n{g.randint(0, 400)}", 2.5) for _ in range(300)]
    rows += [("b", "ab" * g.randint(0, 3) + g.choice("xyzé"), g.choice(odd)) for _ in range(200)]
    rows += [("c", str(k), g.random()) for k in range(300)] + [("c", None, 0.0), ("c", "q", None), ("d", "one", 1.0)]
    df = spark.createDataFrame(rows, "g string, name string, m double")
    wanted = {"a": 17, "b": 9, "c": 40, "d": 5, "none": 3, "zero": 0}
    expected = set()
    peaks = {}
    for group, name, m in rows:
        if name is not None and m is not None and wanted.get(group):
            # NaN is the greatest measure, as Spark has it.
            rank = (m != m, 0.0 if m != m else m + 0.0)
            peaks[group, name] = max(peaks.get((group, name), (False, -inf)), rank)
    for group, n in wanted.items():
        own = sorted((rank, name.encode()) for (h, name), rank in peaks.items() if h == group)
        expected |= {(group, name.decode()) for _, name in own[:n]}
    found = n_rarest(df, "g", "name", "m", wanted)
    assert {(r.g, r["name"]) for r in found.collect()} == expected


def test_n_rarest_with_a_million_equal_measures(spark):
    names = F.concat(F.lit("name"), F.lpad(F.pmod(F.col("id") * 7919, F.lit(1_000_000)).cast("string"), 7, "0"))
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit("g").alias("g"), names.alias("name"), F.lit(1.5).alias("m"))
    found = n_rarest(df, "g", "name", "m", {"g": 100})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["name"] for r in found.collect()) == [f"name{k:07d}" for k in range(100)]
    # What is ranked is about n rows, not the group.
    place = aggregates_module._nth(df.withColumnRenamed("m", "peak"), "g", "name", {"g": 100})["g"]
    assert df.withColumnRenamed("m", "peak").where(place).count() <= 100 + aggregates_module.SLACK
