import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskflow.operators import (
    apply_audited,
    check_steps,
    prepare_lookup,
    redact_step,
    split_audit,
    split_pick_step,
    transform_tag,
    translate_step,
)
from maskflow.sources import decode_json
from tests.conftest import ddl
from tests.test_transforms import WAYS

# Sample records and the tags of the pipeline they go through.
PATIENTS = """
{"patient_id":0,"patient_name":"Roll Serum-Overskirt","city":"London","postcode":"BR5 2RE","disease":"Melanocytic nevus of skin"}
{"patient_id":1,"patient_name":"Redden Sternum-Misnomer","city":"Lancaster and Morecambe","postcode":"LA2 0NR","disease":"Diverticular disease of colon"}
{"patient_id":2,"patient_name":"Ethelene Lighterage-Speculativeness","city":"London","postcode":"N21 3PE","disease":"Chronic kidney disease stage 4"}
{"patient_id":3,"patient_name":"Lulah Conjunction-Afterburner","city":"London","postcode":"RM12 6RQ","disease":"Alzheimer's disease"}
{"patient_id":4,"patient_name":"Ivey Vote-Athleticism","city":"Wakefield and Castleford","postcode":"WF2 7FE","disease":"Morbid obesity"}
{"patient_id":5,"patient_name":"Crystal Dinner-Verticality","city":"Leeds","postcode":"LS11 0DS","disease":"Dystrophia unguium"}
""".strip().splitlines()
PATIENT = "patient_id int, patient_name string, city string, postcode string, disease string"
REGIONS = [
    ("London", "London"),
    ("Wakefield and Castleford", "Yorkshire and The Humber"),
    ("Leeds", "Yorkshire and The Humber"),
]
TAGS = [
    "region#1 = patient_pseudonymiser.translate(city#0, fixture='city_to_region',"
    " key_column='city', value_column='region')",
    "patient_name#2 = patient_pseudonymiser.redact(patient_name#1, replace_with='XXXXX')",
    "postcode#3 = patient_pseudonymiser.split_pick(postcode#2, split_by=' ', pick_index=0)",
]


def patient_steps(spark):
    lookup = prepare_lookup(
        spark.createDataFrame(REGIONS, "city string, region string"), "city", "region"
    )
    return [
        translate_step("city", "region", lookup, "city_to_region", "city", "region"),
        redact_step("patient_name", "patient_name", "XXXXX"),
        split_pick_step("postcode", "postcode", " ", 0),
    ]


def test_golden_example(spark):
    lines = spark.createDataFrame([(p,) for p in PATIENTS], "value string")
    records = decode_json(lines, ddl(PATIENT))
    audited = apply_audited(records, patient_steps(spark), "patient_id", "patient_pseudonymiser")
    data, audit = split_audit(audited, "patient_id")
    regions = dict(REGIONS)
    sources = [json.loads(p) for p in PATIENTS]

    assert data.columns == [
        "patient_id", "patient_name", "city", "postcode", "disease", "region"
    ]
    assert sorted(map(tuple, data.collect())) == [
        (
            s["patient_id"], "XXXXX", s["city"], s["postcode"].split(" ")[0], s["disease"],
            regions.get(s["city"]),
        )
        for s in sources
    ]
    expected = []
    for s in sources:
        i = s["patient_id"]
        expected += [
            (i, None, regions.get(s["city"]), TAGS[0]),
            (i, s["patient_name"], "XXXXX", TAGS[1]),
            (i, s["postcode"], s["postcode"].split(" ")[0], TAGS[2]),
        ]
    assert audit.columns == ["patient_id", "old_value", "new_value", "transform_tag"]
    assert Counter(map(tuple, audit.collect())) == Counter(expected)


def test_tag_quotes_text_and_not_numbers():
    assert transform_tag("p", 2, "split_pick", "a", "b", {"split_by": "-", "pick_index": 1}) == (
        "b#3 = p.split_pick(a#2, split_by='-', pick_index=1)"
    )
    assert transform_tag("p", 0, "redact", "a", "a", {}) == "a#1 = p.redact(a#0)"


def test_no_steps_gives_no_audit(spark):
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    data, audit = split_audit(apply_audited(df, [], "id", "p"), "id")
    assert data.collect() == df.collect()
    assert audit.columns == ["id", "old_value", "new_value", "transform_tag"]
    assert audit.count() == 0


def test_rows_without_primary_are_not_audited_and_repeated_ones_once_each(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    data, audit = split_audit(apply_audited(df, [redact_step("v", "v", "X")], "id", "p"), "id")
    assert data.count() == 3
    assert sorted((r.id, r.old_value) for r in audit.collect()) == [(1, "a"), (1, "b")]


def test_unchanged_values_are_audited(spark):
    df = spark.createDataFrame([(1, "X")], "id int, v string")
    _, audit = split_audit(apply_audited(df, [redact_step("v", "v", "X")], "id", "p"), "id")
    assert [(r.old_value, r.new_value) for r in audit.collect()] == [("X", "X")]


def test_values_of_other_types_become_text(spark):
    df = spark.createDataFrame([(1, "Leeds", 7)], "id int, city string, n int")
    lookup = prepare_lookup(
        spark.createDataFrame([("Leeds", 42)], "city string, n int"), "city", "n"
    )
    steps = [
        translate_step("city", "n", lookup, "f", "city", "n"),
        redact_step("city", "city", "X"),
    ]
    data, audit = split_audit(apply_audited(df, steps, "id", "p"), "id")
    assert data.first()["n"] == 42
    assert sorted((r.old_value, r.new_value) for r in audit.collect()) == [
        ("7", "42"), ("Leeds", "X"),
    ]


@pytest.mark.parametrize("way", WAYS)
def test_fan_out_does_not_repeat_earlier_steps(spark, way):
    df = spark.createDataFrame(
        [(1, "a", "n1"), (2, "b", "n2"), (3, "c", "n3")], "id int, k string, name string"
    )
    table = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("a", None), ("b", "y")], "k string, v string"
    )
    lookup = prepare_lookup(table, "k", "v", **WAYS[way])
    steps = [
        redact_step("name", "name", "X"),
        translate_step("k", "v", lookup, "f", "k", "v"),
        split_pick_step("k", "k", " ", 0),
    ]
    data, audit = split_audit(apply_audited(df, steps, "id", "p"), "id")
    assert Counter(r.id for r in data.collect()) == {1: 3, 2: 1, 3: 1}
    per_step = Counter((r.transform_tag.split("#")[0], r.id) for r in audit.collect())
    assert per_step == {
        ("name", 1): 1, ("name", 2): 1, ("name", 3): 1,
        ("v", 1): 3, ("v", 2): 1, ("v", 3): 1,
        ("k", 1): 3, ("k", 2): 1, ("k", 3): 1,
    }


@pytest.mark.parametrize("way", WAYS)
def test_two_fan_outs(spark, way):
    df = spark.createDataFrame([(1, "a")], "id int, k string")
    table = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    lookup = prepare_lookup(table, "k", "v", **WAYS[way])
    steps = [
        translate_step("k", "v", lookup, "f", "k", "v"),
        translate_step("k", "w", lookup, "f", "k", "v"),
    ]
    data, audit = split_audit(apply_audited(df, steps, "id", "p"), "id")
    assert data.count() == 4
    assert Counter(r.transform_tag[0] for r in audit.collect()) == {"v": 2, "w": 4}


@pytest.mark.parametrize(
    "columns, step, message",
    [
        (["id", "v"], redact_step("gone", "v", "X"), "source column 'gone'"),
        (["id", "v"], redact_step("v", "id", "X"), "overwrite the primary"),
        (["id", "v"], redact_step("id", "v", "X"), "remove the primary"),
        (["id", "v"], redact_step("v", "old_value", "X"), "reserved"),
        (["id", "v", "new_value"], redact_step("v", "v", "X"), "reserved"),
        (["v"], redact_step("v", "v", "X"), "primary column 'id' not found"),
    ],
)
def test_checks_come_before_the_plan(columns, step, message):
    with pytest.raises(ValueError, match=message):
        check_steps(columns, [step], "id", "p")


def test_check_follows_the_columns(spark):
    steps = [redact_step("v", "w", "X"), split_pick_step("v", "v", " ", 0)]
    with pytest.raises(ValueError, match="source column 'v'"):
        check_steps(["id", "v"], steps, "id", "p")
    assert check_steps(["id", "v"], steps[:1], "id", "p") == ["id", "w"]


def test_audit_reads_only_the_columns_it_shows(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5).select("id", F.lit("a b").alias("v"), F.lit("wide").alias("unused")).write.parquet(path)
    audited = apply_audited(
        spark.read.parquet(path), [split_pick_step("v", "v", " ", 0)], "id", "p"
    )
    _, audit = split_audit(audited, "id")
    assert "unused" not in audit._jdf.queryExecution().executedPlan().toString()
