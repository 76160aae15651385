import pytest
from pyspark.sql import functions as F

from maskflow.operators import prepare_lookup, redact, split_pick, translate

RECORDS = [
    (1, "Leeds", "LS11 0DS"),
    (2, "London", "BR5 2RE"),
    (3, "Atlantis", "NOSPACE"),
    (4, None, None),
]
PLACES = [("Leeds", "Yorkshire", "x"), ("London", "London", "y"), (None, "Nowhere", "z")]

# Every way a lookup can be joined.
WAYS = {
    "broadcast": {},
    "shuffled": {"broadcast_limit": 0},
    "salted": {"broadcast_limit": 0, "salts": 5},
    "chunked": {"broadcast_limit": 0, "group_rows": 1},
    "chunked and salted": {"broadcast_limit": 0, "group_rows": 1, "salts": 5},
}


@pytest.fixture
def records(spark):
    return spark.createDataFrame(RECORDS, "id int, city string, postcode string")


@pytest.fixture
def places(spark):
    return spark.createDataFrame(PLACES, "city string, region string, extra string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("way", WAYS)
def test_translate_hits_misses_and_nulls(records, places, way):
    out = translate(records, "city", "region", places, "city", "region", **WAYS[way])
    assert out.columns == ["id", "city", "postcode", "region"]
    assert rows(out.select("id", "region")) == [
        (1, "Yorkshire"),
        (2, "London"),
        (3, None),
        (4, None),
    ]


def test_translate_replaces_existing_destination_in_place(records, places):
    out = translate(records, "city", "postcode", places, "city", "region")
    assert out.columns == ["id", "city", "postcode"]
    assert rows(out)[0] == (1, "Leeds", "Yorkshire")


def test_translate_onto_its_own_source(records, places):
    out = translate(records, "city", "city", places, "city", "region")
    assert out.columns == ["id", "city", "postcode"]
    assert rows(out.select("id", "city")) == [
        (1, "Yorkshire"),
        (2, "London"),
        (3, None),
        (4, None),
    ]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("marked", [True, False])
def test_translate_duplicate_keys_multiply_rows(spark, records, way, marked):
    values = ["a", "b", "b", None, None, "c"]
    lookup = spark.createDataFrame([("Leeds", v) for v in values], "city string, region string")
    prepared = prepare_lookup(lookup, "city", "region", mark_first=marked, **WAYS[way])
    out = translate(records, "city", "region", prepared)
    found = [tuple(r) for r in out.select("id", "region").collect()]
    assert sorted(found, key=str) == sorted(
        [(1, v) for v in values] + [(2, None), (3, None), (4, None)], key=str
    )
    assert prepared.marked is marked


def test_translate_copies_of_one_lookup_row_beyond_a_block(spark, records):
    lookup = spark.range(10_000).select(F.lit("Leeds").alias("city"), F.lit("a").alias("region"))
    out = translate(records, "city", "region", lookup, "city", "region", group_rows=1000,
                    broadcast_limit=0)
    assert out.where("id = 1").count() == 10_000
    assert out.count() == 10_003


def test_translate_can_refuse_duplicate_keys(spark, records):
    lookup = spark.createDataFrame([("Leeds", "a"), ("Leeds", "a")], "city string, region string")
    with pytest.raises(ValueError, match="not unique"):
        translate(
            records, "city", "region", lookup, "city", "region", on_duplicate_key="error"
        )


def test_translate_checks_lookup_columns(records, places):
    with pytest.raises(ValueError, match="'area' not found"):
        translate(records, "city", "region", places, "city", "area")


def test_translate_same_lookup_twice(records, places):
    once = translate(records, "city", "region", places, "city", "region")
    twice = translate(once, "city", "again", places, "city", "region")
    assert twice.where("not region <=> again").count() == 0


def test_lookup_is_broadcast_only_within_its_bound(places):
    assert prepare_lookup(places, "city", "region").broadcast
    # Two keyed rows of 64 bytes and their text.
    assert not prepare_lookup(places, "city", "region", broadcast_limit=128).broadcast


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, "a b")], "id int, `full.name` string")
    assert rows(split_pick(df, "full.name", "full.name", " ", 1)) == [(1, "b")]
    assert rows(redact(df, "full.name", "new.name", "X")) == [(1, "X")]


def test_redact_in_place_keeps_position_and_covers_null(spark):
    df = spark.createDataFrame([(1, "Ivey", "x"), (2, None, "y")], "id int, name string, z string")
    out = redact(df, "name", "name", "XXXXX")
    assert out.columns == ["id", "name", "z"]
    assert rows(out) == [(1, "XXXXX", "x"), (2, "XXXXX", "y")]


def test_redact_to_another_column_removes_the_source(spark):
    df = spark.createDataFrame([(1, "Ivey", "x")], "id int, name string, z string")
    assert redact(df, "name", "alias", "X").columns == ["id", "z", "alias"]
    assert redact(df, "name", "z", "X").columns == ["id", "z"]


@pytest.mark.parametrize(
    "text, pattern, index, expected",
    [
        ("WF2 7FE", " ", 0, "WF2"),
        ("WF2 7FE", " ", 1, "7FE"),
        ("WF2 7FE", " ", 2, None),
        ("WF2 7FE", " ", -1, None),
        ("NOSPACE", " ", 0, "NOSPACE"),
        (None, " ", 0, None),
        ("", " ", 0, ""),
        ("a|b", "|", 1, "|"),  # a bar is a regular expression
        ("a|b", "\\|", 1, "b"),
        ("a-b c", "[- ]", 2, "c"),
        (" lead", " ", 0, ""),
        ("trail ", " ", 1, ""),
        ("a  b", " ", 1, ""),
    ],
)
def test_split_pick(spark, text, pattern, index, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert split_pick(df, "s", "d", pattern, index).first()["d"] == expected
    # Cutting only as far as needed gives what cutting all the way gives.
    if index >= 0:
        whole = df.select(F.get(F.split("s", pattern), F.lit(index)).alias("d"))
        assert whole.first()["d"] == expected
