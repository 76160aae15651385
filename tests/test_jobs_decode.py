import json

import pytest
from pyspark.sql import functions as F

from maskflow.plans import jobs
from maskflow.plans.loader import load_records, write_folder
from maskflow.sources import decode_json
from tests.conftest import ddl

RECORD = ddl("id int, name string")
LINES = [
    '{"id": 1, "name": "a"}',
    '{"id": 2, "name": "b", "unknown": [1]}',
    '{"id": "7", "name": "wrong type"}',
    "not json",
    '{"name": "no id"}',
    '{"id": null, "name": "null id"}',
    "[1, 2]",
    "",
]


def test_decode_keeps_every_row(spark):
    df = spark.createDataFrame([(line,) for line in LINES + [None]], "value string")
    found = [tuple(r) for r in decode_json(df, RECORD).collect()]
    assert len(found) == 9
    assert found[:5] == [
        (1, "a"), (2, "b"), (None, "wrong type"), (None, None), (None, "no id"),
    ]
    assert found[8] == (None, None)


def test_decode_bytes(spark):
    df = spark.createDataFrame([(bytearray(LINES[0].encode()),)], "value binary")
    assert [tuple(r) for r in decode_json(df, RECORD).collect()] == [(1, "a")]


def test_decode_quarantine(spark):
    df = spark.createDataFrame([(line,) for line in LINES[:4] + [None]], "value string")
    good, bad = decode_json(df, RECORD, on_malformed="quarantine")
    assert {tuple(r) for r in good.collect()} == {(1, "a"), (2, "b"), (None, None)}
    assert {r.value for r in bad.collect()} == set(LINES[2:4])
    with pytest.raises(ValueError, match="on_malformed"):
        decode_json(df, RECORD, on_malformed="drop")


def test_loader_keeps_lines_whole_and_reports_the_rest(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text("\n".join(LINES) + "\n")
    good, bad = load_records(spark, str(path), RECORD, "id")
    assert {tuple(r) for r in good.collect()} == {("1", LINES[0]), ("2", LINES[1])}
    rejected = bad.collect()
    assert sorted(r.value for r in rejected) == sorted(LINES[2:])
    assert all(r.file.endswith("in.json") for r in rejected)
    write_folder(good, str(tmp_path / "topic"))
    assert spark.read.text(str(tmp_path / "topic")).count() == 2


def test_code_frequency(spark):
    codes = spark.createDataFrame(
        [
            ("Asthma (disorder)", "10"),
            ("Rare (disorder) thing (disorder)", "*"),
            ("Blood test (procedure)", "99"),
            ("(disorder)", "3"),
            (None, "3"),
        ],
        "Description string, Usage string",
    )
    assert {tuple(r) for r in jobs.code_frequency(codes).collect()} == {
        ("Asthma", 10), ("Rare thing", 1), ("(disorder)", 3),
    }
    wrong = spark.createDataFrame([("a (disorder)", "many")], codes.schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jobs.code_frequency(wrong).collect()


def csv(path, header, rows):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def test_all_jobs_from_a_configuration(spark, tmp_path):
    out = {
        n: str(tmp_path / n)
        for n in ("freq", "city", "region", "forenames", "surnames", "sample.json")
    }
    spark.createDataFrame(
        [(w,) for w in "cat dog owl Eel sea-cow sea_cow ant bee".split()], "noun string"
    ).write.parquet(str(tmp_path / "nouns"))
    names = [f"{y},N{i}{s},{(i + y % 7) / 1000},{s}" for y in (1900, 1901) for i in range(9)
             for s in ("boy", "girl")]
    config = {
        "transform": [
            {
                "function": "snomed_transform",
                "params": {
                    "input": csv(
                        tmp_path / "codes.csv",
                        "Code,Description,Usage",
                        ['1,"Asthma, mild (disorder)",10', "2,Flu (disorder),*", "3,X-ray,5",
                         "4,Gout (disorder),7", "5,Mumps (disorder),2"],
                    ),
                    "output": out["freq"],
                },
            },
            {
                "function": "postcode_transform",
                "params": {
                    "nspl_fact_table_filename": csv(
                        tmp_path / "nspl.csv",
                        "pcd,pcds,doterm,ctry,rgn,ttwa",
                        ["x,LS1 1AA,,E92000001,R1,T1", "x,LS1 1AB,202001,E92000001,R2,T1",
                         "x,LS1 1AC,202001,E92000001,R2,T1", "x,CF1 1AA,,W92000004,R3,T2",
                         "x,EH1 1AA,,S92000003,R4,T3", "x,ZZ1 1ZZ,,E92000001,R9,T9"],
                    ),
                    "ttwa_dimension_filename": csv(
                        tmp_path / "ttwa.csv", "TTWA11CD,TTWA11NM", ["T1,Leeds", "T2,Cardiff"]
                    ),
                    "rgn20cd_dimension_filename": csv(
                        tmp_path / "rgn.csv",
                        "RGN20CD,CDO,RGN20NM",
                        ["R1,1,London", "R2,2,Yorkshire", "R3,3,(pseudo) Wales"],
                    ),
                    "city_table_output": out["city"],
                    "region_table_output": out["region"],
                },
            },
            {
                "function": "forenames_transform",
                "params": {
                    "input": csv(tmp_path / "names.csv", "year,name,percent,sex", names),
                    "number": 5,
                    "output": out["forenames"],
                },
            },
            {
                "function": "surnames_transform",
                "params": {"input": str(tmp_path / "nouns"), "number": 5,
                           "output": out["surnames"]},
            },
            {
                "function": "sample_data_transform",
                "params": {
                    "number": 3,
                    "city_filename": out["city"],
                    "snomed_filename": out["freq"],
                    "forenames_filename": out["forenames"],
                    "surnames_filename": out["surnames"],
                    "output": out["sample.json"],
                },
            },
        ]
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config))
    assert len(jobs.run_jobs(spark, str(path))) == 5

    def read(name):
        return {tuple(r) for r in spark.read.parquet(out[name]).collect()}

    assert read("freq") == {("Asthma, mild", 10), ("Flu", 1), ("Gout", 7), ("Mumps", 2)}
    # All postcodes count for the region, ended ones too.
    assert read("region") == {("Leeds", "Yorkshire"), ("Cardiff", "Wales")}
    assert read("city") == {("LS1 1AA", "Leeds"), ("CF1 1AA", "Cardiff"), ("ZZ1 1ZZ", None)}
    assert read("forenames") == {
        (n,) for n in ("N0boy", "N1boy", "N2boy", "N0girl", "N1girl")
    }
    surnames = spark.read.parquet(out["surnames"]).collect()
    assert len(surnames) == 5
    words = {"Cat", "Dog", "Owl", "Ant", "Bee"}
    assert all(set(r.surname.split("-")) <= words for r in surnames)

    sample = spark.read.text(out["sample.json"]).collect()
    records = [json.loads(r.value) for r in sample]
    assert sorted(r["patient_id"] for r in records) == [0, 1, 2]
    assert {r["postcode"] for r in records} == {"LS1 1AA", "CF1 1AA", "ZZ1 1ZZ"}
    # Nulls are written out, every record has every key.
    assert all(
        set(r) == {"patient_id", "patient_name", "city", "postcode", "disease"} for r in records
    )
    assert any(r["city"] is None for r in records)


def test_jobs_are_looked_up_before_any_runs(spark, tmp_path):
    config = {"transform": [
        {"function": "snomed_transform", "params": {"input": "none", "output": "none"}},
        {"function": "download", "params": {}},
    ]}
    with pytest.raises(ValueError, match="no job named 'download'"):
        jobs.run_jobs(spark, config)


def test_samples_put_side_by_side_do_not_follow_each_other(spark):
    words = spark.createDataFrame([(chr(97 + i) * 3,) for i in range(26)], "noun string")
    pairs = [r.surname.split("-") for r in jobs.compound_names(words, "noun", 26, 1).collect()]
    assert len(pairs) == 26
    assert {p[0] for p in pairs} == {p[1] for p in pairs}
    assert sum(a == b for a, b in pairs) < 10
    again = jobs.compound_names(words.orderBy(F.desc("noun")), "noun", 26, 1).collect()
    assert sorted(r.surname for r in again) == sorted("-".join(p) for p in pairs)


def test_equal_forenames_are_drawn_one_by_one(spark):
    from maskflow.plans.jobs import assemble_records

    forenames = spark.createDataFrame([(i, "Ada" if i < 50 else f"n{i}") for i in range(100)], "row int, forename string")
    surnames = spark.createDataFrame([(f"s{i}",) for i in range(100)], "surname string")
    places = spark.createDataFrame([(f"p{i}", "c") for i in range(100)], "postcode string, city string")
    diseases = spark.createDataFrame([(f"d{i}", 1 + i) for i in range(100)], "disease string, usage int")
    tables = (forenames, surnames, places, diseases)
    counts = set()
    for seed in range(4):
        rows = assemble_records(*tables, 30, seed, keys={"forename": "row"}).collect()
        assert len(rows) == 30
        counts.add(sum(r.patient_name.startswith("Ada ") for r in rows))
    assert all(5 <= n <= 25 for n in counts)
