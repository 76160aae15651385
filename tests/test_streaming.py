import json
import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import types as T

from maskflow.operators import apply_audited, prepare_lookup, split_audit, translate_step
from maskflow.sources import decode_json
from maskflow.streaming import (
    FileSink,
    MemorySink,
    TableSink,
    ensure_table,
    read_table,
    start_pipeline,
    write_batch,
)
from tests.conftest import ddl
from tests.test_audit import PATIENT, PATIENTS, patient_steps

SCHEMA = ddl(PATIENT)
PSEUDO = T.StructType(
    [
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("inserted_at", T.TimestampType()),
        *SCHEMA.fields,
        T.StructField("region", T.StringType()),
    ]
)
FIELDS = [*SCHEMA.fieldNames(), "region"]
AUDIT = ddl(
    "patient_id int, old_value string, new_value string, transform_tag string"
)


class Job:
    """A folder of record files and a pipeline that tails it."""

    def __init__(self, spark, root, **sink_options):
        self.spark, self.root = spark, Path(root)
        (self.root / "in").mkdir()
        self.data = TableSink(f"{root}/data", PSEUDO, **sink_options)
        self.audit = FileSink(f"{root}/audit", AUDIT)
        self.checkpoint = f"{root}/checkpoint"

    def arrive(self, name, lines):
        # Written aside first: a file source must never see half a file.
        aside = self.root / name
        aside.write_text("\n".join(lines) + "\n")
        os.rename(aside, self.root / "in" / name)

    def audited(self, reader):
        records = decode_json(reader.text(f"{self.root}/in"), SCHEMA)
        return apply_audited(records, patient_steps(self.spark), "patient_id", "p")

    def run(self, data=None, audit=None):
        reader = self.spark.readStream.option("maxFilesPerTrigger", 1)
        run = start_pipeline(
            self.audited(reader), "patient_id", data or self.data, audit or self.audit,
            self.checkpoint, "p", available_now=True,
        )
        run.await_termination()
        return run

    def tables(self):
        return rows(self.data.read(self.spark).select(FIELDS)), rows(self.audit.read(self.spark))

    def expected(self):
        data, audit = split_audit(self.audited(self.spark.read), "patient_id")
        return rows(data.select(FIELDS)), rows(audit)


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture
def job(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.arrive("a.json", PATIENTS[:3])
    job.arrive("b.json", PATIENTS[3:] + ["not json", ""])
    return job


def test_stream_gives_what_the_batch_gives(job):
    run = job.run()
    assert job.tables() == job.expected()
    [query] = run.queries
    progress = query.recentProgress
    assert all(p["stateOperators"] == [] for p in progress)
    # Two outputs, but every record was fetched once.
    assert sum(p["numInputRows"] for p in progress) == 8
    batches = job.data.read(job.spark).groupBy("batch_id").count().collect()
    assert {r.batch_id for r in batches} == {0, 1}
    stamps = job.data.read(job.spark).select("batch_id", "inserted_at").distinct()
    assert stamps.count() == 2 and stamps.where("inserted_at is null").count() == 0


def test_replayed_batch_leaves_the_tables_unchanged(job):
    job.run()
    before = job.tables()
    commits = Path(job.checkpoint) / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink(missing_ok=True)
    job.run()
    assert job.tables() == before


def test_half_written_batch_is_replaced(job):
    """A crash after the records and before the audit trail is made good."""

    class Failing(FileSink):
        def write(self, df, query_id, batch_id):
            raise OSError("disk gone")

    with pytest.raises(Exception, match="disk gone"):
        job.run(audit=Failing(job.audit.path, AUDIT))
    job.run()
    assert job.tables() == job.expected()


def test_restart_resumes_and_keeps_its_query_id(job):
    first = job.run().queries[0].id
    job.arrive("c.json", PATIENTS[:1])
    second = job.run()
    assert second.queries[0].id == first
    assert sum(p["numInputRows"] for p in second.queries[0].recentProgress) == 1
    assert job.tables() == job.expected()


def test_lost_checkpoint_adds_and_never_overwrites(job):
    job.run()
    job.checkpoint += "_new"
    job.run()
    assert job.tables() == tuple(Counter({k: 2 * n for k, n in t.items()}) for t in job.expected())


def test_same_record_in_two_batches_is_two_rows(job):
    job.arrive("c.json", PATIENTS[:1])
    job.run()
    assert job.data.read(job.spark).where("patient_id = 0").count() == 2
    assert job.audit.read(job.spark).where("patient_id = 0").count() == 6


def test_sinks_at_different_paces_share_one_query(job):
    run = job.run(audit=FileSink(job.audit.path, AUDIT, trigger_seconds=1))
    assert len(run.queries) == 1
    assert job.tables() == job.expected()


def leaves(path):
    return sorted(int(p.name.split("=")[1]) for p in Path(path).glob("query_id=*/batch_id=*"))


def slow(job, seconds=3600):
    return FileSink(job.audit.path, AUDIT, trigger_seconds=seconds)


def test_a_slower_sink_gets_a_range_of_batches_as_one(job):
    job.arrive("c.json", PATIENTS[:2])
    job.run(audit=slow(job))
    assert leaves(job.data.path) == [0, 1, 2] and leaves(job.audit.path) == [2]
    assert job.tables() == job.expected()
    job.arrive("d.json", PATIENTS[2:])
    job.run(audit=slow(job))
    assert leaves(job.audit.path) == [2, 3]
    assert job.tables() == job.expected()


def test_a_replayed_batch_changes_no_range(job):
    job.arrive("c.json", PATIENTS[:2])
    job.run(audit=slow(job))
    before = job.tables()
    for name in ("2", ".2.crc"):
        (Path(job.checkpoint) / "commits" / name).unlink(missing_ok=True)
    for seconds in (3600, 1):
        job.run(audit=slow(job, seconds))
        assert job.tables() == before and leaves(job.audit.path) == [2]


def test_what_a_failed_run_put_aside_is_written_by_the_next(job):
    class Broken(TableSink):
        def write(self, df, query_id, batch_id):
            if batch_id == 1:
                raise OSError("disk gone")
            super().write(df, query_id, batch_id)

    class Unwritten(FileSink):
        def write(self, df, query_id, batch_id):
            raise OSError("no place")

    # The records of the second batch fail; what the trail put aside cannot be written either.
    with pytest.raises(Exception, match="disk gone|no place"):
        job.run(Broken(job.data.path, PSEUDO), Unwritten(job.audit.path, AUDIT, trigger_seconds=3600))
    assert leaves(job.audit.path) == []
    job.run(audit=slow(job))
    assert job.tables() == job.expected() and leaves(job.audit.path) == [1]


def test_memory_sink_keeps_its_rows_over_a_restart(job):
    schema = T.StructType([f for f in PSEUDO if f.name in FIELDS])
    sizes = []
    for _ in range(2):
        run = job.run(MemorySink("seen", 1, 1, schema=schema), MemorySink("seen_audit", 1, 1, schema=AUDIT))
        sizes += [s.count() for s in run.snapshots()]
    assert sizes == [8, 8]


def test_a_failed_query_is_raised(job):
    class Broken(MemorySink):
        def write(self, df, query_id, batch_id):
            raise RuntimeError("the sink is broken")

    schema = T.StructType([f for f in PSEUDO if f.name in FIELDS])
    job.arrive("c.json", PATIENTS[:1])
    records = decode_json(job.spark.readStream.text(f"{job.root}/in"), SCHEMA)
    audited = apply_audited(records, [], "patient_id", "p")
    run = start_pipeline(
        audited, "patient_id", Broken("broken", 1, 3, schema=schema), MemorySink("trail", 1, 3, schema=AUDIT),
        job.checkpoint + "_broken", "broken",
    )
    with pytest.raises(Exception, match="broken"):
        list(run.snapshots())


def test_table_divided_by_a_column(spark, tmp_path):
    job = Job(spark, tmp_path, partition_on="region", coalesce=1)
    job.arrive("a.json", PATIENTS)
    job.run()
    assert job.tables() == job.expected()
    leaves = {p.name for p in (tmp_path / "data").glob("query_id=*/batch_id=0/region=*")}
    assert "region=London" in leaves
    (Path(job.checkpoint) / "commits" / "0").unlink()
    (Path(job.checkpoint) / "commits" / ".0.crc").unlink(missing_ok=True)
    job.run()
    assert job.tables() == job.expected()


def test_coalesced_batch_is_one_file_unless_large(spark, tmp_path):
    df = spark.range(0, 100_000, 1, 12)
    write_batch(df, str(tmp_path / "t"), "q", 0, coalesce=1)
    assert len(list((tmp_path / "t").glob("*/batch_id=0/*.parquet"))) == 1
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    write_batch(df, str(tmp_path / "t"), "q", 1, coalesce=1)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t").glob("*/batch_id=1/*.parquet"))) > 1
    assert read_table(spark, str(tmp_path / "t"), df.schema).count() == 200_000


def test_memory_sinks_give_snapshots(job):
    data = MemorySink("seen", 1, 2, schema=T.StructType([f for f in PSEUDO if f.name in FIELDS]))
    audit = MemorySink("seen_audit", 1, 1, schema=AUDIT)
    run = job.run(data, audit)
    sizes = [s.count() for s in run.snapshots()]
    assert sizes == [8, 8]
    assert job.spark.table("seen").count() == 8
    assert [s.count() for s in run.snapshots(5, of="audit")] == [5]


def test_json_audit_reads_back_with_its_nulls(job):
    job.run()
    [first] = list((job.root / "audit").glob("query_id=*/batch_id=0/*.json"))[:1]
    lines = [json.loads(line) for line in first.read_text().splitlines()]
    assert any("old_value" not in line for line in lines)
    assert job.audit.read(job.spark).columns == AUDIT.fieldNames()


def test_fan_out_in_a_stream(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.arrive("a.json", PATIENTS)
    table = spark.createDataFrame(
        [("London", "a"), ("London", "b")], "city string, region string"
    )
    outcomes = []
    for options in ({}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "group_rows": 1}):
        for cache in (False, True):
            lookup = prepare_lookup(table, "city", "region", cache=cache, **options)
            step = translate_step("city", "region", lookup, "f", "city", "region")
            records = decode_json(spark.readStream.text(f"{tmp_path}/in"), SCHEMA)
            audited = apply_audited(records, [step], "patient_id", "p")
            data = MemorySink("d", schema=split_audit(audited, "patient_id")[0].schema)
            audit = MemorySink("a", schema=AUDIT)
            run = start_pipeline(
                audited, "patient_id", data, audit,
                f"{tmp_path}/checkpoint{len(outcomes)}", "p", available_now=True,
            )
            run.await_termination()
            assert run.queries[0].lastProgress["stateOperators"] == []
            outcomes.append((rows(data.read(spark)), rows(audit.read(spark))))
            lookup.close()
    assert all(o == outcomes[0] for o in outcomes)
    assert sum(outcomes[0][0].values()) == 9


def test_empty_table_can_be_read(spark, tmp_path):
    path = str(tmp_path / "t")
    ensure_table(spark, path, PSEUDO, "parquet")
    assert read_table(spark, path, PSEUDO).schema == PSEUDO
    assert read_table(spark, path, PSEUDO).count() == 0
    ensure_table(spark, path, PSEUDO, "parquet")


def test_empty_batch_and_declared_types(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    write_batch(df, path, "q", 0)
    write_batch(df.limit(0), path, "q", 1)
    assert read_table(spark, path, df.schema).collect() == df.collect()
    wider = ddl("query_id string, batch_id long, id long, v string")
    assert sorted(map(tuple, read_table(spark, path, wider).collect())) == [("q", 0, 1, "a")]


def test_table_may_declare_its_query_id(spark, tmp_path):
    schema = ddl("query_id string, id int").add("batch_id", "long")
    sink = TableSink(str(tmp_path / "t"), schema)
    sink.write(spark.createDataFrame([(1,)], "id int"), "q", 3)
    assert [tuple(r) for r in sink.read(spark).collect()] == [("q", 1, 3)]


def test_declared_column_must_be_there(spark, tmp_path):
    sink = TableSink(str(tmp_path / "t"), PSEUDO)
    with pytest.raises(ValueError, match="'city'"):
        sink.write(spark.createDataFrame([(1,)], "patient_id int"), "q", 0)
