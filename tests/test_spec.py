import pytest
import yaml
from pydantic import ValidationError

from maskflow.__main__ import main
from maskflow.plans.loader import run_loader
from maskflow.plans.pipeline import build, explain, run_batch, run_stream
from maskflow.spec import Store, from_env, split_topic

MEMBERS = [
    '{"member_id": 10, "full_name": "Ada Quill", "town": "Bath", "phone": "01225-555-010"}',
    '{"member_id": 11, "full_name": "Ben Orchard", "town": "York", "phone": "01904-555-011"}',
    '{"member_id": 12, "full_name": null, "town": "Nowhere", "phone": "none"}',
]
AREAS = [("Bath", "South West"), ("York", "North")]
TAGS = {
    "phone#1 = member_masker.split_pick(phone#0, split_by='-', pick_index=1)",
    "area#2 = member_masker.translate(town#1, fixture='areas', key_column='town',"
    " value_column='area')",
    "alias#3 = member_masker.redact(full_name#2, replace_with='hidden')",
}

# A specification with every kind of part.
SPEC = """
schemas:
  - {name: member, primary_field: member_id,
     fields: {member_id: long, full_name: string, town: string, phone: string}}
  - {name: masked_member, primary_field: member_id,
     fields: {member_id: long, alias: string, area: string, phone: string,
              batch_id: integer, inserted_at: timestamp}}
connectors:
  - {id: bus, connector_type: kafka, broker_env: BUS_BROKERS,
     topics: [{topic_name: members, topic_schema: member}]}
  - {id: lake, connector_type: deltalake,
     tables: [{table_name: masked, table_schema: masked_member, filepath_env: MASKED_PATH,
               partition_on: inserted_at}]}
pipelines:
  - {id: member_loader, pipeline_type: kafka_producer, source_filepath_env: MEMBER_FILE,
     sink_topic: bus.members, interval_seconds_mean: 2, interval_seconds_sd: 0.1}
  - id: member_masker
    pipeline_type: transformer
    source: {source_type: kafka, connector_id: bus, topic: members}
    sink: {sink_type: deltalake, connector_id: lake, table: masked, trigger_seconds: 30,
           coalesce: 2}
    audit: {sink_type: file, filepath_env: TRAIL_PATH, format: json, trigger_seconds: 30}
    transforms:
      - {transform_type: split_pick, source_column: phone, destination_column: phone,
         split_by: '-', pick_index: 1}
      - {transform_type: translate, source_column: town, destination_column: area,
         fixture_filepath_env: AREA_TABLE, key_column: town, value_column: area}
      - {transform_type: redact, source_column: full_name, destination_column: alias,
         replace_with: hidden}
  - id: member_watch
    pipeline_type: transformer
    source: {source_type: file, filepath_env: TOPIC_FOLDER, source_schema: member}
    sink: {sink_type: memory, query_name: members_now, query_interval: 1, duration_seconds: 2}
    audit: {sink_type: memory, query_name: trail_now, query_interval: 1, duration_seconds: 1}
    transforms:
      - {transform_type: redact, source_column: full_name, destination_column: full_name,
         replace_with: hidden}
"""


@pytest.fixture
def raw():
    return yaml.safe_load(SPEC)


def from_files(raw):
    """The main pipeline, reading files in place of the topic."""
    raw["pipelines"][1]["source"] = {
        "source_type": "file",
        "filepath_env": "TOPIC_FOLDER",
        "source_schema": "member",
    }
    return raw


@pytest.fixture
def env(spark, tmp_path):
    spark.createDataFrame(AREAS, "town string, area string").write.parquet(
        str(tmp_path / "areas.parquet")
    )
    lines = tmp_path / "sample.json"
    lines.write_text("\n".join(MEMBERS + ["not json", '{"full_name": "no id"}']) + "\n")
    return {
        "BUS_BROKERS": "broker:9092",
        "MEMBER_FILE": str(lines),
        "MASKED_PATH": str(tmp_path / "pseudo"),
        "TRAIL_PATH": str(tmp_path / "audit"),
        "AREA_TABLE": str(tmp_path / "areas.parquet"),
        "TOPIC_FOLDER": str(tmp_path / "topic"),
        "REJECTED": str(tmp_path / "rejected"),
    }


def test_whole_specification_loads():
    store = Store.parse(SPEC)
    assert [p.id for p in store.pipelines] == [
        "member_loader", "member_masker", "member_watch",
    ]
    schema = store.schema_named("masked_member").spark_schema()
    assert schema["inserted_at"].dataType.typeName() == "timestamp"
    assert all(f.nullable for f in schema.fields)


def change(path, value):
    def apply(raw):
        *parents, last = path
        for key in parents:
            raw = raw[key]
        raw[last] = value

    return apply


@pytest.mark.parametrize(
    "fault, message",
    [
        (change(["extra"], 1), "extra"),
        (change(["schemas", 0, "colour"], 1), "colour"),
        (change(["pipelines", 1, "transforms", 1, "colour"], 1), "colour"),
        (change(["pipelines", 1, "transforms", 1, "transform_type"], "hash"), "hash"),
        (change(["pipelines", 1, "sink", "sink_type"], "tape"), "tape"),
        (change(["schemas", 0, "fields", "town"], "text"), "town"),
        (change(["schemas", 0, "primary_field"], "passport"), "passport"),
        (change(["schemas", 1, "name"], "member"), "more than once"),
        (change(["pipelines", 0, "id"], "member_masker"), "more than once"),
        (change(["pipelines", 1, "source", "topic"], "none"), "none"),
        (change(["pipelines", 1, "source", "connector_id"], "lake"), "no topics"),
        (change(["pipelines", 1, "sink", "connector_id"], "bus"), "no tables"),
        (change(["pipelines", 1, "sink", "table"], "none"), "none"),
        (change(["pipelines", 0, "sink_topic"], "members"), "connector.topic"),
        (change(["pipelines", 0, "sink_topic"], "bus.none"), "none"),
        (change(["connectors", 0, "topics", 0, "topic_schema"], "none"), "none"),
        (change(["connectors", 1, "tables", 0, "table_schema"], "none"), "none"),
        (change(["connectors", 1, "tables", 0, "partition_on"], "none"), "none"),
        (change(["pipelines", 1, "transforms", 1, "destination_column"], "member_id"), "primary"),
        (change(["pipelines", 1, "transforms", 1, "source_column"], "gone"), "'gone'"),
        (change(["pipelines", 1, "transforms", 1, "destination_column"], "region"), "area"),
        (change(["pipelines", 1, "source", "on_malformed"], "quarantine"), "go together"),
    ],
)
def test_faults_are_found_on_load(raw, fault, message):
    Store.model_validate(raw)
    fault(raw)
    with pytest.raises(ValidationError, match=message):
        Store.model_validate(raw)


def test_where_a_specification_is_found(tmp_path, monkeypatch):
    named, other = tmp_path / "named.yml", tmp_path / "other.yml"
    named.write_text(SPEC)
    other.write_text(SPEC.replace("member_loader", "other_loader"))
    (tmp_path / "metastore.yml").write_text(SPEC.replace("member_loader", "here_loader"))
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("METASTORE_FILEPATH", raising=False)
    assert Store.load().pipelines[0].id == "here_loader"
    monkeypatch.setenv("METASTORE_FILEPATH", str(other))
    assert Store.load().pipelines[0].id == "other_loader"
    assert Store.load(filepath=str(named)).pipelines[0].id == "member_loader"


def test_environment_comes_before_defaults(monkeypatch):
    monkeypatch.delenv("SOME_KEY", raising=False)
    assert from_env("SOME_KEY", {"SOME_KEY": "default"}) == "default"
    monkeypatch.setenv("SOME_KEY", "set")
    assert from_env("SOME_KEY", {"SOME_KEY": "default"}) == "set"
    monkeypatch.delenv("SOME_KEY")
    with pytest.raises(KeyError, match="SOME_KEY"):
        from_env("SOME_KEY", {})


def test_topic_names():
    assert split_topic("bus.a.b") == ("bus", "a.b")


def test_loader_then_stream_then_read(spark, raw, env):
    store = Store.model_validate(from_files(raw))
    bad = run_loader(spark, store, "member_loader", env, folder=env["TOPIC_FOLDER"])
    assert {r.value for r in bad.collect()} == {"not json", '{"full_name": "no id"}'}
    run = run_stream(
        spark, store, "member_masker", env, available_now=True,
        checkpoint=env["TOPIC_FOLDER"] + "_checkpoint",
    )
    run.await_termination()
    data = run.data_sink.read(spark)
    assert data.columns[-2:] == ["batch_id", "inserted_at"]
    assert {tuple(r)[:4] for r in data.collect()} == {
        (10, "hidden", "South West", "555"),
        (11, "hidden", "North", "555"),
        (12, "hidden", None, None),
    }
    audit = run.audit_sink.read(spark)
    assert audit.count() == 3 * len(MEMBERS)
    assert {r.transform_tag for r in audit.collect()} == TAGS


def test_two_batch_runs_keep_both(spark, raw, env):
    store = Store.model_validate(from_files(raw))
    env["TOPIC_FOLDER"] = env["MEMBER_FILE"]
    counts = []
    for _ in range(2):
        plan = run_batch(spark, store, "member_masker", env)
        counts.append((plan.data_sink.read(spark).count(), plan.audit_sink.read(spark).count()))
    assert counts[1] == (2 * counts[0][0], 2 * counts[0][1])


def test_durable_stream_needs_a_checkpoint(spark, raw, env, monkeypatch, tmp_path):
    (tmp_path / "topic").mkdir()
    store = Store.model_validate(from_files(raw))
    monkeypatch.setattr("maskflow.plans.pipeline._shared_setting", lambda spark: None)
    with pytest.raises(ValueError, match="give a checkpoint"):
        run_stream(spark, store, "member_masker", env, available_now=True)


def test_batch_run_twice_is_the_same_as_once(spark, raw, env):
    store = Store.model_validate(from_files(raw))
    env["TOPIC_FOLDER"] = env["MEMBER_FILE"]
    for _ in range(2):
        plan = run_batch(spark, store, "member_masker", env, run_id="monday")
    # Malformed lines are kept as rows of nulls, and nothing is audited for them.
    assert plan.data_sink.read(spark).count() == len(MEMBERS) + 2
    assert plan.audit_sink.read(spark).count() == 3 * len(MEMBERS)


def test_audit_trail_as_a_table(spark, raw, env, monkeypatch):
    from_files(raw)
    raw["schemas"].append(
        {
            "name": "trail",
            "primary_field": "member_id",
            "fields": {
                "member_id": "long", "old_value": "string", "new_value": "string",
                "transform_tag": "string",
            },
        }
    )
    raw["connectors"][1]["tables"].append(
        {"table_name": "audit", "table_schema": "trail",
         "filepath_env": "TRAIL_PATH", "partition_on": "member_id"}
    )
    raw["pipelines"][1]["audit"] = {
        "sink_type": "deltalake", "connector_id": "lake", "table": "audit",
        "trigger_seconds": 60,
    }
    env["TOPIC_FOLDER"] = env["MEMBER_FILE"]
    plan = run_batch(spark, Store.model_validate(raw), "member_masker", env)
    assert plan.audit_sink.read(spark).count() == 3 * len(MEMBERS)
    raw["schemas"][-1]["fields"]["reason"] = "string"
    with pytest.raises(ValidationError, match="reason"):
        Store.model_validate(raw)


@pytest.mark.parametrize("streaming", [True, False])
def test_quarantine(spark, raw, env, streaming, tmp_path):
    from_files(raw)
    raw["pipelines"][1]["source"] |= {
        "on_malformed": "quarantine", "quarantine_filepath_env": "REJECTED",
    }
    store = Store.model_validate(raw)
    if streaming:
        folder = tmp_path / "topic"
        folder.mkdir()
        (folder / "a.json").write_text("\n".join(MEMBERS + ["not json", '{"member_id": "x"}']))
        run = run_stream(
            spark, store, "member_masker", env, True, str(tmp_path / "checkpoint")
        )
        run.await_termination()
        data = run.data_sink
    else:
        env["TOPIC_FOLDER"] = str(tmp_path / "lines")
        (tmp_path / "lines").write_text("\n".join(MEMBERS + ["not json", '{"member_id": "x"}']))
        data = run_batch(spark, store, "member_masker", env).data_sink
    assert data.read(spark).count() == len(MEMBERS)
    rejected = spark.read.json(env["REJECTED"])
    assert {r.value for r in rejected.collect()} == {"not json", '{"member_id": "x"}'}


def test_kafka_is_asked_for_its_topic(spark, raw, env, monkeypatch):
    """There is no broker here: only what the reader is told can be checked."""
    from pyspark.sql.streaming import DataStreamReader

    raw["pipelines"][1]["source"]["options"] = {"startingOffsets": "earliest"}
    told = {}

    def load(reader, *_):
        return spark.createDataFrame([(bytearray(b"{}"),)], "value binary")

    monkeypatch.setattr(DataStreamReader, "format", lambda r, f: told.update(format=f) or r)
    monkeypatch.setattr(DataStreamReader, "option", lambda r, k, v: told.update({k: v}) or r)
    monkeypatch.setattr(DataStreamReader, "options", lambda r, **o: told.update(o) or r)
    monkeypatch.setattr(DataStreamReader, "load", load)
    plan = build(spark, Store.model_validate(raw), "member_masker", env)
    assert told == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "members",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "50000000",
    }
    assert plan.data.columns == ["member_id", "town", "phone", "area", "alias"]
    plan.close()


def test_stream_plan_broadcasts_and_keeps_no_state(spark, raw, env, capsys, tmp_path):
    (tmp_path / "topic").mkdir()
    explain(spark, Store.model_validate(from_files(raw)), "member_masker", env)
    text = capsys.readouterr().out
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    assert "StateStore" not in text and "SymmetricHash" not in text


def test_wrong_kind_of_pipeline(spark, env):
    store = Store.parse(SPEC)
    with pytest.raises(ValueError, match="run_loader"):
        build(spark, store, "member_loader", env)
    with pytest.raises(ValueError, match="run_stream"):
        run_loader(spark, store, "member_masker", env)
    with pytest.raises(ValueError, match="no pipeline named"):
        build(spark, store, "gone", env)


def test_command_line(spark, env, tmp_path, monkeypatch, capsys):
    path = tmp_path / "spec.yml"
    path.write_text(SPEC)
    main(["-f", str(path)])
    assert capsys.readouterr().out == "Completed.\n"
    for key, value in env.items():
        monkeypatch.setenv(key, value)
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "a.json").write_text("\n".join(MEMBERS))
    main(
        ["-f", str(path), "-r", "member_watch",
         "--checkpoint", str(tmp_path / "checkpoint")]
    )
    out = capsys.readouterr().out
    assert "Running 'member_watch'" in out and "hidden" in out


def test_text_into_a_number_column_is_refused_on_load(raw):
    [table] = [s for s in raw["schemas"] if "alias" in s["fields"]]
    table["fields"]["alias"] = "integer"
    with pytest.raises(ValidationError, match="does not declare as string"):
        Store.model_validate(raw)
