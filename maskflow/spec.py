"""The YAML specification: schemas, connectors and pipelines.

Key names, type names and tags are a fixed format, so that existing
specifications load as they are. A few keys are added and optional: a file
source, source ``options``, a quarantine for malformed records, a table
``format``, and ``coalesce`` may be left out.

Everything is checked when a specification is loaded: unknown keys, names that
are given twice, and references that lead nowhere are errors there and not when
a pipeline runs.
"""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path
from typing import Annotated, Literal

from pydantic import BaseModel, ConfigDict, Field, model_validator
from pyspark.sql import types as T

from .operators import Step, check_steps
from .streaming.tables import PER_BATCH

# The type names of the specification and their Spark types.
SPARK_TYPES = {
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}

SparkTypeName = Literal[tuple(SPARK_TYPES)]


class SpecModel(BaseModel):
    model_config = ConfigDict(extra="forbid")


# --- schemas ---------------------------------------------------------------


class Schema(SpecModel):
    name: str
    primary_field: str
    fields: dict[str, SparkTypeName]

    @model_validator(mode="after")
    def _primary_is_declared(self):
        if self.primary_field not in self.fields:
            raise ValueError(
                f"schema {self.name!r}: primary field {self.primary_field!r} is not declared"
            )
        return self

    def spark_schema(self) -> T.StructType:
        """All columns nullable: a malformed record or a missed lookup gives nulls."""
        return T.StructType(
            [T.StructField(name, SPARK_TYPES[kind]) for name, kind in self.fields.items()]
        )

    def primary(self) -> T.StructField:
        return T.StructField(self.primary_field, SPARK_TYPES[self.fields[self.primary_field]])


# --- connectors ------------------------------------------------------------


class KafkaTopic(SpecModel):
    topic_name: str
    topic_schema: str


class KafkaConnector(SpecModel):
    id: str
    connector_type: Literal["kafka"]
    broker_env: str
    topics: list[KafkaTopic]


class LakeTable(SpecModel):
    table_name: str
    table_schema: str
    filepath_env: str
    partition_on: str
    format: Literal["parquet", "orc"] = "parquet"


class LakeConnector(SpecModel):
    id: str
    connector_type: Literal["deltalake"]
    tables: list[LakeTable]


Connector = Annotated[KafkaConnector | LakeConnector, Field(discriminator="connector_type")]


# --- sources, sinks and transforms -----------------------------------------


class _Source(SpecModel):
    options: dict[str, str] = {}
    on_malformed: Literal["keep", "quarantine"] = "keep"
    quarantine_filepath_env: str | None = None

    @model_validator(mode="after")
    def _quarantine_has_a_place(self):
        if (self.on_malformed == "quarantine") != (self.quarantine_filepath_env is not None):
            raise ValueError("on_malformed: quarantine and quarantine_filepath_env go together")
        return self


class KafkaSource(_Source):
    source_type: Literal["kafka"]
    connector_id: str
    topic: str


class FileSource(_Source):
    source_type: Literal["file"]
    filepath_env: str
    source_schema: str
    format: str = "json"

    @model_validator(mode="after")
    def _only_json_can_be_malformed(self):
        if self.on_malformed == "quarantine" and self.format != "json":
            raise ValueError("only json files can be quarantined")
        return self


Source = Annotated[KafkaSource | FileSource, Field(discriminator="source_type")]


class LakeSink(SpecModel):
    sink_type: Literal["deltalake"]
    connector_id: str
    table: str
    trigger_seconds: int
    coalesce: int | None = None


class MemorySink(SpecModel):
    sink_type: Literal["memory"]
    query_name: str
    query_interval: int = Field(gt=0)
    duration_seconds: int


class FileSink(SpecModel):
    sink_type: Literal["file"]
    filepath_env: str
    format: str
    trigger_seconds: int
    coalesce: int | None = None


Sink = Annotated[LakeSink | MemorySink | FileSink, Field(discriminator="sink_type")]


class _Transform(SpecModel):
    source_column: str
    destination_column: str


class Translate(_Transform):
    transform_type: Literal["translate"]
    fixture_filepath_env: str
    key_column: str
    value_column: str
    on_duplicate_key: Literal["fanout", "error"] = "fanout"


class Redact(_Transform):
    transform_type: Literal["redact"]
    replace_with: str


class SplitPick(_Transform):
    transform_type: Literal["split_pick"]
    split_by: str
    pick_index: int


Transform = Annotated[Translate | Redact | SplitPick, Field(discriminator="transform_type")]


# --- pipelines -------------------------------------------------------------


class TransformerPipeline(SpecModel):
    id: str
    pipeline_type: Literal["transformer"]
    source: Source
    sink: Sink
    audit: Sink
    transforms: list[Transform]


class LoaderPipeline(SpecModel):
    """Loads a file of records into a topic, given as ``connector.topic``.

    The pacing keys are accepted and not used: records are loaded as fast as
    the cluster goes. Lines that don't fit the schema go to the quarantine folder,
    if one is named.
    """

    id: str
    pipeline_type: Literal["kafka_producer"]
    source_filepath_env: str
    sink_topic: str
    quarantine_filepath_env: str | None = None
    interval_seconds_mean: float | None = None
    interval_seconds_sd: float | None = None


Pipeline = Annotated[
    TransformerPipeline | LoaderPipeline, Field(discriminator="pipeline_type")
]


class Store(SpecModel):
    schemas: list[Schema]
    connectors: list[Connector]
    pipelines: list[Pipeline]

    @classmethod
    def load(
        cls, environment_name: str = "METASTORE_FILEPATH", filepath: str | None = None
    ) -> Store:
        """From the path given, else the one in the environment, else ``./metastore.yml``."""
        import yaml

        path = filepath or os.environ.get(environment_name) or "./metastore.yml"
        return cls.model_validate(yaml.safe_load(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def parse(cls, text: str) -> Store:
        import yaml

        return cls.model_validate(yaml.safe_load(text))

    def schema_named(self, name: str) -> Schema:
        return _one(self.schemas, "name", name, "schema")

    def connector(self, id: str) -> KafkaConnector | LakeConnector:
        return _one(self.connectors, "id", id, "connector")

    def pipeline(self, id: str) -> TransformerPipeline | LoaderPipeline:
        return _one(self.pipelines, "id", id, "pipeline")

    def topic(self, connector_id: str, name: str) -> KafkaTopic:
        connector = self.connector(connector_id)
        if not isinstance(connector, KafkaConnector):
            raise ValueError(f"connector {connector_id!r} has no topics")
        return _one(connector.topics, "topic_name", name, f"topic of {connector_id!r}")

    def table(self, connector_id: str, name: str) -> LakeTable:
        connector = self.connector(connector_id)
        if not isinstance(connector, LakeConnector):
            raise ValueError(f"connector {connector_id!r} has no tables")
        return _one(connector.tables, "table_name", name, f"table of {connector_id!r}")

    def source_schema(self, source: KafkaSource | FileSource) -> Schema:
        if isinstance(source, FileSource):
            return self.schema_named(source.source_schema)
        return self.schema_named(self.topic(source.connector_id, source.topic).topic_schema)

    @model_validator(mode="after")
    def _everything_resolves(self):
        _unique("schema", [s.name for s in self.schemas])
        _unique("connector", [c.id for c in self.connectors])
        _unique("pipeline", [p.id for p in self.pipelines])
        for connector in self.connectors:
            if isinstance(connector, KafkaConnector):
                _unique("topic", [t.topic_name for t in connector.topics])
                for topic in connector.topics:
                    self.schema_named(topic.topic_schema)
            else:
                _unique("table", [t.table_name for t in connector.tables])
                for table in connector.tables:
                    self.schema_named(table.table_schema)
        for pipeline in self.pipelines:
            if isinstance(pipeline, LoaderPipeline):
                self.topic(*split_topic(pipeline.sink_topic))
            else:
                self._check_transformer(pipeline)
        return self

    def _check_transformer(self, pipeline: TransformerPipeline) -> None:
        schema = self.source_schema(pipeline.source)
        for sink in (pipeline.sink, pipeline.audit):
            if isinstance(sink, LakeSink):
                table = self.table(sink.connector_id, sink.table)
                if table.partition_on not in self.schema_named(table.table_schema).fields:
                    raise ValueError(
                        f"table {sink.table!r}: {table.partition_on!r} is not a declared column"
                    )
        steps = [
            Step(
                transform.transform_type,
                transform.source_column,
                transform.destination_column,
                apply=lambda df: df,  # only the columns are followed here
                drops_source=isinstance(transform, Redact)
                and transform.source_column != transform.destination_column,
            )
            for transform in pipeline.transforms
        ]
        columns = check_steps(list(schema.fields), steps, schema.primary_field, pipeline.id)
        trail = [schema.primary_field, "old_value", "new_value", "transform_tag"]
        for sink, made in ((pipeline.sink, columns), (pipeline.audit, trail)):
            if isinstance(sink, LakeSink):
                table = self.table(sink.connector_id, sink.table)
                declared = self.schema_named(table.table_schema).fields
                missing = [c for c in declared if c not in made and c not in PER_BATCH]
                if missing:
                    raise ValueError(
                        f"pipeline {pipeline.id!r} makes no column {missing}"
                        f" of table {table.table_name!r}"
                    )
                texts = _texts_made(pipeline) if sink is pipeline.sink else set(trail[1:])
                wrong = [c for c in texts if c in declared and declared[c] != "string"]
                if wrong:
                    raise ValueError(
                        f"pipeline {pipeline.id!r} puts text into {sorted(wrong)}, which"
                        f" table {table.table_name!r} does not declare as string"
                    )


def _texts_made(pipeline: TransformerPipeline) -> set[str]:
    """Columns that end as text: redacted or split last, not looked up after that."""
    made: set[str] = set()
    for transform in pipeline.transforms:
        if isinstance(transform, Redact | SplitPick):
            made.add(transform.destination_column)
        else:
            made.discard(transform.destination_column)
    return made


def split_topic(name: str) -> tuple[str, str]:
    """``connector.topic``; the topic's own name may hold further dots."""
    connector, dot, topic = name.partition(".")
    if not (connector and dot and topic):
        raise ValueError(f"{name!r} is not of the form connector.topic")
    return connector, topic


def from_env(key: str, default_env: dict[str, str] | None = None) -> str:
    """The value of an ``*_env`` key: the environment first, then the defaults."""
    value = os.environ.get(key, (default_env or {}).get(key))
    if value is None:
        raise KeyError(f"{key} is set neither in the environment nor in the defaults")
    return value


def _one(items, attribute: str, name: str, kind: str):
    for item in items:
        if getattr(item, attribute) == name:
            return item
    known = [getattr(item, attribute) for item in items]
    raise ValueError(f"no {kind} named {name!r}, only {known}")


def _unique(kind: str, names: list[str]) -> None:
    twice = [name for name, n in Counter(names).items() if n > 1]
    if twice:
        raise ValueError(f"{kind} names given more than once: {twice}")
