"""From a specification to one Spark plan, run as a batch or as a stream."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import folders, spec
from ..functions import named
from ..operators import (
    Lookup,
    Step,
    apply_audited,
    audit_schema,
    prepare_lookup,
    redact_step,
    split_audit,
    split_pick_step,
    translate_step,
)
from ..session import shared_root
from ..sources import decode_json, flag_malformed, read_files, read_kafka, read_lookup
from ..sources.decode import CORRUPT, REASONS, REASONS_TYPE, with_reasons
from ..streaming import FileSink, MemorySink, Run, TableSink, start_pipeline
from ..streaming.sinks import Sink

_REJECTED = T.StructType([T.StructField("value", T.StringType()), T.StructField(REASONS, REASONS_TYPE)])


@dataclass
class Plan:
    """A compiled pipeline; nothing has been read yet but the lookups' sizes."""

    pipeline_id: str
    primary: str
    audited: DataFrame
    data_sink: Sink
    audit_sink: Sink
    rejected: DataFrame | None = None
    rejected_sink: FileSink | None = None
    lookups: list[Lookup] = field(default_factory=list)
    records: DataFrame | None = None
    steps: list[Step] = field(default_factory=list)

    @property
    def per_batch(self) -> bool:
        """Whether a stream joins batch by batch: a batch's hot keys can be told, a stream's not."""
        return any(not lookup.broadcast and lookup.hot_share is not None for lookup in self.lookups)

    @property
    def good(self) -> DataFrame:
        """The audited records; a stream with a quarantine has malformed rows among them."""
        if CORRUPT not in self.audited.columns:
            return self.audited
        return self.audited.where(F.col(CORRUPT).isNull()).drop(CORRUPT)

    @property
    def data(self) -> DataFrame:
        return split_audit(self.good, self.primary)[0]

    @property
    def audit(self) -> DataFrame:
        return split_audit(self.good, self.primary)[1]

    def explain(self, mode: str = "formatted") -> None:
        self.data.explain(mode=mode)
        self.audit.explain(mode=mode)

    def close(self) -> None:
        for lookup in self.lookups:
            lookup.close()


def build(
    spark: SparkSession,
    store: spec.Store,
    pipeline_id: str,
    default_env: dict[str, str] | None = None,
    streaming: bool = True,
) -> Plan:
    pipeline = store.pipeline(pipeline_id)
    if not isinstance(pipeline, spec.TransformerPipeline):
        raise ValueError(f"pipeline {pipeline_id!r} transforms nothing; use run_loader")
    schema = store.source_schema(pipeline.source)
    records, rejected = _records(spark, store, pipeline.source, default_env, streaming)
    lookups: list[Lookup] = []
    steps = [
        _step(spark, transform, default_env, lookups, streaming)
        for transform in pipeline.transforms
    ]
    audited = apply_audited(records, steps, schema.primary_field, pipeline_id)
    trail_schema = audit_schema(schema.primary())
    data_schema = T.StructType([f for f in audited.schema.fields if f.name in _data(audited)])
    return Plan(
        pipeline_id=pipeline_id,
        primary=schema.primary_field,
        audited=audited,
        data_sink=_sink(store, pipeline.sink, data_schema, default_env),
        audit_sink=_sink(store, pipeline.audit, trail_schema, default_env),
        rejected=rejected,
        rejected_sink=_rejected_sink(pipeline, default_env),
        lookups=lookups,
        records=records,
        steps=steps,
    )


def run_batch(
    spark: SparkSession,
    store: spec.Store,
    pipeline_id: str,
    default_env: dict[str, str] | None = None,
    run_id: str | None = None,
) -> Plan:
    """Transform everything the source holds now, and write both outputs.

    Every run adds its rows, under an id of its own. A run given the ``run_id`` of
    an earlier one replaces it, so that a failed run can be repeated. Each output
    reads only the columns it needs, so the source is scanned twice rather than
    stored: the trail touches few columns and no copy of the input is kept.
    """
    run_id = run_id or f"batch-{uuid.uuid4()}"
    plan = build(spark, store, pipeline_id, default_env, streaming=False)
    outputs = [(plan.data_sink, plan.data), (plan.audit_sink, plan.audit)]
    if plan.rejected is not None:
        outputs.append((plan.rejected_sink, plan.rejected))
    try:
        for sink, frame in outputs:
            sink.prepare(spark)
            sink.write(frame, run_id, 0)
            if isinstance(sink, MemorySink):
                sink.snapshot(spark)
    finally:
        plan.close()
    return plan


def run_stream(
    spark: SparkSession,
    store: spec.Store,
    pipeline_id: str,
    default_env: dict[str, str] | None = None,
    available_now: bool = False,
    checkpoint: str | None = None,
    changed_steps: str = "refuse",
) -> Run:
    """Start the pipeline; a restart on the same checkpoint goes on where it was.

    A checkpoint belongs to its steps: with other transforms, another order or another lookup
    file a restart would write rows that no single pipeline makes, and is refused unless
    ``changed_steps`` is ``accept``. What a lookup file holds may change.

    Sinks that outlast the session need a checkpoint that does: ``checkpoint``, or
    the folder in ``spark.checkpoint.dir``. A new one at every start would read the
    source again and add every row again.
    """
    plan = build(spark, store, pipeline_id, default_env)
    try:
        kept = not isinstance(plan.data_sink, MemorySink) or not isinstance(plan.audit_sink, MemorySink)
        if checkpoint is None and kept and not _shared_setting(spark):
            raise ValueError(
                f"pipeline {pipeline_id!r} writes files: give a checkpoint, or set spark.checkpoint.dir"
            )
        checkpoint = checkpoint or f"{shared_root(spark)}/streams/{pipeline_id}"
        _check_steps(spark, checkpoint, canonical_steps(store, pipeline_id, default_env), changed_steps)
        run = start_pipeline(
            plan.audited,
            plan.primary,
            plan.data_sink,
            plan.audit_sink,
            checkpoint,
            pipeline_id,
            available_now,
            plan.rejected_sink,
            CORRUPT,
            records=plan.records if plan.per_batch else None,
            explain_rejected=_reasons_by(store, pipeline_id),
            prepare=lambda batch: apply_audited(batch, plan.steps, plan.primary, pipeline_id),
        )
    except Exception:
        plan.close()
        raise
    run.on_stop.append(plan.close)
    return run


def canonical_steps(store: spec.Store, pipeline_id: str, default_env: dict[str, str] | None = None) -> list[str]:
    """The steps of a pipeline as text, one per transform, first its primary and fields.

    Keys are in order and files by their place, so equal steps give equal text however the
    specification was written down.
    """
    pipeline = store.pipeline(pipeline_id)
    schema = store.source_schema(pipeline.source)
    steps = [{"primary": schema.primary_field, "fields": schema.spark_schema().jsonValue()["fields"]}]
    for transform in pipeline.transforms:
        step = transform.model_dump(mode="json")
        if "fixture_filepath_env" in step:
            step["fixture"] = spec.from_env(step.pop("fixture_filepath_env"), default_env)
        steps.append(step)
    return [json.dumps(step, sort_keys=True) for step in steps]


def _check_steps(spark: SparkSession, checkpoint: str, steps: list[str], changed: str) -> None:
    """Compare the steps with those kept beside the checkpoint, and keep them."""
    if changed not in ("refuse", "accept"):
        raise ValueError(f"changed_steps must be 'refuse' or 'accept', not {changed!r}")
    kept = f"{checkpoint.rstrip('/')}_steps"
    digest = hashlib.sha256("\n".join(steps).encode()).hexdigest()
    known = [n for n in folders.names(spark, kept) if n.startswith("digest=") and folders.whole(spark, f"{kept}/{n}")]
    if known == [f"digest={digest}"]:
        return
    if known and changed == "refuse":
        old = spark.read.schema("step string, place int").json(f"{kept}/{known[0]}").orderBy("place").collect()
        before = [row["step"] for row in old]
        at = next((i for i, pair in enumerate(zip(before, steps)) if pair[0] != pair[1]), min(len(before), len(steps)))
        was, now = (s[at] if at < len(s) else "nothing" for s in (before, steps))
        raise ValueError(
            f"the checkpoint {checkpoint!r} was made with other steps: at step {at} was {was}, is {now};"
            " take a new checkpoint, or give changed_steps='accept'"
        )
    rows = spark.createDataFrame([(s, i) for i, s in enumerate(steps)], "step string, place int")
    rows.coalesce(1).write.mode("overwrite").json(f"{kept}/digest={digest}")
    for other in known:
        folders.delete(spark, f"{kept}/{other}")


def _reasons_by(store: spec.Store, pipeline_id: str) -> Callable[[DataFrame], DataFrame]:
    """What a quarantine adds to the text of a malformed row."""
    schema = store.source_schema(store.pipeline(pipeline_id).source).spark_schema()
    return lambda bad: with_reasons(bad, schema)


def _shared_setting(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def explain(
    spark: SparkSession,
    store: spec.Store,
    pipeline_id: str,
    default_env: dict[str, str] | None = None,
    streaming: bool = True,
) -> None:
    """Print the plans of the records and of the audit trail."""
    plan = build(spark, store, pipeline_id, default_env, streaming)
    plan.explain()
    plan.close()


def _records(
    spark: SparkSession,
    store: spec.Store,
    source: spec.KafkaSource | spec.FileSource,
    default_env: dict[str, str] | None,
    streaming: bool,
) -> tuple[DataFrame, DataFrame | None]:
    schema = store.source_schema(source).spark_schema()
    if isinstance(source, spec.FileSource):
        path = spec.from_env(source.filepath_env, default_env)
        raw = read_files(spark, path, source.format, schema, streaming, source.options)
        if source.format != "json":
            return raw, None
    else:
        connector = store.connector(source.connector_id)
        brokers = spec.from_env(connector.broker_env, default_env)
        raw = read_kafka(spark, brokers, source.topic, streaming, source.options)
    if source.on_malformed == "keep":
        return decode_json(raw, schema), None
    flagged = flag_malformed(raw, schema)
    if streaming:
        # One query writes both; a malformed row has no values that a lookup could multiply.
        whole = F.col(CORRUPT).isNull()
        fields = [F.when(whole, named(f.name)).alias(f.name) for f in schema.fields]
        return flagged.select(*fields, CORRUPT), None
    good = flagged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = flagged.where(F.col(CORRUPT).isNotNull())
    return good, with_reasons(bad.select(named(CORRUPT).alias("value")), schema)


def _step(
    spark: SparkSession,
    transform: spec.Translate | spec.Redact | spec.SplitPick,
    default_env: dict[str, str] | None,
    lookups: list[Lookup],
    streaming: bool,
) -> Step:
    source, destination = transform.source_column, transform.destination_column
    if isinstance(transform, spec.Redact):
        return redact_step(source, destination, transform.replace_with)
    if isinstance(transform, spec.SplitPick):
        return split_pick_step(source, destination, transform.split_by, transform.pick_index)
    path = spec.from_env(transform.fixture_filepath_env, default_env)
    lookup = prepare_lookup(
        read_lookup(spark, path),
        transform.key_column,
        transform.value_column,
        transform.on_duplicate_key,
        # A stream joins the lookup again in every micro-batch, each one as a batch.
        salts=1 if streaming else None,
        cache=streaming,
    )
    lookups.append(lookup)
    fixture = PurePosixPath(path).stem
    return translate_step(
        source, destination, lookup, fixture, transform.key_column, transform.value_column
    )


def _data(audited: DataFrame) -> list[str]:
    # The audit array comes last.
    return [c for c in audited.columns[:-1] if c != CORRUPT]


def _sink(
    store: spec.Store,
    sink: spec.LakeSink | spec.FileSink | spec.MemorySink,
    columns: T.StructType,
    default_env: dict[str, str] | None,
) -> Sink:
    if isinstance(sink, spec.LakeSink):
        table = store.table(sink.connector_id, sink.table)
        return TableSink(
            path=spec.from_env(table.filepath_env, default_env),
            schema=store.schema_named(table.table_schema).spark_schema(),
            format=table.format,
            partition_on=table.partition_on,
            trigger_seconds=sink.trigger_seconds,
            coalesce=sink.coalesce,
        )
    if isinstance(sink, spec.FileSink):
        return FileSink(
            path=spec.from_env(sink.filepath_env, default_env),
            schema=columns,
            format=sink.format,
            trigger_seconds=sink.trigger_seconds,
            coalesce=sink.coalesce,
        )
    return MemorySink(
        query_name=sink.query_name,
        query_interval=sink.query_interval,
        duration_seconds=sink.duration_seconds,
        schema=columns,
    )


def _rejected_sink(
    pipeline: spec.TransformerPipeline, default_env: dict[str, str] | None
) -> FileSink | None:
    if pipeline.source.quarantine_filepath_env is None:
        return None
    return FileSink(
        path=spec.from_env(pipeline.source.quarantine_filepath_env, default_env),
        schema=_REJECTED,
        format="json",
        trigger_seconds=getattr(pipeline.sink, "trigger_seconds", None),
    )
