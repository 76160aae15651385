"""Streaming queries: one per pipeline, for everything that it writes."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions import named
from ..operators import audit_tags, split_audit
from .sinks import MemorySink, Paced, Sink


@dataclass
class Run:
    """The running queries of a pipeline and the sinks they fill."""

    spark: SparkSession
    queries: list[StreamingQuery]
    data_sink: Sink
    audit_sink: Sink
    on_stop: list[Callable[[], None]] = field(default_factory=list)

    def await_termination(self, timeout: float | None = None) -> bool:
        """Wait until every query has ended; False when the time is up first.

        When one query fails the others are stopped and its error is raised.
        """
        end = None if timeout is None else time.monotonic() + timeout
        pending = list(self.queries)
        try:
            while pending:
                for query in list(pending):
                    wait = 1.0 if end is None else min(1.0, max(0.0, end - time.monotonic()))
                    if query.awaitTermination(wait):
                        pending.remove(query)
                if pending and end is not None and time.monotonic() >= end:
                    return False
        except Exception:
            for query in self.queries:
                query.stop()
            self._release()
            raise
        self._release()
        return True

    def stop(self) -> None:
        """Stop every query; raises the error of one that had failed before."""
        failed = [e for e in (query.exception() for query in self.queries) if e is not None]
        for query in self.queries:
            query.stop()
        self._release()
        if failed:
            raise failed[0]

    def check(self) -> None:
        """Stop all and raise if a query has failed."""
        if any(query.exception() is not None for query in self.queries):
            self.stop()

    def snapshots(self, n: int | None = None, of: str = "data") -> Iterator[DataFrame]:
        """A snapshot of a memory sink after every interval of its duration."""
        sink = self.data_sink if of == "data" else self.audit_sink
        if not isinstance(sink, MemorySink):
            raise ValueError(f"the {of} sink keeps no snapshots")
        for _ in range(sink.duration_seconds // sink.query_interval):
            time.sleep(sink.query_interval)
            self.check()
            yield sink.snapshot(self.spark, n)

    def _release(self) -> None:
        while self.on_stop:
            self.on_stop.pop()()


def start_pipeline(
    audited: DataFrame,
    primary: str,
    data_sink: Sink,
    audit_sink: Sink,
    checkpoint: str,
    name: str,
    available_now: bool = False,
    rejected_sink: Sink | None = None,
    malformed: str | None = None,
    records: DataFrame | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    explain_rejected: Callable[[DataFrame], DataFrame] | None = None,
) -> Run:
    """Start writing an audited stream to its sinks.

    There is one query: records, audit trail and, with ``rejected_sink``, the
    rows that have text in the column ``malformed`` come from the same
    micro-batch and are written under the same query and batch id. They cannot
    drift apart, nor start at different offsets. Batches come at the shortest of the
    sinks' paces; a slower sink follows them at its own and gets a range of batches as one.

    With ``records`` the stream is of those, and ``prepare`` makes each micro-batch
    into the audited rows that ``audited`` describes: joins that first look at the
    keys of what they join need a batch. ``explain_rejected`` adds columns to the malformed text.
    """
    spark = audited.sparkSession
    tags = audit_tags(audited)
    sinks = [s for s in (data_sink, audit_sink, rejected_sink) if s is not None]
    for sink in sinks:
        if isinstance(sink, MemorySink) and sink.path is None:
            sink.path = f"{checkpoint.rstrip('/')}_memory/{sink.query_name}"
        sink.prepare(spark)
    paces = [s.trigger_seconds for s in (data_sink, audit_sink)]
    pace = None if None in paces else min(paces)
    records_to, entries_to = (
        Paced(spark, s) if s.trigger_seconds and (pace is None or s.trigger_seconds > pace) else s
        for s in (data_sink, audit_sink)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        query_id = _query_id(batch)
        whole = batch
        if records is not None:
            whole.persist(StorageLevel.MEMORY_AND_DISK)
            batch = prepare(whole)
        # All writes read the batch; fetching and decoding it once is worth
        # the storage. What an executor loses is computed again.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = batch
            if rejected_sink is not None:
                text = named(malformed)
                bad = batch.where(text.isNotNull()).select(text.alias("value"))
                if explain_rejected is not None:
                    bad = explain_rejected(bad)
                rejected_sink.write(bad, query_id, batch_id)
                good = batch.where(text.isNull()).drop(malformed)
            cleaned, entries = split_audit(good, primary, tags)
            records_to.write(cleaned, query_id, batch_id)
            entries_to.write(entries, query_id, batch_id)
        finally:
            batch.unpersist()
            whole.unpersist()

    query = _start(audited if records is None else records, write, checkpoint, name, pace, available_now)
    late = [s for s in (records_to, entries_to) if isinstance(s, Paced)]
    for sink in late:
        sink.resume(str(query.id))
    return Run(spark, [query], data_sink, audit_sink, [s.flush for s in late])


def start_append(
    df: DataFrame, sink: Sink, checkpoint: str, name: str, available_now: bool = False
) -> StreamingQuery:
    """Start writing one stream to one sink."""
    sink.prepare(df.sparkSession)
    return _start(df, _only(sink), checkpoint, name, sink.trigger_seconds, available_now)


def _only(sink: Sink) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: sink.write(batch, _query_id(batch), batch_id)


def _start(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    trigger_seconds: int | None,
    available_now: bool,
) -> StreamingQuery:
    writer = (
        df.writeStream.foreachBatch(write)
        .outputMode("append")
        .queryName(name)
        # Explicit, so that a restart resumes and keeps its query id.
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def _query_id(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
