"""Replay-safe sinks and the streaming queries that feed them."""

from .fact_lookup import FactLookup
from .runs import Run, start_pipeline
from .sinks import FileSink, MemorySink, SampleSink, TableSink
from .tables import conform, ensure_table, merge_batches, read_table, with_batch_metadata, write_batch

__all__ = [
    "FactLookup",
    "FileSink",
    "MemorySink",
    "Run",
    "SampleSink",
    "TableSink",
    "conform",
    "ensure_table",
    "merge_batches",
    "read_table",
    "start_pipeline",
    "with_batch_metadata",
    "write_batch",
]
