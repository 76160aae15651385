"""Operators: each takes and returns DataFrames."""

from .aggregates import most_common, n_rarest
from .audit import (
    AUDIT,
    apply_audited,
    audit_schema,
    audit_tags,
    check_steps,
    split_audit,
    transform_tag,
)
from .bucket_table import BucketTable
from .lookup import Lookup, prepare_lookup
from .rows import row_id, zip_rows
from .sampling import preview, sample_uniform, sample_weighted, smallest
from .transforms import (
    Step,
    redact,
    redact_step,
    split_pick,
    split_pick_step,
    translate,
    translate_step,
)
from .upsert import upsert

__all__ = [
    "AUDIT",
    "BucketTable",
    "Lookup",
    "Step",
    "apply_audited",
    "audit_schema",
    "audit_tags",
    "check_steps",
    "most_common",
    "n_rarest",
    "prepare_lookup",
    "preview",
    "redact",
    "redact_step",
    "row_id",
    "sample_uniform",
    "sample_weighted",
    "smallest",
    "split_audit",
    "split_pick",
    "split_pick_step",
    "transform_tag",
    "translate",
    "translate_step",
    "upsert",
    "zip_rows",
]
