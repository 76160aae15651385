"""The audit trail: one record per input row and transform.

Each step adds one struct column ``(old_value, new_value)``; at the end they
become one array, and the audit table is that array unrolled. So the trail needs
no join, no state and no second pass over the transforms, in a batch and in a
stream alike. The tags are the same for all rows: they travel as metadata of the
array column and are put in when it is unrolled.

* ``old_value`` is what the destination column held before the step, null when
  the column is new: the value overwritten, not the value used as input.
* Both values are text, so steps on columns of different types fit one table.
* A row that a lookup multiplies is audited once for the steps before the
  lookup, and once per copy from there on.
* A primary value seen in several rows gives one record per row and step; a row
  without a primary value gives none.
* A step that leaves the value as it was is still recorded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import named
from .lookup import FIRST
from .transforms import Step

AUDIT = "__audit"
RESERVED = (AUDIT, "old_value", "new_value", "transform_tag")

_ENTRY = T.StructType(
    [
        T.StructField("old_value", T.StringType()),
        T.StructField("new_value", T.StringType()),
    ]
)
_TAGS = "transform_tags"


def transform_tag(
    pipeline_id: str, index: int, kind: str, source: str, destination: str, params: dict
) -> str:
    """The text that names a transform in the audit trail.

    Fixed format: ``dest#(i+1) = pipeline.kind(source#i, name='text', name=number)``.
    """
    shown = [f"{source}#{index}"]
    for name, value in params.items():
        shown.append(f"{name}='{value}'" if isinstance(value, str) else f"{name}={value}")
    return f"{destination}#{index + 1} = {pipeline_id}.{kind}({', '.join(shown)})"


def check_steps(
    columns: Sequence[str], steps: Sequence[Step], primary: str, pipeline_id: str
) -> list[str]:
    """Check a transform list against the columns it starts from.

    Returns the columns it ends with, before anything is planned.
    """
    reserved = [c for c in columns if c in RESERVED]
    if reserved:
        raise ValueError(f"{pipeline_id}: columns {reserved} are reserved for the audit trail")
    if primary not in columns:
        raise ValueError(f"{pipeline_id}: primary column {primary!r} not found in {list(columns)}")
    present = list(columns)
    for index, step in enumerate(steps):
        tag = _tag(pipeline_id, index, step)
        if step.source not in present:
            raise ValueError(f"source column {step.source!r} of {tag} not found in {present}")
        if step.destination == primary:
            raise ValueError(f"{tag} would overwrite the primary column {primary!r}")
        if step.destination in RESERVED:
            raise ValueError(f"destination of {tag} is reserved for the audit trail")
        if step.drops_source and step.source == primary:
            raise ValueError(f"{tag} would remove the primary column {primary!r}")
        if step.destination not in present:
            present.append(step.destination)
        if step.drops_source:
            present.remove(step.source)
    return present


def apply_audited(
    df: DataFrame, steps: Sequence[Step], primary: str, pipeline_id: str
) -> DataFrame:
    """Apply the steps in order; the result has the audit array as last column."""
    check_steps(df.columns, steps, primary, pipeline_id)
    entries: list[str] = []
    for index, step in enumerate(steps):
        stash, entry = f"__old_{index}", f"__entry_{index}"
        if step.destination in df.columns:
            old = named(step.destination).cast("string")
        else:
            old = F.lit(None).cast("string")
        df = step.apply(df.withColumn(stash, old))
        added = {
            entry: F.struct(
                F.col(stash).alias("old_value"),
                named(step.destination).cast("string").alias("new_value"),
            )
        }
        if step.fans_out:
            # Copies beyond the first leave the earlier steps to the first one.
            added |= {e: F.when(F.col(FIRST), F.col(e)) for e in entries}
        df = df.withColumns(added).drop(FIRST)
        entries.append(entry)
    trail = F.array(*entries) if entries else F.array().cast(T.ArrayType(_ENTRY))
    hidden = [f"__old_{index}" for index in range(len(steps))] + entries
    tags = [_tag(pipeline_id, index, step) for index, step in enumerate(steps)]
    return df.withColumn(AUDIT, trail).drop(*hidden).withMetadata(AUDIT, {_TAGS: tags})


def split_audit(
    df: DataFrame, primary: str, tags: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The transformed records, and their audit trail as a table of its own.

    ``tags`` are needed only where the column's metadata has been lost.
    """
    tags = audit_tags(df) if tags is None else tags
    # The outer form adds no filter on the array's size, which would build every
    # array twice; entries that are null belong to another copy of the row.
    unrolled = (
        df.where(named(primary).isNotNull())
        .select(named(primary), F.posexplode_outer(AUDIT).alias("__step", "__entry"))
        .where(F.col("__entry").isNotNull())
    )
    tag = F.lit(None).cast("string")
    if tags:
        tag = F.get(F.array(*[F.lit(t) for t in tags]), F.col("__step"))
    trail = unrolled.select(named(primary), "__entry.*", tag.alias("transform_tag"))
    return df.drop(AUDIT), trail


def audit_tags(df: DataFrame) -> list[str]:
    """The tags of the steps an audited table has been through."""
    return df.schema[AUDIT].metadata[_TAGS]


def audit_schema(primary: T.StructField) -> T.StructType:
    """The declared shape of an audit table, to read it back by."""
    tag = T.StructField("transform_tag", T.StringType())
    return T.StructType([T.StructField(primary.name, primary.dataType), *_ENTRY.fields, tag])


def _tag(pipeline_id: str, index: int, step: Step) -> str:
    return transform_tag(
        pipeline_id, index, step.kind, step.source, step.destination, step.params
    )
