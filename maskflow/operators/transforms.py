"""The three column transforms, as plain functions and as pipeline steps.

Each takes a DataFrame, batch or streaming, and returns one. They keep the
order of columns: an existing destination is replaced where it stands, a new
one is added at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import named
from .lookup import FIRST, Lookup, join_lookup, prepare_lookup


def translate(
    df: DataFrame,
    source: str,
    destination: str,
    lookup: DataFrame | Lookup,
    key: str | None = None,
    value: str | None = None,
    **options,
) -> DataFrame:
    """Look ``source`` up and put the value found in ``destination``.

    A record without a match keeps its row and gets null. A key that the lookup
    holds m times makes m rows, or an error when ``on_duplicate_key="error"``.
    Other options are those of ``prepare_lookup``.
    """
    if isinstance(lookup, DataFrame):
        lookup = prepare_lookup(lookup, key, value, mark_first=False, **options)
    return join_lookup(df, source, destination, lookup).drop(FIRST)


def redact(df: DataFrame, source: str, destination: str, replace_with: str) -> DataFrame:
    """Put a constant in ``destination`` and drop ``source`` unless they are one column."""
    out = df.withColumn(destination, F.lit(replace_with))
    return out if source == destination else out.drop(source)


def split_pick(
    df: DataFrame, source: str, destination: str, split_by: str, pick_index: int
) -> DataFrame:
    """Split a text by a regular expression and keep one piece, counted from 0.

    ``split_by`` is a Java regular expression: to split by a bar, give ``\\|``.
    A piece that does not exist is null.
    """
    return df.withColumn(destination, _piece(named(source), split_by, pick_index))


# The characters that mean something else in a regular expression.
_REGEX_CHARACTERS = frozenset("\\^$.|?*+()[]{}")


def _piece(text: Column, split_by: str, index: int) -> Column:
    if index < 0:
        return F.lit(None).cast("string")
    if len(split_by) != 1 or split_by in _REGEX_CHARACTERS:
        # Cut only as far as the piece wanted, so the rest of a text stays whole.
        return F.get(F.split(text, split_by, index + 2), F.lit(index))
    # One plain character is found in the bytes as they are, some three times
    # faster than by an expression over decoded text.
    head = F.substring_index(text, split_by, index + 1)
    if index == 0:
        return head
    found = F.length(text) - F.length(F.replace(text, F.lit(split_by), F.lit("")))
    return F.when(found >= index, F.substring_index(head, split_by, -1))


@dataclass(frozen=True)
class Step:
    """One entry of a pipeline's transform list.

    ``params`` are what the audit tag shows. A step that ``fans_out`` returns
    the column ``FIRST`` next to its result.
    """

    kind: str
    source: str
    destination: str
    apply: Callable[[DataFrame], DataFrame]
    params: dict[str, str | int] = field(default_factory=dict)
    fans_out: bool = False
    drops_source: bool = False


def translate_step(
    source: str, destination: str, lookup: Lookup, fixture: str, key: str, value: str
) -> Step:
    return Step(
        "translate",
        source,
        destination,
        lambda df: join_lookup(df, source, destination, lookup),
        {"fixture": fixture, "key_column": key, "value_column": value},
        fans_out=lookup.marked,
    )


def redact_step(source: str, destination: str, replace_with: str) -> Step:
    return Step(
        "redact",
        source,
        destination,
        lambda df: redact(df, source, destination, replace_with),
        {"replace_with": replace_with},
        drops_source=source != destination,
    )


def split_pick_step(source: str, destination: str, split_by: str, pick_index: int) -> Step:
    return Step(
        "split_pick",
        source,
        destination,
        lambda df: split_pick(df, source, destination, split_by, pick_index),
        {"split_by": split_by, "pick_index": pick_index},
    )
