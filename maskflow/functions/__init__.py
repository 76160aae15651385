"""Column expressions shared by the operators."""

from .columns import (
    is_plain_word,
    named,
    sentinel_number,
    strip_marker,
    title_pair,
    unit_hash,
)

__all__ = [
    "is_plain_word",
    "named",
    "sentinel_number",
    "strip_marker",
    "title_pair",
    "unit_hash",
]
