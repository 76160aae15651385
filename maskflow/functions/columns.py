"""Built-in-only column expressions, so every use stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def unit_hash(seed: int | str, *keys: Column, algorithm: str = "xxhash64") -> Column:
    """A repeatable number in (0, 1) from a seed and the given keys.

    ``xxhash64`` is the fast choice; ``md5`` costs some ten times as much and
    lets other engines repeat the draw. Either way 52 bits are taken, and adding
    one half keeps both ends of the interval out.
    """
    if algorithm == "xxhash64":
        bits = F.xxhash64(F.lit(str(seed)), *keys).bitwiseAND(F.lit((1 << 52) - 1))
    elif algorithm == "md5":
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))
        bits = F.conv(F.substring(digest, 1, 13), 16, 10)
    else:
        raise ValueError(f"algorithm must be 'xxhash64' or 'md5', not {algorithm!r}")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def strip_marker(text: Column, marker: str) -> Column:
    """Remove a literal marker wherever it occurs."""
    return F.replace(text, F.lit(marker), F.lit(""))


def sentinel_number(value: Column, sentinel: str = "*", stands_for: int = 1) -> Column:
    """Text to a whole number, with one sentinel text standing for a number.

    Other text that is no number raises under ANSI mode, as it should: a usage
    count that cannot be read must not silently become a zero weight.
    """
    return F.when(value.cast("string") == sentinel, F.lit(stands_for).cast("long")).otherwise(
        value.cast("long")
    )


def is_plain_word(word: Column) -> Column:
    """A lower-case word with neither hyphen nor underscore."""
    return ~word.contains("-") & ~word.contains("_") & (F.lower(word) == word)


def title_pair(first: Column, second: Column) -> Column:
    """Two words in title case, joined by a hyphen."""
    return F.concat(F.initcap(first), F.lit("-"), F.initcap(second))
