"""String functions."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(col: Column) -> Column:
    """Text form in which a missing value prints as ``NA``."""
    return F.coalesce(col.cast("string"), F.lit("NA"))


def contains_any_case(col: Column, needle: str) -> Column:
    """Case-blind substring test that is false, not null, on a missing value."""
    return F.coalesce(F.lower(col).contains(needle.lower()), F.lit(False))


def replace_first(col: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match only (``regexp_replace`` alone replaces all).

    ``pattern`` holds no capturing group of its own: group 1 is the text before
    the match.
    """
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col, f"^((?s).*?)(?:{pattern})", "$1" + literal)


def remove_first(col: Column, pattern: str) -> Column:
    """Drop the first match only."""
    return replace_first(col, pattern, "")


def cut_first(col: Column, phrases: Collection[str]) -> Column:
    """Drop the first occurrence of any of some plain phrases."""
    if not phrases:
        return col
    return remove_first(col, "|".join(re.escape(p) for p in phrases))


def cut_ending(col: Column, ending: str) -> Column:
    """Drop a plain ending, where a text has it."""
    if not ending:
        return col
    return F.when(col.endswith(ending), F.left(col, F.length(col) - len(ending))).otherwise(col)


def leading_integer(col: Column) -> Column:
    """The integer a label starts with, if a space follows it; else null."""
    return F.nullif(F.regexp_extract(col, r"^(\d+)(?= )", 1), F.lit("")).try_cast("int")
