"""Ratios, rounding and number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_half_even(col: Column, places: int = 0) -> Column:
    """Round with ties to the even digit."""
    return F.rint(col) if places == 0 else F.bround(col, places)


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, ties to the even digit."""
    return F.rint(ratio(part, whole) * 100)


def percent_text(share: Column) -> Column:
    """A share as whole-percent text, e.g. ``98%``; null stays null."""
    return F.concat(F.rint(share * 100).cast("long").cast("string"), F.lit("%"))


def thousands(col: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(col, 0)
