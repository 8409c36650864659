"""Threshold bands for proportions and alert levels for dashboard figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions.logic import first_match

_TESTS = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def threshold_band(
    col: Column, cuts: Sequence[tuple[str, float, str]], default: str | None
) -> Column:
    """Label of the first cut ``(test, value, label)`` that holds, else ``default``.

    Missing and not-a-number values take the default: a NaN would otherwise pass
    every ``>`` test.
    """
    clean = F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    return first_match([(_TESTS[op](clean, v), label) for op, v, label in cuts], default)


def alert_below(col: Column, warn: float) -> Column:
    """``warn`` under the limit, else ``ok``; null when there is no figure."""
    return F.when(col.isNotNull(), threshold_band(col, [("<", warn, "warn")], "ok"))


def alert_above(col: Column, bad: float, warn: float) -> Column:
    """``bad`` over the upper limit, ``warn`` over the lower one, else ``ok``."""
    return F.when(
        col.isNotNull(), threshold_band(col, [(">", bad, "bad"), (">", warn, "warn")], "ok")
    )
