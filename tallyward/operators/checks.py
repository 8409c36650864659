"""What inputs are taken to hold, counted as their rows pass by."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, Column]
"""Name of a rule -> the condition that every row should meet; null does not meet it."""


def observed(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """``df``, and the counts of its rows and of those that break each rule.

    The counts are taken by the action that works ``df`` out, without another scan, and
    are there once it has ended.
    """
    seen = Observation()
    broken = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule_{name}")
        for name, rule in rules.items()
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *broken), seen


def broken_rules(seen: Observation) -> list[tuple[str, int, int]]:
    """(rule, rows that break it, all rows) of an observation whose action has ended."""
    counts = dict(seen.get)
    n_rows = counts.pop("n_rows")
    return [(name.removeprefix("rule_"), n, n_rows) for name, n in counts.items()]


def assert_rules(table: str, seen: Observation) -> None:
    """ValueError if rows of a table broke a rule."""
    bad = [f"{rule}: {n} of {rows}" for rule, n, rows in broken_rules(seen) if n]
    if bad:
        raise ValueError(f"rows of {table} break a rule ({'; '.join(bad)})")
