"""Where an entity ended up, and its state on each day since the start."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import first_match, is_true
from tallyward.operators.reshape import day_grid

DateRules = Sequence[tuple[str, str]]
"""Ordered (date column, label); the first rule that holds wins."""


def terminal_status(
    entities: DataFrame, rules: DateRules, default: str, *, out: str = "status"
) -> DataFrame:
    """Label of the first date that is present, with its position as sort column."""
    present = [F.col(c).isNotNull() for c, _ in rules]
    return entities.withColumns(
        {
            out: first_match([(p, r[1]) for p, r in zip(present, rules, strict=True)], default),
            f"{out}_ord": first_match(
                [(p, i) for i, p in enumerate(present, start=1)], len(present) + 1
            ),
        }
    )


def status_counts(
    df: DataFrame, *, status: str = "status", order: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per status; a status nobody has gives no row."""
    order = order or f"{status}_ord"
    return (
        df.groupBy(*by, status, order).agg(F.count("*").alias("n_status")).orderBy(*by, order)
    )


def day_state(date: Column, rules: DateRules, default: str) -> tuple[Column, Column]:
    """State on a day, and whether the day is one of the dates themselves.

    A rule holds from its date on. A missing date never holds.
    """
    state = first_match([(date >= F.col(c), label) for c, label in rules], default)
    transition = reduce(or_, (is_true(date == F.col(c)) for c, _ in rules))
    return state, transition


def day_event(day: Column, named: Mapping[int, str], prefix: str) -> Column:
    """Event name of a study day: by name where listed, else prefix and number."""
    return first_match(
        [(day == d, name) for d, name in named.items()],
        F.concat(F.lit(prefix), day.cast("string")),
    )


def daily_status_timeline(
    entities: DataFrame,
    start_col: str,
    days: Sequence[int],
    rules: DateRules,
    event_name: Mapping[int, str],
    *,
    default: str = "In hospital",
    event_col: str = "event",
    event_prefix: str = "Trial Day ",
    as_of: dt.date | None = None,
) -> DataFrame:
    """One row per entity and study day: event, state and transition-day flag.

    Every entity row makes its own days, so no join and no shuffle is needed.
    """
    grid = day_grid(entities, start_col, days, as_of=as_of)
    state, transition = day_state(F.col("study_date"), rules, default)
    return grid.withColumns(
        {
            event_col: day_event(F.col("study_day"), event_name, event_prefix),
            "study_status": state,
            "transition_day": transition,
        }
    )
