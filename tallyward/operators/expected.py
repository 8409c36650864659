"""Expected against observed visits: which share of the visits due was measured."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import is_in, percent_text, ratio
from tallyward.operators.reshape import merge_text, split_pair, sums_to_long
from tallyward.operators.status import DateRules, day_state


@dataclass(frozen=True)
class Visit:
    """A visit that is due on a study day while the entity is in one of the states."""

    day: int
    event: str
    label: str
    states: tuple[str, ...]
    or_transition: bool = False


def timed_observations(
    records: DataFrame,
    time_cols: Sequence[str],
    *,
    event_col: str = "event",
    cut: Collection[str] = (),
    sep: str = " and ",
    second_event: str = "Discharge Day",
    second_time: str = "Discharge",
) -> DataFrame:
    """Observations with one time label; a label naming two times makes two rows.

    The time label is spread over several columns; phrases of ``cut`` are no part of it. ``Day 5 and Discharge`` stands for
    the record's own event and for ``second_event``. Rows without a label are left out.
    """
    label = merge_text([F.col(c) for c in time_cols], cut=cut)
    first, double = split_pair(F.col("_label"), sep)
    own = F.struct(F.col(event_col).alias("event"), first.alias("time"))
    copy = F.struct(F.lit(second_event).alias("event"), F.lit(second_time).alias("time"))
    rows = F.when(double, F.array(own, copy)).otherwise(F.array(own))
    keep = [c for c in records.columns if c not in {*time_cols, event_col}]
    return (
        records.withColumn("_label", label)
        .where(F.col("_label").isNotNull())
        .select(*keep, F.explode(rows).alias("_row"))
        .select(
            *keep,
            F.col("_row.event").alias(event_col),
            F.col("_row.time").alias("specimen_time"),
        )
    )


def expected_vs_observed(
    entities: DataFrame,
    observations: DataFrame,
    schedule: Sequence[Visit],
    *,
    measures: Mapping[str, str],
    rules: DateRules,
    start_col: str = "enroll_date",
    id_cols: Sequence[str] = ("id",),
    event_col: str = "event",
    default_state: str = "In hospital",
    not_expected: Collection[tuple[str, str]] = (),
    min_value: float = 0,
    dedupe: bool = False,
    as_of: dt.date | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Compliance per visit and measure: visits due, visits measured, their share.

    ``measures`` maps an observation column to its label; a visit counts as measured
    where the value is above ``min_value``. A visit due without an observation counts
    as not measured. Several observations of one visit count once each, or once in
    all with ``dedupe``. ``as_of`` leaves out visits due after it; pairs of visit and
    measure label in ``not_expected`` are not reported. Entities without a start date
    have no study days.

    Observations are counted per entity before they are shuffled, so an entity with
    very many of them sends a few numbers only, and the join carries one row per
    entity instead of one per visit.
    """
    ids = list(id_cols)
    counters = []
    for i, visit in enumerate(schedule):
        here = F.col(event_col) == visit.event
        counters.append(F.count_if(here).alias(f"_n{i}"))
        counters += [
            F.count_if(here & (F.col(m) > min_value)).alias(f"_n{i}_{j}")
            for j, m in enumerate(measures)
        ]
    observed = (
        observations.where(F.col(event_col).isin([v.event for v in schedule]))
        .groupBy(*ids)
        .agg(*counters)
    )
    dates = list(dict.fromkeys([start_col, *(c for c, _ in rules)]))
    joined = (
        entities.where(F.col(start_col).isNotNull())
        .select(*dict.fromkeys([*by, *ids, *dates]))
        .join(observed, ids, "left")
    )

    def counted(name: str) -> Column:
        n = F.coalesce(F.col(name), F.lit(0).cast("long"))
        return F.least(n, F.lit(1).cast("long")) if dedupe else n

    done = [f"_d{j}" for j in range(len(measures))]
    visits = F.array(
        *(
            F.struct(
                F.lit(visit.label).alias("day"),
                F.lit(i).alias("day_ord"),
                F.lit(visit.day - 1).alias("_after"),
                counted(f"_n{i - 1}").alias("_n"),
                *(counted(f"_n{i - 1}_{j}").alias(d) for j, d in enumerate(done)),
            )
            for i, visit in enumerate(schedule, start=1)
        )
    )
    date = F.date_add(start_col, F.col("_after"))
    state, transition = day_state(date, rules, default_state)
    terms: dict[tuple[tuple[str, ...], bool], list[int]] = {}
    for i, visit in enumerate(schedule, start=1):
        terms.setdefault((visit.states, visit.or_transition), []).append(i)
    due = reduce(
        or_,
        (
            F.col("day_ord").isin(days) & (is_in(state, states) | (F.lit(any_change) & transition))
            for (states, any_change), days in terms.items()
        ),
    )
    if as_of is not None:
        due = due & (date <= F.lit(as_of))
    keys = [*by, "day", "day_ord"]
    sums = (
        joined.select(*dict.fromkeys([*by, *dates]), F.inline(visits))
        .where(due)
        .groupBy(*keys)
        .agg(
            F.sum(F.greatest(F.col("_n"), F.lit(1).cast("long"))).alias("n_expected"),
            *(F.sum(d).alias(d) for d in done),
        )
    )
    long = sums_to_long(
        sums,
        keys,
        {label: ("n_expected", d) for d, label in zip(done, measures.values(), strict=True)},
        "measure",
        ("n_expected", "n_done"),
    )
    for day, measure in not_expected:
        long = long.where(~((F.col("day") == day) & (F.col("measure") == measure)))
    return long.withColumn(
        "compliance", ratio(F.col("n_done"), F.col("n_expected"))
    ).orderBy(*by, "day_ord", "measure")


def compliance_text(compliance: DataFrame) -> DataFrame:
    """Chart text of each bar, e.g. ``Day 1, blue: 83%``."""
    return compliance.withColumn(
        "htext",
        F.concat(
            F.col("day"), F.lit(", "), F.col("measure"), F.lit(": "),
            percent_text(F.col("compliance")),
        ),
    )
