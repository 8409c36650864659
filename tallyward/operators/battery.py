"""Completion of batteries of instruments, and of each instrument."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import (
    alert_below,
    all_true,
    cut_ending,
    not_null_and_prefix,
    percent,
    ratio,
    recode,
)
from tallyward.operators.charts import with_chart_order, with_completion_text
from tallyward.operators.reshape import sums_to_long

Instruments = Mapping[str, dt.date | None]
"""Instrument column -> date it was introduced, or None if always in use."""


def completion_flags(
    entities: DataFrame,
    instruments: Instruments,
    *,
    date_col: str = "enroll_date",
    done_prefix: str = "Yes",
) -> DataFrame:
    """Turn instrument texts into flags; null before an instrument was introduced."""
    flags = {}
    for name, since in instruments.items():
        done = not_null_and_prefix(F.col(name), done_prefix)
        if since is not None:
            date = F.col(date_col)
            done = F.when(date.isNotNull() & (date >= F.lit(since)), done)
        flags[name] = done
    return entities.withColumns(flags)


def battery_flag(battery: Sequence[str], date_col: str = "enroll_date") -> Column:
    """All instruments in use at the time done? Those not yet in use do not count.

    Null for an undated entity: what was in use for it is not known.
    """
    done = all_true(F.coalesce(F.col(c), F.lit(True)) for c in battery)
    return F.when(F.col(date_col).isNotNull(), done)


def battery_completion(
    entities: DataFrame,
    instruments: Instruments,
    batteries: Mapping[str, Sequence[str]],
    *,
    date_col: str = "enroll_date",
    done_prefix: str = "Yes",
    labels: Mapping[str, str] | None = None,
    ending: str = "",
    warn_below: float = 80,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Share of entities with each full battery, and with each instrument.

    An instrument without a label is called by its name in capitals, without ``ending``.
    All figures come from one aggregate per group; only that one row goes long, once per
    table.
    """
    by = list(by)
    flags = completion_flags(entities, instruments, date_col=date_col, done_prefix=done_prefix)
    full = {f"_b{i}": battery_flag(cols, date_col) for i, cols in enumerate(batteries.values())}
    flags = flags.select(*by, *instruments, *(c.alias(n) for n, c in full.items()))

    cols = [*full, *instruments]
    figures = flags.groupBy(*by).agg(
        *(F.count(c).alias(f"{c}_n") for c in cols),
        *(F.count_if(F.col(c)).alias(f"{c}_k") for c in cols),
    )

    def long(cols: Mapping[str, str], key: str) -> DataFrame:
        pairs = {label: (f"{c}_n", f"{c}_k") for label, c in cols.items()}
        return sums_to_long(figures, by, pairs, key, ("n_elig", "n_comp"))

    per_battery = long(dict(zip(batteries, full, strict=True)), "battery").select(
        "*",
        ratio(F.col("n_comp"), F.col("n_elig")).alias("prop_comp"),
        percent(F.col("n_comp"), F.col("n_elig")).alias("pct_comp"),
    )
    per_battery = per_battery.withColumn("alert", alert_below(F.col("pct_comp"), warn_below))

    stem = F.upper(cut_ending(F.col("instrument"), ending))
    per_instrument = long({c: c for c in instruments}, "instrument").select(
        "*",
        recode(F.col("instrument"), labels or {}, stem).alias("asmt_type"),
        ratio(F.col("n_comp"), F.col("n_elig")).alias("prop_comp"),
    )
    per_instrument = with_chart_order(per_instrument, by, "instrument")
    return per_battery, with_completion_text(per_instrument, "asmt_type")
