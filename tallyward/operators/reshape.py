"""Reshaping: wide to long, merging and splitting text, per-entity day grids."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import cut_first, is_true


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | Mapping[str, str],
    key: str,
    value: str,
    *,
    keep_null: bool = False,
) -> DataFrame:
    """One row per id row and value column. ``values`` may map columns to key labels."""
    labels = dict(values) if isinstance(values, Mapping) else {c: c for c in values}
    renamed = df.select(*ids, *(F.col(c).alias(label) for c, label in labels.items()))
    out = renamed.unpivot(list(ids), list(labels.values()), key, value)
    return out if keep_null else out.where(F.col(value).isNotNull())


def sums_to_long(
    df: DataFrame, ids: Sequence[str], labels: Mapping[str, Sequence[str]], key: str,
    names: Sequence[str],
) -> DataFrame:
    """Long form of an aggregated row that holds several figures per label.

    ``labels`` maps a label to its columns, in the order of ``names``. One pass, and
    it runs on the aggregate, so the records themselves are never multiplied.
    """
    rows = [
        F.struct(
            F.lit(label).alias(key),
            *(F.col(c).alias(n) for c, n in zip(cols, names, strict=True)),
        )
        for label, cols in labels.items()
    ]
    return df.select(*ids, F.inline(F.array(*rows)))


def merge_text(cols: Sequence[Column], sep: str = "", cut: Collection[str] = ()) -> Column:
    """Join the text columns that are present; null if nothing is left.

    ``cut`` are phrases; the first occurrence of any of them is dropped from the result.
    """
    return cut_first(F.nullif(F.concat_ws(sep, *cols), F.lit("")), cut)


def split_pair(col: Column, sep: str) -> tuple[Column, Column]:
    """Text before the separator, and whether there is a second part."""
    return F.split_part(col, F.lit(sep), F.lit(1)), is_true(F.contains(col, F.lit(sep)))


def day_grid(
    df: DataFrame,
    start: str,
    days: Sequence[int],
    *,
    day_col: str = "study_day",
    date_col: str = "study_date",
    as_of: dt.date | None = None,
) -> DataFrame:
    """One row per dated input row and study day; day 1 is the start date.

    Only the days asked for are generated: a filter on the day column could not be
    pushed into the generator. ``as_of`` leaves out days after it.
    """
    days = list(days)
    contiguous = len(days) > 2 and days == list(range(days[0], days[-1] + 1))
    generated = (
        F.sequence(F.lit(days[0]), F.lit(days[-1]))
        if contiguous
        else F.array(*(F.lit(d) for d in days))
    )
    dated = df.where(F.col(start).isNotNull())
    out = dated.withColumn(day_col, F.explode(generated)).withColumn(
        date_col, F.date_add(start, F.col(day_col) - 1)
    )
    return out if as_of is None else out.where(F.col(date_col) <= F.lit(as_of))
