"""Operators on column sets: renaming and selecting by pattern, typing, test rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import contains_any_case, parse_date, parse_datetime


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; fails if two names would become one."""
    names = [rule(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if clashes:
        raise ValueError(f"columns would share a name after renaming: {clashes}")
    return df.toDF(*names)


def unify_endings(df: DataFrame, endings: Mapping[str, Collection[str]]) -> DataFrame:
    """Give names that end in several ways one ending: ``{ending: the ways it is spelt}``.

    Of the spellings that fit a name the longest counts; other names stay.
    """
    spelt = {way: ending for ending, ways in endings.items() for way in ways}

    def rule(name: str) -> str:
        way = max((w for w in spelt if name.endswith(w)), key=len, default="")
        return name.removesuffix(way) + spelt.get(way, "")

    return rename_all(df, rule)


def matching(
    df: DataFrame,
    *,
    prefix: str | Iterable[str] | None = None,
    suffix: str | Iterable[str] | None = None,
    pattern: str | None = None,
    any_of: Iterable[str] = (),
) -> list[str]:
    """Names of the columns that meet at least one of the rules, in table order."""

    def ends(rule: str | Iterable[str] | None) -> tuple[str, ...]:
        return () if rule is None else (rule,) if isinstance(rule, str) else tuple(rule)

    wanted = set(any_of)
    return [
        c
        for c in df.columns
        if c in wanted
        or c.startswith(ends(prefix))
        or c.endswith(ends(suffix))
        or (pattern is not None and re.search(pattern, c))
    ]


def drop_test_entities(df: DataFrame, id_col: str, marker: str = "test") -> DataFrame:
    """Leave out rows whose id contains the marker, in any case. Rows without id stay."""
    return df.where(~contains_any_case(F.col(id_col), marker))


def with_parsed_datetimes(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Parse text columns to timestamps and add a ``<name>_date`` column for each."""
    cols = list(cols)
    parsed = df.withColumns({c: parse_datetime(F.col(c)) for c in cols})
    return parsed.withColumns({f"{c}_date": F.to_date(c) for c in cols})


def with_parsed_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Parse text columns to dates, in place."""
    return df.withColumns({c: parse_date(F.col(c)) for c in cols})
