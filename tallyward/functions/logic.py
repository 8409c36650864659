"""Three-valued logic, ordered rules and row-wise counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(cond: Column) -> Column:
    """The condition, with unknown read as false."""
    return F.coalesce(cond, F.lit(False))


def is_in(col: Column, values: Iterable[object]) -> Column:
    """Membership that is false, not null, on a missing value."""
    return is_true(col.isin(list(values)))


def not_null_and_prefix(col: Column, prefix: str) -> Column:
    """Completion flag that is never null: present and starting with ``prefix``."""
    return is_true(col.startswith(prefix))


def filled(col: Column, value: object, when: Column) -> Column:
    """``value`` where the column is null and ``when`` holds; else unchanged."""
    return F.when(col.isNull() & when, F.lit(value)).otherwise(col)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule that is true; an unknown condition does not match."""
    if not rules:
        return F.lit(default)
    (cond, value), *rest = rules
    out = F.when(cond, F.lit(value))
    for cond, value in rest:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def recode(col: Column, mapping: Mapping[str, object], default: Column | None = None) -> Column:
    """Look a value up in a small fixed table; ``default`` (null) where it is not listed."""
    if not mapping:
        return F.lit(None) if default is None else default
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    hit = F.try_element_at(F.create_map(*pairs), col)
    return hit if default is None else F.coalesce(hit, default)


def count_done(cols: Iterable[Column]) -> Column:
    """How many flags of the row are true; a missing flag counts as not done."""
    return sum(
        (F.coalesce(c.cast("int"), F.lit(0)) for c in cols), start=F.lit(0)
    )


def all_true(cols: Iterable[Column]) -> Column:
    """Are all flags of the row true? Null if undecided, as SQL ``AND``."""
    return reduce(and_, cols, F.lit(True))
