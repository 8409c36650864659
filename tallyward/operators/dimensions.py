"""Dimension tables: codes to labels, types and ranks, given as input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a checked dimension is sent to all tasks.
MOST_BROADCAST = 100_000


def checked_dimension(
    dim: DataFrame, key: Sequence[str], *, broadcast_up_to: int = MOST_BROADCAST
) -> DataFrame:
    """``dim``, after one pass that finds its keys unique and not null.

    ValueError names what is wrong. A dimension of at most ``broadcast_up_to`` rows is
    marked for broadcast, a larger one is joined like any table.
    """
    key = list(key)
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    groups = dim.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    found = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count_if(missing).alias("nulls"),
        F.min(F.when(F.col("_n") > 1, F.struct(*key))).alias("repeated"),
    ).first()
    if found.nulls:
        raise ValueError(f"the dimension has rows without {key}")
    if found.repeated is not None:
        raise ValueError(f"the dimension has several rows for {found.repeated.asDict()}")
    return F.broadcast(dim) if found.rows <= broadcast_up_to else dim


def with_dimension(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], columns: Sequence[str]
) -> DataFrame:
    """``df`` with some columns of a dimension; null where it lacks the key.

    ``on`` maps columns of ``df`` to key columns of ``dim``.
    """
    own = dim.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(on.values())), *columns)
    same = [df[c] == own[f"_key{i}"] for i, c in enumerate(on)]
    return df.join(own, same, "left").select(*(df[c] for c in df.columns), *columns)


def unmatched_codes(
    df: DataFrame, dim: DataFrame, on: Mapping[str, str], *, by: Sequence[str] = ()
) -> DataFrame:
    """Codes of ``df`` that a dimension lacks, with their number of rows; null is no code."""
    used = df.groupBy(*by, *on).agg(F.count(F.lit(1)).alias("n_rows"))
    for c in on:
        used = used.where(F.col(c).isNotNull())
    keys = dim.select(*(F.col(k).alias(c) for c, k in on.items()))
    return used.join(keys, list(on), "left_anti").select(*by, *on, "n_rows")
