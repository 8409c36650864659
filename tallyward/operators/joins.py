"""Joins to group-level tables, and of large tables in tasks of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of all sides that a task of a large join or sort meets: what it sorts, and what is
#: grouped after it by the same key, keeps its size as the tables grow.
ROWS_PER_TASK = 500_000


def tasks_for(*sides: DataFrame, rows_per_task: int | None = None) -> int | None:
    """Tasks that the rows of all ``sides`` take; None where the shuffle partitions of the
    session are enough. For rows that are cheap to count, like those of tables as read."""
    usual = int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = -(-sum(side.count() for side in sides) // (rows_per_task or ROWS_PER_TASK))
    return tasks if tasks > usual else None


def dealt_alike(
    on: Sequence[str], *sides: DataFrame, rows_per_task: int | None = None
) -> list[DataFrame]:
    """``sides`` dealt by the columns they share, to as many tasks as their rows take.

    Where the session's shuffle partitions are enough they stay as they are, for Spark to
    deal and to split where a key is hot. Joins and groups by ``on`` keep the dealing: no
    further shuffle, and a table that is joined later is dealt like them.
    """
    tasks = tasks_for(*sides, rows_per_task=rows_per_task)
    return [side.repartition(tasks, *on) if tasks else side for side in sides]


def join_groups(left: DataFrame, groups: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Join a table to one row per group; a missing group value matches itself."""
    by = list(by)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]
    rest = [F.col(f"r.{c}") for c in groups.columns if c not in by]
    return (
        left.alias("l")
        .join(groups.alias("r"), same, how)
        .select(*(F.col(f"l.{c}") for c in left.columns), *rest)
    )
