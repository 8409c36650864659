"""Places of rows in the sorted order of their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.joins import join_groups, tasks_for
from tallyward.sources.staging import staged

#: Bits of a row's number in its partition, as ``monotonically_increasing_id`` has them.
IN_PARTITION = 33


def with_positions(
    df: DataFrame,
    order: Sequence[str],
    *,
    by: Sequence[str] = (),
    position: str = "position",
    size: str = "group_size",
) -> DataFrame:
    """``df`` with each row's place in its group, from 0, and the size of the group.

    The input is worked out once, into a written table, whose size says how many ranges
    of (group, order) its rows are dealt to. They are written again, sorted, with their place
    in the range. The counts of each range give the places before it, so a group of any
    size is spread over tasks. Rows that are equal in ``order`` have places next to each
    other; nulls come first, and a missing group is a group.
    """
    by, keys = list(by), [*by, *order]
    df = staged(df)
    tasks = tasks_for(df)
    ranged = df.repartitionByRange(tasks, *keys) if tasks else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys)
    rows = staged(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", IN_PARTITION)
    # In a range, the rows of a group follow each other.
    parts = rows.groupBy(*by, part.alias("_part")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *by,
        "_part",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(group).alias(size),
    )
    placed = join_groups(rows.withColumn("_part", part), starts, [*by, "_part"], "inner")
    return placed.withColumn(position, F.col("_place") + F.col("_shift")).select(
        *df.columns, position, size
    )


def text_pages(
    df: DataFrame,
    id_col: str,
    *,
    by: Sequence[str] = (),
    per_page: int = 1000,
    sep: str = "; ",
    missing: str = "NA",
) -> DataFrame:
    """Ids of each group in sorted order, as the pages of a list.

    A page holds ``per_page`` ids, the last one of a group what is left; ``page`` counts
    from 0 and ``n_ids`` is the size of the group. Ids that occur more than once stay so.
    """
    by = list(by)
    ids = df.select(*by, F.coalesce(F.col(id_col).cast("string"), F.lit(missing)).alias("_id"))
    placed = with_positions(ids, ["_id"], by=by, size="n_ids")
    page = F.floor(F.col("position") / per_page).cast("int")
    return (
        placed.groupBy(*by, page.alias("page"), "n_ids")
        .agg(F.array_join(F.array_sort(F.collect_list("_id")), sep).alias("ids"))
        .select(*by, "page", "n_ids", "ids")
    )
