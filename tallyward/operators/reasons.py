"""Exclusion reasons: share of entities per month, and totals by reason type.

Reason boxes are wide: one text column per reason, checked where not null. Boxes are
counted per group first and only the counts go to long form, so records are not
multiplied by the number of reasons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import month_key, month_label, percent
from tallyward.operators.dimensions import with_dimension

ReasonDim = Mapping[str, tuple[str | None, str]] | DataFrame
"""Box column -> (label, type), or a table of ``box``, ``reason`` and ``reason_type``."""

OTHER = "Other exclusions"


def _boxes(reason_dim: ReasonDim, boxes: Sequence[str] | None) -> list[str]:
    """The box columns: those listed, or those of a dimension that is a mapping."""
    if boxes is not None:
        return list(boxes)
    if isinstance(reason_dim, DataFrame):
        raise ValueError("a dimension table needs the list of box columns")
    return list(reason_dim)


def _with_counts(
    df: DataFrame,
    groups: Sequence[Column | str],
    reason_dim: ReasonDim,
    *extra: Column,
    boxes: Sequence[str] | None = None,
    entity: Sequence[str] = (),
) -> DataFrame:
    """Checked boxes per group and reason, without zero counts.

    Boxes that share a label are added up. The result is long, one row per group and
    reason; the records were only read once. With ``entity``, the distinct entities of a
    group are counted on the way, as ``n_entities``: records are combined per group and
    entity first, and those sums per group.
    """
    names = _boxes(reason_dim, boxes)
    counts = {f"_n{i}": F.count(c) for i, c in enumerate(names)}
    if entity:
        own = [F.col(c).alias(f"_id{i}") for i, c in enumerate(entity)]
        each = df.groupBy(*groups, *own).agg(*(n.alias(c) for c, n in counts.items()))
        kept = [c for c in each.columns if c not in counts and not c.startswith("_id")]
        wide = each.groupBy(*kept).agg(
            F.count(F.lit(1)).alias("n_entities"), *(F.sum(c).alias(c) for c in counts)
        )
    else:
        wide = df.groupBy(*groups).agg(*extra, *(n.alias(c) for c, n in counts.items()))
    kept = [c for c in wide.columns if c not in counts]
    if isinstance(reason_dim, DataFrame):
        rows = [F.struct(F.lit(b).alias("box"), F.col(c).alias("n")) for b, c in zip(names, counts)]
        long = wide.select(*kept, F.inline(F.array(*rows))).where(F.col("n") > 0)
        found = with_dimension(long, reason_dim, {"box": "box"}, ["reason", "reason_type"])
        kind = F.coalesce("reason_type", F.lit(OTHER)).alias("reason_type")
        return found.groupBy(*kept, kind, "reason").agg(F.sum("n").alias("n"))
    same: dict[tuple[str | None, str], list[str]] = {}
    for box, column in zip(names, counts):
        label, kind = reason_dim[box]
        same.setdefault((label, kind or OTHER), []).append(column)
    rows = [
        F.struct(
            F.lit(kind).alias("reason_type"),
            F.lit(label).cast("string").alias("reason"),
            sum((F.col(c) for c in columns[1:]), start=F.col(columns[0])).alias("n"),
        )
        for (label, kind), columns in same.items()
    ]
    return wide.select(*kept, F.inline(F.array(*rows))).where(F.col("n") > 0)


def reason_share(
    excluded: DataFrame,
    reason_dim: ReasonDim,
    *,
    id_cols: Sequence[str] = ("exc_id",),
    date_col: str = "exc_date",
    boxes: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per month and reason: count, and percent of the month's distinct entities.

    An entity may have several reasons, so the percents of a month can add up to
    more than 100. Entities without any reason are not in the denominator; a missing
    id counts as one entity. Counts and entities come from one pass.
    """
    names = [*by, "myear", "myear_char"]
    groups = [
        *by,
        month_key(F.col(date_col)).alias("myear"),
        month_label(F.col(date_col)).alias("myear_char"),
    ]
    checked = reduce(or_, (F.col(c).isNotNull() for c in _boxes(reason_dim, boxes)))
    shares = _with_counts(excluded.where(checked), groups, reason_dim, boxes=boxes, entity=id_cols)
    n, total = F.col("n").alias("n_this_exclusion"), F.col("n_entities").alias("n_all_exclusions")
    return shares.select(
        *names, "reason", n, total, percent(F.col("n"), F.col("n_entities")).alias("percent")
    ).orderBy(*by, "myear", "reason")


def reason_totals(
    excluded: DataFrame,
    reason_dim: ReasonDim,
    *,
    boxes: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Count per reason over all dates, with its type and the number of excluded rows."""
    n_rows = F.count("*").alias("n_patients_exc")
    return _with_counts(excluded, list(by), reason_dim, n_rows, boxes=boxes).select(
        *by, "reason_type", "reason", "n_patients_exc", F.col("n").alias("n_reason")
    )


def hierarchy_totals(
    df: DataFrame, levels: Sequence[str], weight: str, *, by: Sequence[str] = ()
) -> DataFrame:
    """Totals at every level of a hierarchy, with ``level`` 0 for the grand total.

    Upper levels have null in the columns below them. The levels are added up from
    the finest one, which is already aggregated, so each costs next to nothing.
    """
    levels = list(levels)
    finest = df.groupBy(*by, *levels).agg(F.sum(weight).alias(weight))
    sets = [[*by, *levels[:k]] for k in range(len(levels) + 1)]
    return (
        finest.groupingSets([[F.col(c) for c in s] for s in sets], *by, *levels)
        .agg(F.sum(weight).alias(weight), F.grouping_id().alias("_gid"))
        .withColumn("level", F.lit(len(levels)) - F.bit_count("_gid"))
        .drop("_gid")
        .select(*by, *levels, "level", weight)
    )


def reason_hierarchy(
    excluded: DataFrame,
    reason_dim: ReasonDim,
    *,
    boxes: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Reason counts per type and reason, with totals per type and overall."""
    totals = reason_totals(excluded, reason_dim, boxes=boxes, by=by)
    return hierarchy_totals(totals, ["reason_type", "reason"], "n_reason", by=by)


def coded_totals(
    events: DataFrame, code_col: str, reason_dim: DataFrame, *, by: Sequence[str] = ()
) -> DataFrame:
    """Events in long form by the reason of their code: ``reason_type``, ``reason``, ``n_reason``.

    ``reason_dim`` is a table of ``code``, ``reason`` and ``reason_type``. Events are counted
    per code first, so that the dimension meets one row per group and code. Codes that it
    lacks have a null reason, of the type for others.
    """
    counts = events.groupBy(*by, code_col).agg(F.count(F.lit(1)).alias("n"))
    found = with_dimension(counts, reason_dim, {code_col: "code"}, ["reason", "reason_type"])
    kind = F.coalesce("reason_type", F.lit(OTHER)).alias("reason_type")
    return found.groupBy(*by, kind, "reason").agg(F.sum("n").alias("n_reason"))
