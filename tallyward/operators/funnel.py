"""Screening funnel by month, its key figures, and reports of undated entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import (
    date_text,
    month_key,
    month_label,
    percent,
    ratio,
    thousands,
)
from tallyward.operators.positions import text_pages

FLAGS = ("screened", "approached", "refused", "enrolled")
#: Flags that are also counted among the approached alone, for rates among them.
AMONG = ("refused", "enrolled")


def excluded_flags(df: DataFrame, date_col: str, refusal: Column) -> DataFrame:
    """Flags of screened-and-excluded rows: approached only if the reason is refusal."""
    return df.withColumns(
        {
            "funnel_date": F.col(date_col),
            "screened": F.lit(True),
            "approached": refusal,
            "refused": refusal,
            "enrolled": F.lit(False),
        }
    )


def enrolled_flags(df: DataFrame, date_col: str) -> DataFrame:
    """Flags of enrolled rows."""
    return df.withColumns(
        {
            "funnel_date": F.col(date_col),
            "screened": F.lit(True),
            "approached": F.lit(True),
            "refused": F.lit(False),
            "enrolled": F.lit(True),
        }
    )


def monthly_funnel(
    flagged: DataFrame, *, date_col: str = "funnel_date", by: Sequence[str] = ()
) -> DataFrame:
    """Sums of the four flags per month. One pass; only month sums are shuffled."""
    return (
        flagged.groupBy(
            *by,
            month_key(F.col(date_col)).alias("myear"),
            month_label(F.col(date_col)).alias("myear_char"),
        )
        .agg(
            *(F.sum(F.col(f).cast("long")).alias(f) for f in FLAGS),
            *(F.count_if(F.col(f) & F.col("approached")).alias(f"approached_{f}") for f in AMONG),
        )
        .orderBy(*by, "myear")
    )


def funnel_kpis(
    monthly: DataFrame, *, goal: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Key figures from the monthly sums: counts, shares and progress to the goal.

    The shares of refused and enrolled are those among the approached.
    """
    sums = monthly.groupBy(*by).agg(
        *(F.sum(f).alias(f"n_{f}") for f in FLAGS),
        *(F.sum(f"approached_{f}").alias(f"_{f}") for f in AMONG),
    )
    screened, approached = F.col("n_screened"), F.col("n_approached")
    n_goal = F.lit(goal).cast("long")
    return sums.select(
        *by,
        *(f"n_{f}" for f in FLAGS),
        ratio(approached, screened).alias("pct_approached"),
        (1 - ratio(approached, screened)).alias("pct_excluded"),
        ratio(F.col("_refused"), approached).alias("pct_refused"),
        ratio(F.col("_enrolled"), approached).alias("pct_enrolled"),
        n_goal.alias("n_goal"),
        percent(F.col("n_enrolled"), n_goal).alias("pct_of_goal"),
    )


def funnel_statement(
    kpis: DataFrame, *, as_of: dt.date | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """One sentence per row of key figures, and the date it is about."""

    def whole(name: str) -> Column:
        return F.rint(F.col(name) * 100).cast("long").cast("string")

    return kpis.select(
        *by,
        date_text(F.lit(as_of).cast("date")).alias("as_of_text"),
        F.concat(
            F.lit("We have screened "), thousands(F.col("n_screened")),
            F.lit(" patients; "), whole("pct_excluded"),
            F.lit("% were excluded and "), whole("pct_approached"),
            F.lit("% approached. Of those approached, "), whole("pct_refused"),
            F.lit("% refused consent and "), whole("pct_enrolled"),
            F.lit("% were enrolled."),
        ).alias("statement"),
    )


def screening_funnel(
    excluded: DataFrame,
    enrolled: DataFrame,
    *,
    refusal_col: str,
    excluded_date: str = "exc_date",
    enrolled_date: str = "enroll_date",
    undated: str = "keep",
    goal: int | None = None,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Monthly funnel and key figures of excluded plus enrolled entities.

    Undated exclusions never count. Undated enrolments stay, under the month key
    ``NA-NA``, unless ``undated="drop"``.
    """
    if undated not in ("keep", "drop"):
        raise ValueError("undated is 'keep' or 'drop'")
    exc = excluded.where(F.col(excluded_date).isNotNull())
    enr = enrolled if undated == "keep" else enrolled.where(F.col(enrolled_date).isNotNull())
    cols = [*by, "funnel_date", *FLAGS]
    flagged = (
        excluded_flags(exc, excluded_date, F.col(refusal_col).isNotNull())
        .select(*cols)
        .unionByName(enrolled_flags(enr, enrolled_date).select(*cols))
    )
    monthly = monthly_funnel(flagged, by=by)
    return monthly, funnel_kpis(monthly, goal=goal, by=by)


def undated_ids(
    sources: Sequence[tuple[DataFrame, str, str]], *, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct ids that lack the date placing them in a period, over several tables."""
    parts = [
        df.where(F.col(date_col).isNull()).select(*by, F.col(id_col).cast("string").alias("id"))
        for df, id_col, date_col in sources
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def id_lines(
    ids: DataFrame,
    *,
    by: Sequence[str] = (),
    id_col: str = "id",
    text_col: str = "ids",
    sep: str = "; ",
    per_line: int = 1000,
    empty: str | None = None,
) -> DataFrame:
    """Ids of a group as text in sorted order, with the count of ids and the line number.

    A line holds ``per_line`` ids, the last one of a group what is left; lines are cut by
    the place in the sorted group, whatever its size. No id is left out, repeated ids stay.
    Without ``by``, ``empty`` is the text of the one line given when there are no ids.
    """
    by = list(by)
    if by and empty is not None:
        raise ValueError("a text for 'no ids' needs a report without groups")
    lines = text_pages(ids, id_col, by=by, per_page=per_line, sep=sep).select(
        *by, F.col("page").alias("line"), "n_ids", F.col("ids").alias(text_col)
    )
    if empty is None:
        return lines
    # One row without group, the only one where there are no lines.
    none = lines.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0)
    zero = F.lit(0).cast("long").alias("n_ids")
    return lines.unionByName(
        none.select(F.lit(0).alias("line"), zero, F.lit(empty).alias(text_col))
    )


def undated_message(
    ids: DataFrame, *, by: Sequence[str] = (), per_line: int = 1000
) -> DataFrame:
    """Undated ids as text lines for a page. No ids, no message."""
    message = F.concat(
        F.lit("These IDs have no exclusion/enrollment date entered and are not included: "),
        F.col("ids"),
    )
    return id_lines(ids, by=by, per_line=per_line).withColumn("message", message)


def missing_date_report(
    sources: Sequence[tuple[DataFrame, str, str]], *, by: Sequence[str] = (), per_line: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """Undated ids of several tables: as rows, and as text lines."""
    ids = undated_ids(sources, by=by)
    return ids, undated_message(ids, by=by, per_line=per_line)
