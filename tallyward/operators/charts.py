"""Tables behind charts: month axes, histograms and figures with their bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions import as_text, percent_text, threshold_band

COMPLETION_CUTS = ((">", 0.90, "Excellent"), (">", 0.80, "Okay"))
COMPLETION_REST = "Uh-oh"


def with_month_axis(df: DataFrame, *, month: str = "myear", by: Sequence[str] = ()) -> DataFrame:
    """Month number 1..n, and whether its label is shown (every second one).

    For tables of one row per month, or per month and category.
    """
    order = Window.partitionBy(*by).orderBy(month)
    return df.withColumn("myear_num", F.dense_rank().over(order)).withColumn(
        "show_label", F.col("myear_num") % 2 == 1
    )


def completion_band(share: Column) -> Column:
    """Band of an unrounded share of completed units."""
    return threshold_band(share, COMPLETION_CUTS, COMPLETION_REST)


def with_completion_text(df: DataFrame, label: str, share: str = "prop_comp") -> DataFrame:
    """Chart text such as ``ADL: 98%``, and the band of the unrounded share."""
    return df.withColumns(
        {
            "htext": F.concat(F.col(label), F.lit(": "), percent_text(F.col(share))),
            "comp_ok": completion_band(F.col(share)),
        }
    )


def with_count_texts(df: DataFrame, label: str, counts: Mapping[str, str]) -> DataFrame:
    """A text per count column, such as ``Mar 2018, Screened: 12``; ``counts`` names them."""
    return df.withColumns(
        {
            f"{column}_text": F.concat(
                as_text(F.col(label)), F.lit(f", {name}: "), as_text(F.col(column))
            )
            for column, name in counts.items()
        }
    )


def with_share_text(
    df: DataFrame, label: str, category: str, whole_percent: str, out: str = "share_text"
) -> DataFrame:
    """Text of a point of a line, such as ``Mar 2018, Prisoner: 12%``."""
    value = as_text(F.col(whole_percent).cast("long"))
    return df.withColumn(
        out,
        F.concat(as_text(F.col(label)), F.lit(", "), F.col(category), F.lit(": "), value, F.lit("%")),
    )


def with_box_text(df: DataFrame, whole_percent: str, out: str = "value_text") -> DataFrame:
    """Text of a figure box, such as ``12%``."""
    return df.withColumn(out, F.concat(as_text(F.col(whole_percent).cast("long")), F.lit("%")))


def with_chart_order(
    df: DataFrame, within: Sequence[str], label: str, share: str = "prop_comp"
) -> DataFrame:
    """Position of each category by falling share; ties, and no share, go by label."""
    order = Window.partitionBy(*within).orderBy(F.desc(share), F.asc(label))
    return df.withColumn("x_sorted", F.row_number().over(order))


def unit_histogram(
    df: DataFrame, value: str, *, bins: tuple[int, int], by: Sequence[str] = ()
) -> DataFrame:
    """Counts in bins of width 1 centred on the integers, empty bins included.

    Bins from ``bins[0]`` to ``bins[1]`` are always there; values beyond them keep
    their own bins. Empty bins are added as zero counts, so no join is needed.
    """
    by = list(by)
    binned = df.where(F.col(value).isNotNull()).groupBy(
        *by, F.ceil(F.col(value) - 0.5).cast("long").alias("bin")
    )
    counts = binned.agg(F.count("*").alias("n"))
    axis = F.sequence(F.lit(bins[0]).cast("long"), F.lit(bins[1]).cast("long"))
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1)
    empty = groups.select(*by, F.explode(axis).alias("bin"), F.lit(0).cast("long").alias("n"))
    return (
        counts.unionByName(empty)
        .groupBy(*by, "bin")
        .agg(F.sum("n").alias("n"))
        .orderBy(*by, "bin")
    )
