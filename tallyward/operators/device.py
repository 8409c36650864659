"""Wear of a monitoring device: days worn, removals and their reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import alert_above, alert_below, days_between, is_in, percent
from tallyward.operators.charts import unit_histogram
from tallyward.operators.joins import join_groups
from tallyward.operators.reshape import to_long


#: Slots that are kept as the bits of one number.
WORD = 63


def wear_kpis(
    days: DataFrame,
    *,
    day_col: str = "daily_date",
    worn: Column,
    removals_col: str = "bed_device_num",
    by: Sequence[str] = (),
) -> DataFrame:
    """Days in hospital, days worn and days with a removal, in one pass."""
    counts = days.groupBy(*by).agg(
        F.count(day_col).alias("n_hosp_days"),
        F.count_if(worn).alias("n_accel_days"),
        F.count_if(F.col(removals_col) > 0).alias("n_accel_rm"),
    )
    pct = percent(F.col("n_accel_days"), F.col("n_hosp_days"))
    return counts.withColumns({"pct_accel_worn": pct, "accel_worn_alert": alert_below(pct, 80)})


def removal_events(
    days: DataFrame,
    entities: DataFrame,
    slot_cols: Sequence[str],
    *,
    permanent: str,
    prep_label: str,
    id_cols: Sequence[str] = ("id",),
    day_col: str = "daily_date",
    end_col: str = "hospdis_date",
    prep_days: Sequence[int] = (0, 1),
    by: Sequence[str] = (),
) -> DataFrame:
    """Removals per entity and reason, after whole-row duplicates are left out.

    A removal is a filled slot of a day of an enrolled entity. A permanent one on
    the last days before the end date is relabelled, as it is preparation only. The
    slot is part of the row, so the same reason in two slots counts twice.

    Copies of a row fall together before the shuffle: per entity, reason and day the
    slots are kept as bits, and the bits are the distinct rows. What is left for the
    join is bounded by reasons and calendar days, however many rows an entity has. A
    number holds 63 slots; more of them make a row per 63 that are used.
    """
    ids = list(id_cols)
    bits = {c: str(i) for i, c in enumerate(slot_cols)}
    slots = to_long(days, [*ids, day_col], bits, "slot", "reason")
    one, slot = F.lit(1).cast("long"), F.col("slot").cast("int")
    word = [F.floor(slot / WORD).alias("_word")] if len(slot_cols) > WORD else []
    per_day = slots.groupBy(*ids, day_col, "reason", *word).agg(
        F.bit_or(F.call_function("shiftleft", one, slot % WORD)).alias("_slots")
    )
    enrolled = entities.select(*dict.fromkeys([*by, *ids, end_col])).distinct()
    until_end = days_between(F.col(end_col), F.col(day_col))
    prep = (F.col("reason") == permanent) & is_in(until_end, prep_days)
    return (
        per_day.join(enrolled, ids, "inner")
        .withColumn("reason_mod", F.when(prep, F.lit(prep_label)).otherwise(F.col("reason")))
        .groupBy(*dict.fromkeys([*by, *ids]), "reason_mod")
        .agg(F.sum(F.bit_count("_slots").cast("long")).alias("n_events"))
    )


def removal_reasons(events: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Removals per reason, most frequent first: rows, and entities they belong to.

    ``events`` is the result of ``removal_events`` for the same ``by``.
    """
    return (
        events.groupBy(*by, "reason_mod")
        .agg(F.sum("n_events").alias("n_events"), F.count("*").alias("n_entities"))
        .orderBy(*by, F.desc("n_events"), "reason_mod")
    )


def permanent_removal_kpis(
    reasons: DataFrame,
    enrolled: DataFrame,
    *,
    permanent: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Permanent removals as a percent of the enrolled, with its alert level.

    ``enrolled`` holds ``n_enrolled`` per group. Groups without any removal have 0.
    """
    by = list(by)
    n = reasons.where(F.col("reason_mod") == permanent)
    removed = n.groupBy(*by).agg(F.sum("n_events").alias("_n"))
    base = enrolled.select(*by, "n_enrolled")
    if by:
        joined = join_groups(base, removed, by, "left")
    else:
        joined = base.withColumn("_n", removed.select("_n").scalar())
    pct = percent(F.col("n_accel_permrm"), F.col("n_enrolled"))
    return joined.select(
        *by, "n_enrolled", F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_accel_permrm")
    ).withColumns({"pct_accel_permrm": pct, "accel_permrm_alert": alert_above(pct, 20, 15)})


def removal_histogram(
    days: DataFrame,
    *,
    day_col: str = "daily_date",
    removals_col: str = "bed_device_num",
    bins: tuple[int, int] = (1, 8),
    by: Sequence[str] = (),
) -> DataFrame:
    """How many times a day the device was removed, over dated days with a removal."""
    dated = days.where(F.col(day_col).isNotNull() & (F.col(removals_col) > 0))
    return unit_histogram(dated, removals_col, bins=bins, by=by)


def device_wear(
    days: DataFrame,
    entities: DataFrame,
    slot_cols: Sequence[str],
    *,
    worn: Column,
    permanent: str,
    prep_label: str,
    id_cols: Sequence[str] = ("id",),
    day_col: str = "daily_date",
    end_col: str = "hospdis_date",
    removals_col: str = "bed_device_num",
    prep_days: Sequence[int] = (0, 1),
    bins: tuple[int, int] = (1, 8),
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Key figures, removal reasons and removal histogram of one device."""
    events = removal_events(
        days, entities, slot_cols, permanent=permanent, prep_label=prep_label,
        id_cols=id_cols, day_col=day_col, end_col=end_col, prep_days=prep_days, by=by,
    )
    return (
        wear_kpis(days, day_col=day_col, worn=worn, removals_col=removals_col, by=by),
        removal_reasons(events, by=by),
        removal_histogram(days, day_col=day_col, removals_col=removals_col, bins=bins, by=by),
    )
