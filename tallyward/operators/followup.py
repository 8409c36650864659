"""Follow-up visits: windows, status of each entity at each visit, completion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import (
    alert_below,
    first_match,
    is_in,
    is_true,
    leading_integer,
    percent_text,
    ratio,
    recode,
    remove_first,
    round_half_even,
)
from tallyward.operators.charts import with_chart_order, with_completion_text
from tallyward.operators.joins import join_groups
from tallyward.operators.reshape import sums_to_long

ASSESSED = "Assessment fully or partially completed"
DIED = "Died before follow-up window ended"
WITHDREW = "Withdrew before follow-up window ended"
NOT_YET = "Not yet eligible for follow-up"
NO_CONSENT = "Consent did not include phone assessment"
REFUSED = "Refused assessment (but did not withdraw)"
ELIGIBLE = "Eligible, but not yet assessed"
STATUSES = (ASSESSED, DIED, WITHDREW, NOT_YET, NO_CONSENT, REFUSED, ELIGIBLE)


#: Flags that are kept as the bits of one number.
WORD = 63


@dataclass(frozen=True)
class VisitWindow:
    """Days from the anchor date to the window, and from there to its end."""

    enter_after: int
    exit_after: int
    phone: bool


@dataclass(frozen=True)
class Instruments:
    """Instrument stems by kind of visit, and those that carry no date."""

    phone: tuple[str, ...]
    full: tuple[str, ...]
    undated: tuple[str, ...] = ()

    @property
    def all(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.phone, *self.full]))

    @property
    def words(self) -> list[tuple[str, slice]]:
        """Parts of ``all`` whose flags are the bits of one number, each with a suffix."""
        n = -(-len(self.all) // WORD)
        return [(f"_{k}" if n > 1 else "", slice(k * WORD, (k + 1) * WORD)) for k in range(n)]

    @property
    def dated(self) -> tuple[str, ...]:
        return tuple(s for s in self.all if s not in self.undated)


Windows = Mapping[int, VisitWindow] | DataFrame
"""Month of a visit -> its window, or a table of the visits of each group: the ``by`` columns,
the visit, ``fu_month``, ``phone_only``, ``enter_after`` and ``exit_after``."""


def flag_col(stem: str) -> str:
    """Name of an instrument's completion flag."""
    return f"{stem}_complete"


def _visit(
    name: Column, window_dim: Mapping[int, VisitWindow], visit_col: str, phone_marker: str
) -> Column:
    """A visit as a struct: name, month, kind, and days to and in its window.

    A visit whose name does not start with a listed month has no window.
    """
    month = leading_integer(name)
    enter = first_match([(month == m, w.enter_after) for m, w in window_dim.items()])
    stay = first_match([(month == m, w.exit_after) for m, w in window_dim.items()])
    return F.struct(
        name.alias(visit_col),
        month.alias("fu_month"),
        name.contains(phone_marker).alias("phone_only"),
        enter.alias("enter_after"),
        stay.alias("exit_after"),
    )


def _with_visits(
    entities: DataFrame,
    visits: Sequence[str] | DataFrame | None,
    window_dim: Windows,
    visit_col: str,
    phone_marker: str,
    by: Sequence[str],
) -> DataFrame:
    """Entities with the array ``_visits`` of the visits each of them has.

    Names taken from a record table are those of the entity's group. They are a short
    list: one row per group, or a scalar. Listed names are constants of the plan. A table
    of windows holds the visits itself.
    """
    if isinstance(window_dim, DataFrame):
        if visits is not None:
            raise ValueError("a table of windows says itself which visits there are")
        own = F.struct(visit_col, "fu_month", "phone_only", "enter_after", "exit_after")
        named = window_dim.groupBy(*by).agg(F.collect_list(own).alias("_visits"))
        if by:
            return join_groups(entities, named, by, "inner")
        return entities.withColumn("_visits", named.scalar())
    if visits is None:
        raise ValueError("windows by month need the names of the visits")
    if not isinstance(visits, DataFrame):
        listed = (_visit(F.lit(v), window_dim, visit_col, phone_marker) for v in visits)
        return entities.withColumn("_visits", F.array(*listed))
    named = visits.where(F.col(visit_col).isNotNull()).select(*by, visit_col).distinct()
    described = _visit(F.col(visit_col), window_dim, visit_col, phone_marker)
    names = named.groupBy(*by).agg(F.collect_set(described).alias("_visits"))
    if by:
        return join_groups(entities, names, by, "inner")
    return entities.withColumn("_visits", names.scalar())


def _with_windows(rows: DataFrame, anchor_col: str) -> DataFrame:
    """Window of a row's visit, counted from the anchor date."""
    return (
        rows.withColumn("enter_window", F.date_add(anchor_col, F.col("enter_after")))
        .withColumn("exit_window", F.date_add("enter_window", F.col("exit_after")))
        .drop("enter_after", "exit_after")
    )


def followup_windows(
    entities: DataFrame,
    anchor_col: str,
    window_dim: Windows,
    visits: Sequence[str] | DataFrame | None = None,
    *,
    visit_col: str = "event",
    phone_marker: str = "Phone Call",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per entity and visit, with the visit's window for this entity.

    ``visits`` is a list of visit names, or a record table whose distinct visit
    names are taken, per group if there are groups. With a table of windows there is no
    ``visits``: each group has those of the table, so that studies with other visits run
    in one job, and entities of a group without any have no row. Every entity row lays
    out its list: no cross join.
    """
    base = _with_visits(entities, visits, window_dim, visit_col, phone_marker, by)
    return _with_windows(base.select(*entities.columns, F.inline("_visits")), anchor_col)


def slim_records(
    records: DataFrame,
    instruments: Instruments,
    *,
    id_cols: Sequence[str] = ("id",),
    visit_col: str = "event",
    done_prefix: str = "Yes",
    refusal: Column | None = None,
) -> DataFrame:
    """What the status needs of a record: flags, refusal, first and last date.

    A text flag is true if it starts with ``done_prefix`` and null if missing. The
    flags travel as the bits of two numbers, done and known (two for each 63 flags). First and last date are
    taken across the columns of the row: no reshape, no shuffle.
    """
    types = dict(records.dtypes)
    flags = [
        F.col(flag_col(s))
        if types[flag_col(s)] == "boolean"
        else F.col(flag_col(s)).startswith(done_prefix)
        for s in instruments.all
    ]
    dates = [F.col(f"{s}_date") for s in instruments.dated if f"{s}_date" in types]
    no_date = F.lit(None).cast("date")
    first, last = (
        fn(*dates) if len(dates) > 1 else (dates or [no_date])[0]
        for fn in (F.least, F.greatest)
    )
    refused = F.lit(False) if refusal is None else is_true(refusal)
    return records.select(
        *id_cols,
        visit_col,
        *(
            column
            for word, at in instruments.words
            for column in (
                _bits(flags[at]).alias(f"done{word}"),
                _bits(c.isNotNull() for c in flags[at]).alias(f"known{word}"),
            )
        ),
        refused.alias("refused"),
        first.alias("first_asmt"),
        last.alias("last_asmt"),
    )


def _flag_words(instruments: Instruments) -> list[str]:
    """The columns of a record that hold its flags."""
    return [f"{name}{word}" for word, _ in instruments.words for name in ("done", "known")]


def _folds(instruments: Instruments) -> dict[str, Callable[[Column], Column]]:
    """How several records of one visit become one."""
    flags = dict.fromkeys(_flag_words(instruments), F.bit_or)
    return {**flags, "refused": F.bool_or, "first_asmt": F.min, "last_asmt": F.max}


#: The number of records that agree in all that the status asks of them.
N_RECORDS = "n_records"


def _bits(flags: Iterable[Column]) -> Column:
    """Flags of a row as the bits of a long."""
    zero = F.lit(0).cast("long")
    return sum(
        (F.when(c, F.lit(1 << i).cast("long")).otherwise(zero) for i, c in enumerate(flags)),
        start=zero,
    )


def _mask(stems: Collection[str], of_word: Sequence[str]) -> Column:
    """The bits of some of the instruments of a word."""
    return F.lit(sum(1 << i for i, s in enumerate(of_word) if s in stems)).cast("long")


def _each_record(
    base: DataFrame, slim: DataFrame, ids: Sequence[str], visit_col: str, folds: Sequence[str]
) -> DataFrame:
    """Entity, visit and record: a row per record, and one per visit without any.

    The left join of an entity-by-visit grid to the records, without the grid. The
    records are joined to the entity itself, by an inner join: unlike in a left join,
    Spark can split the hot partitions of either side. The visits without a record
    come from the set of visits seen, which is combined before it is shuffled.
    """
    kept = [c for c in base.columns if c != "_visits"]
    own = F.filter("_visits", lambda v: v[visit_col] == F.col("_visit"))
    matched = base.join(slim.withColumnRenamed(visit_col, "_visit"), list(ids), "inner").select(
        *kept, *folds, F.inline(own)
    )
    seen = slim.groupBy(*ids).agg(F.collect_set(visit_col).alias("_seen"))
    unseen = F.filter(
        "_visits", lambda v: ~is_true(F.array_contains("_seen", v[visit_col]))
    )
    missing = base.join(seen, list(ids), "left").select(
        *kept,
        *(F.lit(None).cast(slim.schema[c].dataType).alias(c) for c in folds),
        F.inline(unseen),
    )
    return matched.unionByName(missing)


def _counted_records(
    base: DataFrame, slim: DataFrame, ids: Sequence[str], visit_col: str, asked: Sequence[str]
) -> DataFrame:
    """Entity, visit and distinct record, with the number of records that are alike.

    Records are counted by what the status asks of them, so a hot entity leaves each map
    task as a few rows. Those of an entity become one array, which the join meets once;
    whether a visit has records is read from the array when the visits are laid out.
    """
    counted = slim.groupBy(*ids, visit_col, *asked).agg(F.count(F.lit(1)).alias(N_RECORDS))
    own = F.struct(F.col(visit_col).alias("_visit"), *asked, N_RECORDS)
    per_entity = counted.groupBy(*ids).agg(F.collect_list(own).alias("_records"))
    kept = [c for c in base.columns if c != "_visits"]
    # An outer generator: no filter on the visits, which would have them read again.
    grid = base.join(per_entity, list(ids), "left").select(
        *kept, "_records", F.inline_outer("_visits")
    )
    grid = grid.where(F.col(visit_col).isNotNull())
    of_visit = F.filter("_records", lambda r: r["_visit"] == F.col(visit_col))
    rows = grid.select(*(c for c in grid.columns if c != "_records"), F.inline_outer(of_visit))
    return rows.drop("_visit").withColumn(
        N_RECORDS, F.coalesce(N_RECORDS, F.lit(1).cast("long"))
    )


def _merged_records(
    base: DataFrame,
    slim: DataFrame,
    ids: Sequence[str],
    visits: Sequence[str],
    visit_col: str,
    folds: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """Entity, visit and all its records as one: a row per entity and visit.

    The records of an entity are folded into a few numbers per visit before they are
    shuffled, so that the join meets one row per entity on either side; the visits
    are laid out after it.
    """
    per_entity = (
        slim.where(F.col(visit_col).isin(list(visits)))
        .groupBy(*ids)
        .agg(
            *(
                fold(F.when(F.col(visit_col) == v, F.col(c))).alias(f"{c}_{i}")
                for i, v in enumerate(visits)
                for c, fold in folds.items()
            )
        )
    )
    meta = base.schema["_visits"].dataType.elementType.names
    rows = F.array(
        *(
            F.struct(
                *(F.col("_visits")[i][m].alias(m) for m in meta),
                *(F.col(f"{c}_{i}").alias(c) for c in folds),
            )
            for i in range(len(visits))
        )
    )
    kept = [c for c in base.columns if c != "_visits"]
    return base.join(per_entity, list(ids), "left").select(*kept, F.inline(rows))


def followup_status(
    entities: DataFrame,
    records: DataFrame,
    instruments: Instruments,
    *,
    anchor_col: str,
    window_dim: Windows,
    visits: Sequence[str] | DataFrame | None = None,
    as_of: dt.date,
    no_consent_ids: Collection | DataFrame = (),
    merge: bool = False,
    counted: bool = False,
    id_cols: Sequence[str] = ("id",),
    visit_col: str = "event",
    phone_marker: str = "Phone Call",
    death_col: str = "death_date",
    withdrawal_col: str = "studywd_date",
    status_col: str = "inhosp_status",
    died_label: str = "Died in hospital",
    withdrew_label: str = "Withdrew in hospital",
    open_label: str = "Still in hospital",
    by: Sequence[str] = (),
) -> DataFrame:
    """Status of each entity at each visit, and whether it counts as due and as done.

    The rows are those of ``followup_windows``, with the records of ``slim_records``.
    Several records of one visit give several rows, or one with ``merge``, or with
    ``counted`` one per kind of record: those that agree in all flags and the refusal
    share a row, without dates, and ``n_records`` is their number (1 where a visit has
    no record). The summaries of this module weigh rows by it. ``visits``
    is a list of names or a record table, as for ``followup_windows``. ``no_consent_ids``
    is a table with the id columns, or a short list of values of the last of them.
    """
    if merge and counted:
        raise ValueError("records of a visit are either merged or counted")
    ids = list(id_cols)
    refuses = F.lit(False)
    if isinstance(no_consent_ids, DataFrame):
        marked = no_consent_ids.select(*ids).distinct().withColumn("_no_consent", F.lit(True))
        entities, refuses = entities.join(marked, ids, "left"), is_true(F.col("_no_consent"))
    elif no_consent_ids:
        refuses = is_in(F.col(ids[-1]), no_consent_ids)
    base = _with_visits(entities, visits, window_dim, visit_col, phone_marker, by)
    folds = _folds(instruments)
    if counted:
        asked = [*_flag_words(instruments), "refused"]
        rows = _counted_records(base, records, ids, visit_col, asked)
    elif merge and visits is not None and not isinstance(visits, DataFrame):
        rows = _merged_records(base, records, ids, visits, visit_col, folds)
    else:
        if merge:
            records = records.groupBy(*ids, visit_col).agg(
                *(fold(c).alias(c) for c, fold in folds.items())
            )
        rows = _each_record(base, records, ids, visit_col, list(folds))
    rows = _with_windows(rows, anchor_col)
    phone, today = F.col("phone_only"), F.lit(as_of)
    rows = rows.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in _flag_words(instruments)}
    )

    def n_done(stems: Collection[str]) -> Column:
        counts = [
            F.bit_count(F.col(f"done{word}").bitwiseAND(_mask(stems, instruments.all[at])))
            for word, at in instruments.words
        ]
        return sum(counts[1:], start=counts[0])

    n_phone = F.when(phone, n_done(instruments.phone))
    n_full = F.when(~phone, n_done(instruments.full))
    rows = rows.withColumns(
        {
            "refused": is_true(F.col("refused")),
            "in_window": F.col("enter_window") <= today,
            "n_asmts_phone": n_phone,
            "n_asmts_full": n_full,
            "any_phone": n_phone > 0,
            "any_full": n_full > 0,
            "all_phone": n_phone == len(instruments.phone),
            "all_full": n_full == len(instruments.full),
        }
    )
    death, withdrawal, status = F.col(death_col), F.col(withdrawal_col), F.col(status_col)
    exit_window = F.col("exit_window")
    rules = [
        ((phone & F.col("any_phone")) | (~phone & F.col("any_full")), ASSESSED),
        (death.isNotNull() & ((status == died_label) | (death < exit_window)), DIED),
        (
            withdrawal.isNotNull() & ((status == withdrew_label) | (withdrawal < exit_window)),
            WITHDREW,
        ),
        (today < F.col("enter_window"), NOT_YET),
        (status == open_label, None),
        (phone & refuses, NO_CONSENT),
        (F.col("refused"), REFUSED),
    ]
    rows = rows.withColumn("fu_status", first_match(rules, ELIGIBLE))
    fu_status = F.col("fu_status")
    due = is_in(fu_status, (ASSESSED, REFUSED, ELIGIBLE))
    rows = rows.withColumns(
        {
            "fu_status_ord": recode(fu_status, {s: i for i, s in enumerate(STATUSES, 1)}),
            "fu_elig": due,
            "fu_comp": F.when(due, fu_status == ASSESSED),
        }
    )
    # Where a visit is due, what it asks for is known: missing is not done.
    due = {}
    for word, at in instruments.words:
        own = instruments.all[at]
        asked = F.when(F.col("fu_elig") & phone, _mask(instruments.phone, own)).when(
            F.col("fu_elig") & ~phone, _mask(instruments.full, own)
        )
        due[f"known{word}"] = F.col(f"known{word}").bitwiseOR(F.coalesce(asked, F.lit(0)))
    flags = {
        flag_col(s): _flag(word, i)
        for word, at in instruments.words
        for i, s in enumerate(instruments.all[at])
    }
    rows = rows.withColumns(due).withColumns(flags)
    return rows.drop(*_flag_words(instruments), "_no_consent")


def _flag(word: str, i: int) -> Column:
    """A flag out of its bits."""
    bit = F.lit(1 << i).cast("long")
    known, done = (F.col(f"{name}{word}").bitwiseAND(bit) != 0 for name in ("known", "done"))
    return F.when(known, done)


def _n_rows(status: DataFrame, when: Column | str | None = None) -> Column:
    """Number of records, all or those that meet a condition, whichever way they are kept."""
    one = F.col(N_RECORDS) if N_RECORDS in status.columns else F.lit(1).cast("long")
    if when is None:
        return F.sum(one)
    when = F.col(when) if isinstance(when, str) else when
    return F.coalesce(F.sum(F.when(when, one)), F.lit(0).cast("long"))


def followup_counts(
    status: DataFrame, *, visit_col: str = "event", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per visit and status."""
    return status.groupBy(*by, visit_col, "fu_status", "fu_status_ord").agg(
        _n_rows(status).alias("n")
    )


def followup_totals(
    status: DataFrame,
    *,
    visit_col: str = "event",
    warn_below: float = 0.9,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per visit: entities due, entities done, their share, and its alert level.

    The alert looks at the share rounded to two places, as it is shown.
    """
    # Counting by condition: a filter would have the status worked out twice.
    totals = (
        status.groupBy(*by, visit_col)
        .agg(
            _n_rows(status, "fu_elig").alias("n_elig"), _n_rows(status, "fu_comp").alias("n_comp")
        )
        .where(F.col("n_elig") > 0)
        .withColumn("prop_comp", ratio(F.col("n_comp"), F.col("n_elig")))
    )
    rounded = round_half_even(F.col("prop_comp"), 2)
    return totals.withColumns(
        {
            "prop_rounded": rounded,
            "value_text": percent_text(rounded),
            "alert": alert_below(rounded, warn_below),
        }
    )


def followup_instruments(
    status: DataFrame,
    instruments: Instruments,
    window_dim: Windows,
    *,
    visit_col: str = "event",
    labels: Mapping[str, str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per visit and instrument: done among completed visits.

    Only instruments of the visit's kind, and only visits with a window. Flags are
    counted per visit first; the counts then go long.
    """
    keys = [*by, visit_col, "fu_month", "phone_only"]
    comp = F.col("fu_comp")
    counts = (
        status.groupBy(*keys)
        .agg(
            _n_rows(status, comp).alias("n_elig"),
            *(
                _n_rows(status, comp & F.col(flag_col(s))).alias(flag_col(s))
                for s in instruments.all
            ),
        )
        .where(F.col("n_elig") > 0)
    )
    long = sums_to_long(
        counts,
        keys,
        {s: ("n_elig", flag_col(s)) for s in instruments.all},
        "instrument",
        ("n_elig", "n_comp"),
    )
    if isinstance(window_dim, DataFrame):
        phone, full = F.col("phone_only"), ~F.col("phone_only")
    else:
        phone, full = (
            is_in(F.col("fu_month"), [m for m, w in window_dim.items() if w.phone == kind])
            for kind in (True, False)
        )
    fits = (phone & is_in(F.col("instrument"), instruments.phone)) | (
        full & is_in(F.col("instrument"), instruments.full)
    )
    stem = F.upper(remove_first(F.col("instrument"), "_complete$"))
    out = long.where(fits).select(
        "*",
        recode(F.col("instrument"), labels or {}, stem).alias("asmt_type"),
        ratio(F.col("n_comp"), F.col("n_elig")).alias("prop_comp"),
    )
    out = with_completion_text(out, "asmt_type").withColumn(
        "htext",
        F.concat(
            F.col("asmt_type"), F.lit(": "),
            percent_text(round_half_even(F.col("prop_comp"), 2)),
        ),
    )
    # Full visits are ordered by share, phone visits by label: their share is left out.
    share = F.when(full, F.col("prop_comp"))
    return with_chart_order(
        out.withColumn("_share", share), [*by, visit_col], "asmt_type", "_share"
    ).drop("_share", "phone_only")


def not_yet_assessed(
    status: DataFrame, *, id_cols: Sequence[str] = ("id",), visit_col: str = "event",
    by: Sequence[str] = (),
) -> DataFrame:
    """Entities due at a visit but not yet assessed, with their windows."""
    return status.where(F.col("fu_status") == ELIGIBLE).select(
        *dict.fromkeys([*by, *id_cols]), visit_col, "enter_window", "exit_window"
    )
