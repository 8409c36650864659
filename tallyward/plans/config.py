"""Description of one study: what its columns, labels and rules are."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from tallyward.operators.expected import Visit
from tallyward.operators.followup import Instruments, VisitWindow


@dataclass(frozen=True)
class StudyConfig:
    """Everything the wiring needs to know about a study.

    ``by`` are extra grouping columns that every input table carries, such as
    ``study_id``. They are part of the entity key.
    """

    # entities and events
    event_col: str
    enrol_event: str
    discharge_event: str
    terminal_rules: Sequence[tuple[str, str]]
    terminal_open: str
    day_rules: Sequence[tuple[str, str]]
    day_default: str
    n_days: int
    goal: int
    # exclusions
    reason_dim: Mapping[str, tuple[str | None, str | None]]
    refusal_col: str
    # names: the ways that endings of column names are spelt
    record_endings: Mapping[str, Sequence[str]]
    followup_endings: Mapping[str, Sequence[str]]
    # visits in hospital
    schedule: Sequence[Visit]
    time_cols: Sequence[str]
    time_cuts: Sequence[str]
    measures: Mapping[str, str]
    not_expected: Sequence[tuple[str, str]]
    # device
    slot_cols: Sequence[str]
    permanent_reason: str
    prep_label: str
    removal_bins: tuple[int, int]
    # batteries
    battery_instruments: Mapping[str, dt.date | None]
    batteries: Mapping[str, Sequence[str]]
    battery_labels: Mapping[str, str]
    battery_ending: str
    # follow-up
    windows: Mapping[int, VisitWindow]
    instruments: Instruments
    instrument_labels: Mapping[str, str]
    refusal_reason_col: str
    refusal_reason: str
    no_consent_ids: Sequence[str]
    visits: Sequence[str] | None = None
    merge_records: bool = False
    # flow
    early_visit: str = ""
    late_visit: str = ""
    hospital_states: Mapping[str, str] = field(default_factory=dict)
    source_rank: Mapping[str, int] = field(default_factory=dict)
    target_rank: Mapping[str, int] = field(default_factory=dict)
    one_source: Sequence[str] = ()
    one_target: Sequence[str] = ()
    # grouping
    by: Sequence[str] = ()

    @property
    def ids(self) -> list[str]:
        return [*self.by, "id"]

    @property
    def exc_ids(self) -> list[str]:
        return [*self.by, "exc_id"]
