"""Configuration of an intensive-care cohort with a year of follow-up.

All values below are fixed: labels, codes, dates and column names of the study's
record exports.
"""

from __future__ import annotations

import datetime as dt

from tallyward.operators.expected import Visit
from tallyward.operators.followup import Instruments, VisitWindow
from tallyward.plans.config import StudyConfig

# Code -> (label, type); a type of None falls under "Other exclusions".
REASONS = {
    1: ("Rapidly resolving organ failure", "Medical exclusions"),
    2: (">5 hospital days in last 30", "Medical exclusions"),
    3: ("Inability to live independently", "Patient characteristics"),
    4: ("Severe neurologic injury", "Medical exclusions"),
    5: ("BMI > 50", "Patient characteristics"),
    6: ("Substance abuse, etc", "Patient characteristics"),
    7: ("Blind, deaf, English", "Patient characteristics"),
    8: ("Death within 24h/hospice", "Medical exclusions"),
    9: ("Prisoner", None),
    10: ("Lives >150 miles from the hospital", "Geography"),
    11: ("Homeless", "Patient characteristics"),
    12: ("Study with no co-enrollment", None),
    13: ("Attending refusal", "Informed consent"),
    14: ("Patient/surrogate refusal", "Informed consent"),
    15: ("No surrogate within 72h", "Informed consent"),
    16: (">72h eligibility prior to screening", "Informed consent"),
    99: ("Other", None),
}

# The date a further instrument joined the surrogate battery.
BDI_SINCE = dt.date(2018, 6, 19)

SURROGATE = tuple(
    f"{stem}_comp_ph" for stem in ("gq", "pase", "adl", "ls", "emp", "audit", "iqcode", "bdi")
)
CAREGIVER = ("zarit_comp_ph", "memory_comp_ph")

# Positions of the nodes in the flow chart.
SOURCES = [
    "Enrolled", "Discharged", "Withdrew, hospital", "Died, hospital", "Assessed, 3m",
    "Not assessed, 3m", "Not yet eligible, 3m", "Withdrew, 3m", "Died, 3m",
]
TARGETS = [
    "Hospitalized", "Discharged", "Withdrew, hospital", "Died, hospital", "Assessed, 3m",
    "Not assessed, 3m", "Not yet eligible, 3m", "Withdrew, 3m", "Died, 3m", "Assessed, 12m",
    "Not assessed, 12m", "Not yet eligible, 12m", "Withdrew, 12m", "Died, 12m",
]

ICU_STUDY = StudyConfig(
    event_col="redcap_event_name",
    enrol_event="Enrollment /Trial Day 1",
    discharge_event="Discharge Day",
    terminal_rules=(
        ("hospdis_date", "Discharged alive"),
        ("death_date", "Died in hospital"),
        ("studywd_date", "Withdrew in hospital"),
    ),
    terminal_open="Still in hospital",
    day_rules=(
        ("death_date", "Deceased"),
        ("hospdis_date", "Discharged"),
        ("studywd_date", "Withdrawn"),
    ),
    day_default="In hospital",
    n_days=29,
    goal=312,
    reason_dim={f"exc_rsn_{code}": labels for code, labels in REASONS.items()},
    refusal_col="exc_rsn_14",
    record_endings={"_date": ("_dttm_date",), "_dt": ("_dttm",)},
    followup_endings={
        "_complete": ("_complete", "_complete_yn", "_completed", "_comp_ph"),
        "_date": ("_date", "_datecomp", "_date_compl", "_date_complete"),
    },
    schedule=(
        Visit(1, "Enrollment /Trial Day 1", "Day 1", ("In hospital",), or_transition=True),
        Visit(3, "Trial Day 3", "Day 3", ("In hospital",), or_transition=True),
        Visit(5, "Trial Day 5", "Day 5", ("In hospital",), or_transition=True),
        Visit(29, "Discharge Day", "Discharge", ("In hospital", "Discharged")),
    ),
    time_cols=tuple(f"study_day_specimen_{k}" for k in ("e", "3", "5", "dc")),
    time_cuts=("Enrollment/", " only"),
    measures={"blue_drawn": "blue", "purple_drawn": "purple"},
    not_expected=(("Day 3", "blue"), ("Day 5", "blue")),
    slot_cols=tuple(f"bed_remove_why_{k}" for k in range(1, 9)),
    permanent_reason="Permanent discontinuation",
    prep_label="Removed within a day of hospital discharge",
    removal_bins=(1, 8),
    battery_instruments={
        name: BDI_SINCE if name == "bdi_comp_ph" else None for name in (*SURROGATE, *CAREGIVER)
    },
    batteries={"surrogate": SURROGATE, "caregiver": CAREGIVER},
    battery_labels={
        "memory_comp_ph": "Mem/Behav",
        "gq_comp_ph": "General",
        "emp_comp_ph": "Employment",
        "zarit_comp_ph": "Zarit",
    },
    battery_ending="_comp_ph",
    windows={
        1: VisitWindow(30, 14, phone=True),
        2: VisitWindow(60, 14, phone=True),
        3: VisitWindow(83, 56, phone=False),
        6: VisitWindow(180, 30, phone=True),
        12: VisitWindow(335, 90, phone=False),
    },
    instruments=Instruments(
        phone=("ls", "ph_biadl"),
        full=(
            "gq", "biadl", "sppb", "hand", "rbans", "trails", "social", "eq5d", "pase", "emp",
            "hus", "bpi", "audit", "zarit", "membehav", "ls",
        ),
        undated=("pase",),
    ),
    instrument_labels={
        "ph_biadl": "ADL",
        "biadl": "ADL",
        "emp": "Emp.",
        "gq": "Gen.",
        "hand": "Hand.",
        "membehav": "M/B",
        "social": "Social",
        "trails": "Trails",
        "zarit": "Zarit",
    },
    refusal_reason_col="gq_rsn",
    refusal_reason="Patient refusal",
    no_consent_ids=tuple(f"PT-00{k}" for k in range(1, 8)),
    early_visit="3 Month Assessment",
    late_visit="12 Month Assessment",
    hospital_states={
        "Still in hospital": "Hospitalized",
        "Discharged alive": "Discharged",
        "Died in hospital": "Died, hospital",
        "Withdrew in hospital": "Withdrew, hospital",
    },
    source_rank={node: i for i, node in enumerate(SOURCES)},
    target_rank={node: i for i, node in enumerate(TARGETS)},
    one_source=(
        "Discharged", "Withdrew, hospital", "Died, hospital", "Hospitalized", "Assessed, 3m",
        "Not assessed, 3m", "Not yet eligible, 3m",
    ),
    one_target=("Withdrew, hospital", "Died, hospital", "Died, 3m", "Withdrew, 3m"),
)
