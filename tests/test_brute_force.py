"""Operators against row-by-row Python on random small tables with nulls and copies."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyward.operators import device, expected, flow, followup, reasons, status
from tallyward.plans.warehouse import BEFORE_DISCHARGE, PERMANENT

DAY0 = dt.date(2020, 1, 1)
AS_OF = dt.date(2021, 1, 1)


def maybe(rng, value, share=0.5):
    return value if rng.random() < share else None


def day(rng, span):
    return DAY0 + dt.timedelta(rng.randrange(span))


@pytest.fixture(params=[1, 2, 3])
def rng(request):
    return random.Random(request.param)


def key(row):
    return tuple((v is None, str(v)) for v in row)


# -- Follow-up ---------------------------------------------------------------------

SET = followup.Instruments(phone=("ls", "ph"), full=("gq", "ls", "pase"), undated=("pase",))
WINDOWS = {
    1: followup.VisitWindow(30, 14, True),
    3: followup.VisitWindow(83, 56, False),
    12: followup.VisitWindow(335, 90, False),
}
VISITS = ["1 Month Phone Call", "3 Month Assessment", "12 Month Assessment", "Extra Phone Call"]
ENTITY = "id string, hospdis_date date, death_date date, studywd_date date, inhosp_status string"
RECORD = (
    "id string, event string, gq_rsn string, "
    + ", ".join(f"{s}_complete string" for s in SET.all)
    + ", "
    + ", ".join(f"{s}_date date" for s in SET.dated)
)


def entities_and_records(rng):
    people = []
    for i in range(60):
        dates = [maybe(rng, day(rng, 400), 0.7), maybe(rng, day(rng, 500), 0.3),
                 maybe(rng, day(rng, 500), 0.3)]
        labels = ("Discharged alive", "Died in hospital", "Withdrew in hospital")
        ended = next((n for n, x in zip(labels, dates, strict=True) if x), "Still in hospital")
        people.append((f"P{i % 55}", *dates, ended))  # some ids twice
    records = []
    for _ in range(150):
        records.append((
            maybe(rng, f"P{rng.randrange(70)}", 0.95),
            rng.choice([*VISITS, "Unlisted Phone Call", None]),
            rng.choice(["Patient refusal", "Other", None]),
            *(rng.choice(["Yes", "Yes, partially", "No", None, None]) for _ in SET.all),
            *(maybe(rng, day(rng, 800), 0.4) for _ in SET.dated),
        ))
    records += records[:20]
    return people, records


def judge(person, visit, record):
    """Status of one grid row with one record, or none."""
    pid, left, died, withdrew, ended = person
    flags = dict.fromkeys(SET.all)
    refused, seen = False, []
    if record is not None:
        texts = record[3:3 + len(SET.all)]
        flags = {s: None if t is None else t.startswith("Yes")
                 for s, t in zip(SET.all, texts, strict=True)}
        refused = record[2] == "Patient refusal"
        seen = [x for x in record[3 + len(SET.all):] if x]
    phone = "Phone Call" in visit
    head = visit.split(" ")[0]
    window = WINDOWS.get(int(head)) if head.isdigit() else None
    enter = leave = None
    if window and left:
        enter = left + dt.timedelta(window.enter_after)
        leave = enter + dt.timedelta(window.exit_after)
    n = sum(bool(flags[s]) for s in (SET.phone if phone else SET.full))
    if n > 0:
        out = followup.ASSESSED
    elif died and (ended == "Died in hospital" or (leave and died < leave)):
        out = followup.DIED
    elif withdrew and (ended == "Withdrew in hospital" or (leave and withdrew < leave)):
        out = followup.WITHDREW
    elif enter and AS_OF < enter:
        out = followup.NOT_YET
    elif ended == "Still in hospital":
        out = None
    elif phone and pid in ("P1", "P2"):
        out = followup.NO_CONSENT
    elif refused:
        out = followup.REFUSED
    else:
        out = followup.ELIGIBLE
    due = out in (followup.ASSESSED, followup.REFUSED, followup.ELIGIBLE)
    shown = [
        False if flags[s] is None and due and s in (SET.phone if phone else SET.full) else flags[s]
        for s in SET.all
    ]
    return (
        pid, visit, enter, leave, None if enter is None else enter <= AS_OF,
        n if phone else None, None if phone else n, min(seen, default=None),
        max(seen, default=None), out, due, (out == followup.ASSESSED) if due else None, *shown,
    )


def fold(records):
    """Records of one visit as one."""
    if not records:
        return None
    n = len(SET.all)
    texts = [next((t for t in ("Yes", "No") if any((r[3 + i] or "").startswith(t)
                                                    for r in records)), None) for i in range(n)]
    dates = [[x for x in r[3 + n:] if x] for r in records]
    flat = [x for xs in dates for x in xs]
    # first and last are all that is used of the dates
    ends = [min(flat, default=None), max(flat, default=None)]
    refused = "Patient refusal" if any(r[2] == "Patient refusal" for r in records) else None
    return (records[0][0], records[0][1], refused, *texts, *ends)


@pytest.mark.parametrize("merge", [False, True])
@pytest.mark.parametrize("listed", [True, False])
def test_followup_status(spark, rng, merge, listed):
    people, records = entities_and_records(rng)
    of_visit = defaultdict(list)
    for r in records:
        if r[0] is not None and r[1] is not None:
            of_visit[r[0], r[1]].append(r)
    names = VISITS if listed else sorted({r[1] for r in records if r[1]})
    want = []
    for p in people:
        for v in names:
            found = of_visit[p[0], v]
            if merge:
                found = [fold(found)]
            want += [judge(p, v, r) for r in (found or [None])]
    record_df = spark.createDataFrame(records, RECORD)
    got = followup.followup_status(
        spark.createDataFrame(people, ENTITY),
        followup.slim_records(record_df, SET, refusal=F.col("gq_rsn") == "Patient refusal"),
        SET, anchor_col="hospdis_date", window_dim=WINDOWS,
        visits=names if listed else record_df, as_of=AS_OF, merge=merge,
        no_consent_ids=["P1", "P2"],
    )
    cols = [
        "id", "event", "enter_window", "exit_window", "in_window", "n_asmts_phone",
        "n_asmts_full", "first_asmt", "last_asmt", "fu_status", "fu_elig", "fu_comp",
        *(f"{s}_complete" for s in SET.all),
    ]
    assert rows(got, *cols) == sorted(want, key=key)


# -- Visits ------------------------------------------------------------------------

RULES = [("death_date", "Deceased"), ("hospdis_date", "Discharged"), ("studywd_date", "Withdrawn")]
SCHEDULE = [
    expected.Visit(1, "D1", "Day 1", ("In hospital",), or_transition=True),
    expected.Visit(3, "D3", "Day 3", ("In hospital",), or_transition=True),
    expected.Visit(9, "DC", "Discharge", ("In hospital", "Discharged")),
]


def stays(rng):
    out = []
    for i in range(40):
        ends = [maybe(rng, DAY0 + dt.timedelta(rng.randrange(8)), 0.4) for _ in range(3)]
        out.append((f"P{i % 38}", rng.choice(["x", "y", None]), DAY0, *ends))
    return out


STAY = (
    "id string, site string, enroll_date date, death_date date, hospdis_date date, "
    "studywd_date date"
)


def state_on(date, died, left, withdrew):
    for when, label in ((died, "Deceased"), (left, "Discharged"), (withdrew, "Withdrawn")):
        if when and date >= when:
            return label, date in (died, left, withdrew)
    return "In hospital", date in (died, left, withdrew)


def test_timeline(spark, rng):
    people = stays(rng)
    want = [
        (pid, n, *state_on(start + dt.timedelta(n - 1), *ends))
        for pid, _, start, *ends in people
        for n in range(1, 8)
    ]
    got = status.daily_status_timeline(
        spark.createDataFrame(people, STAY), "enroll_date", range(1, 8), RULES, {1: "first"}
    )
    assert rows(got, "id", "study_day", "study_status", "transition_day") == sorted(want, key=key)
    assert rows(got.select("study_day", "event").distinct()) == [
        (1, "first"), *((k, f"Trial Day {k}") for k in range(2, 8)),
    ]


@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("as_of", [None, DAY0 + dt.timedelta(5)])
def test_compliance(spark, rng, dedupe, as_of):
    people = stays(rng)
    obs = [
        (f"P{rng.randrange(45)}", rng.choice(["D1", "D3", "DC", "other", None]),
         rng.choice([None, 0, 1, 3]), rng.choice([None, 0, 2]))
        for _ in range(120)
    ]
    n, k = Counter(), Counter()
    for pid, site, start, *ends in people:
        for v in SCHEDULE:
            date = start + dt.timedelta(v.day - 1)
            state, transition = state_on(date, *ends)
            if state not in v.states and not (v.or_transition and transition):
                continue
            if as_of and date > as_of:
                continue
            found = [o for o in obs if o[0] == pid and o[1] == v.event]
            for j, measure in enumerate(("blue", "purple")):
                values = [o[2 + j] for o in found] or [None]
                done = [bool(x and x > 0) for x in values]
                n[site, v.label, measure] += 1 if dedupe else len(done)
                k[site, v.label, measure] += any(done) if dedupe else sum(done)
    want = [
        (*cell, total, k[cell]) for cell, total in n.items() if cell[1:] != ("Day 3", "blue")
    ]
    got = expected.expected_vs_observed(
        spark.createDataFrame(people, STAY),
        spark.createDataFrame(obs, "id string, event string, b int, p int"),
        SCHEDULE, measures={"b": "blue", "p": "purple"}, rules=RULES, by=["site"],
        not_expected=[("Day 3", "blue")], dedupe=dedupe, as_of=as_of,
    )
    assert rows(got, "site", "day", "measure", "n_expected", "n_done") == sorted(want, key=key)


# -- Device, reasons, flow ---------------------------------------------------------


def test_removals(spark, rng):
    permanent = PERMANENT
    people = [(f"P{i % 18}", maybe(rng, day(rng, 6), 0.7)) for i in range(20)]
    days = [
        (maybe(rng, f"P{rng.randrange(22)}", 0.9), maybe(rng, day(rng, 6), 0.8),
         *(rng.choice([None, None, permanent, "Bathing"]) for _ in range(3)))
        for _ in range(200)
    ]
    found = set()
    for pid, end in people:
        for who, when, *why in days:
            for slot, reason in enumerate(why):
                if who == pid and reason:
                    prep = reason == permanent and end and when and (end - when).days in (0, 1)
                    label = BEFORE_DISCHARGE if prep else reason
                    found.add((pid, when, end, slot, reason, label))
    n = Counter(row[-1] for row in found)
    ids = {label: len({row[0] for row in found if row[-1] == label}) for label in n}
    events = device.removal_events(
        spark.createDataFrame(days, "id string, daily_date date, s0 string, s1 string, s2 string"),
        spark.createDataFrame(people, "id string, hospdis_date date"),
        ["s0", "s1", "s2"], permanent=permanent, prep_label=BEFORE_DISCHARGE,
    )
    got = device.removal_reasons(events)
    assert rows(got, "reason_mod", "n_events", "n_entities") == sorted(
        ((label, n[label], ids[label]) for label in n), key=key
    )
    totals = [r.n_events for r in got.collect()]
    assert totals == sorted(totals, reverse=True)


def test_reason_share(spark, rng):
    dim = {"r1": ("One", "A"), "r2": ("Two", "A"), "r3": ("One", "A"), "r4": (None, None)}
    data = [
        (maybe(rng, f"E{rng.randrange(25)}", 0.9), maybe(rng, day(rng, 90), 0.8),
         rng.choice(["x", None]), *(maybe(rng, "Checked", 0.3) for _ in dim))
        for _ in range(80)
    ]
    month = lambda x: x.strftime("%Y-%m") if x else "NA-NA"
    people, n = defaultdict(set), Counter()
    for eid, when, site, *boxes in data:
        for box, (label, _) in zip(boxes, dim.values(), strict=True):
            if box:
                people[site, month(when)].add(eid)
                n[site, month(when), label] += 1
    want = [(*cell, k, len(people[cell[:2]])) for cell, k in n.items()]
    got = reasons.reason_share(
        spark.createDataFrame(
            data, "exc_id string, exc_date date, site string, r1 string, r2 string, "
            "r3 string, r4 string"
        ),
        dim, by=["site"],
    )
    cols = ["site", "myear", "reason", "n_this_exclusion", "n_all_exclusions"]
    assert rows(got, *cols) == sorted(want, key=key)


def test_linked_states(spark, rng):
    data = [
        (f"P{rng.randrange(20)}", rng.choice([1, 2, 3]), rng.choice(["a", "b"]))
        for _ in range(120)
    ]
    want = Counter()
    for pid, stage, state in data:
        if stage == 2:
            sources = [s for p, k, s in data if p == pid and k == 1] or [None]
            want.update((source, state) for source in sources)
    stage, state = F.col("stage"), F.col("state")
    edges = flow.state_flow([
        flow.link_states(
            spark.createDataFrame(data, "id string, stage int, state string"), id_cols=["id"],
            first=(stage == 1, state), second=(stage == 2, state),
        )
    ])
    assert rows(edges, "source", "target", "weight") == sorted(
        ((*edge, n) for edge, n in want.items()), key=key
    )
