"""The mini study against tables worked out by hand."""

from __future__ import annotations

import datetime as dt

import mini_study
import pytest
from conftest import d, rows
from pyspark.sql import functions as F

from tallyward.operators import checks
from tallyward.operators import followup as fup
from tallyward.plans.icu_study import ICU_STUDY
from tallyward.plans.study import run_study, study_products
from tallyward.sources import load_inputs, read_product

ONE, THREE, TWELVE = "1 Month Phone Call", "3 Month Assessment", "12 Month Assessment"


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    """All products, written and read back, as a job would leave them."""
    inputs = load_inputs(spark, mini_study.land(tmp_path_factory.mktemp("landed")))
    out = str(tmp_path_factory.mktemp("products"))
    names = run_study(spark, inputs, ICU_STUDY, mini_study.AS_OF, out)
    return {n: read_product(spark, f"{out}/{n}", mini_study.AS_OF) for n in names}


def test_funnel(study):
    monthly = study["screening_monthly"].drop("approached_refused", "approached_enrolled")
    assert rows(monthly) == [
        ("2018-03", "Mar 2018", 3, 2, 1, 1),
        ("2018-07", "Jul", 3, 2, 0, 2),
        ("2018-08", "Aug", 1, 1, 0, 1),
        ("2018-09", "Sep", 1, 1, 0, 1),
        ("2018-10", "Oct", 2, 2, 0, 2),
        ("2018-12", "Dec", 1, 1, 0, 1),
        ("2019-02", "Feb", 1, 1, 0, 1),
        ("NA-NA", None, 1, 1, 0, 1),
    ]
    kpi = study["screening_kpis"].first()
    assert (kpi.n_screened, kpi.n_enrolled, kpi.n_goal, kpi.pct_of_goal) == (13, 10, 312, 3.0)
    assert (kpi.pct_approached, kpi.pct_refused, kpi.pct_enrolled) == (11 / 13, 1 / 11, 10 / 11)
    assert study["screening_statement"].first().statement == (
        "We have screened 13 patients; 15% were excluded and 85% approached. "
        "Of those approached, 9% refused consent and 91% were enrolled."
    )


def test_input_checks(study):
    """Rows that break a rule, counted while the cleaned inputs are written."""
    found = {(r.source, r.rule): (r.n_broken, r.n_rows) for r in study["input_checks"].collect()}
    assert found["exc", "date"] == (1, study["exc"].count())
    assert {k: v[0] for k, v in found.items() if v[0]} == {("exc", "date"): 1}
    assert found["enrolled", "death_not_before_enrolment"][1] == study["enrolled"].count()


def test_strict_study_ends_at_a_broken_rule(spark, tmp_path):
    inputs = load_inputs(spark, mini_study.land(tmp_path / "landed"))
    with pytest.raises(ValueError, match="rows of exc break a rule .date: 1 of "):
        run_study(spark, inputs, ICU_STUDY, mini_study.AS_OF, str(tmp_path / "out"), strict=True)


def test_observed_counts_without_another_scan(spark):
    df = spark.createDataFrame([(1, True), (2, None), (None, False)], "n int, flag boolean")
    seen_rows, seen = checks.observed(df, {"n": F.col("n") > 1, "flag": F.col("flag")})
    assert seen_rows.count() == 3
    assert checks.broken_rules(seen) == [("n", 2, 3), ("flag", 2, 3)]
    with pytest.raises(ValueError, match="n: 2 of 3; flag: 2 of 3"):
        checks.assert_rules("t", seen)


def test_month_axis(study):
    axis = rows(study["screening_axis"], "myear", "myear_num", "show_label")
    assert [a[1] for a in axis] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [a[2] for a in axis] == [True, False] * 4


def test_undated(study):
    assert rows(study["undated_ids"]) == [("E4",), ("PT-025",)]
    message = study["undated_text"].first().message
    assert message.endswith("are not included: E4; PT-025")


def test_reasons(study):
    assert rows(study["reason_share"], "myear", "reason", "n_all_exclusions", "percent") == [
        ("2018-03", ">5 hospital days in last 30", 2, 50.0),
        ("2018-03", "Patient/surrogate refusal", 2, 50.0),
        ("2018-03", "Rapidly resolving organ failure", 2, 50.0),
        ("2018-07", "Prisoner", 1, 100.0),
        ("NA-NA", "Lives >150 miles from the hospital", 1, 100.0),
    ]
    types = study["reason_hierarchy"].where("level = 1")
    assert rows(types, "reason_type", "n_reason") == [
        ("Geography", 1),
        ("Informed consent", 1),
        ("Medical exclusions", 2),
        ("Other exclusions", 1),
    ]
    assert rows(study["reason_totals"].select("n_patients_exc").distinct()) == [(4,)]
    assert rows(study["reason_hierarchy"].where("level = 0"), "n_reason") == [(5,)]


def test_terminal_status(study):
    assert rows(study["status_counts"], "inhosp_status", "n_status") == [
        ("Died in hospital", 1),
        ("Discharged alive", 6),
        ("Still in hospital", 1),
        ("Withdrew in hospital", 1),
    ]
    assert study["still_in_text"].first().ids == "PT-024"


def test_timeline(study):
    timeline = study["timeline"]
    assert timeline.count() == 9 * 29
    assert rows(timeline.groupBy("study_status").count()) == [
        ("Deceased", 31), ("Discharged", 106), ("In hospital", 98), ("Withdrawn", 26),
    ]
    assert rows(timeline.where("study_day = 29").groupBy("study_status").count()) == [
        ("Deceased", 2), ("Discharged", 4), ("In hospital", 2), ("Withdrawn", 1),
    ]
    late_death = timeline.where("id = 'PT-023' and study_status = 'Deceased'")
    assert late_death.agg(F.min("study_day")).first()[0] == 25
    changes = timeline.where("id = 'PT-023' and transition_day")
    assert rows(changes, "study_day", "redcap_event_name") == [
        (10, "Trial Day 10"), (25, "Trial Day 25"),
    ]


def test_compliance(study):
    assert rows(study["visit_compliance"], "day", "measure", "n_done", "n_expected") == [
        ("Day 1", "blue", 1, 9),
        ("Day 1", "purple", 2, 9),
        ("Day 3", "purple", 0, 9),
        ("Day 5", "purple", 0, 7),
        ("Discharge", "blue", 1, 6),
        ("Discharge", "purple", 0, 6),
    ]


def test_device(study):
    kpi = study["device_kpis"].first()
    assert (kpi.n_hosp_days, kpi.n_accel_days, kpi.n_accel_rm) == (4, 3, 3)
    assert (kpi.pct_accel_worn, kpi.accel_worn_alert) == (75.0, "warn")
    assert rows(study["removal_reasons"], "reason_mod", "n_events", "n_entities") == [
        ("Bathing", 1, 1),
        ("Permanent discontinuation", 2, 2),
        ("Removed within a day of hospital discharge", 1, 1),
    ]
    permanent = study["permanent_removal_kpis"].first()
    assert (permanent.pct_accel_permrm, permanent.accel_permrm_alert) == (20.0, "warn")
    assert rows(study["removal_histogram"]) == [(1, 2), (2, 1), *((k, 0) for k in range(3, 9))]
    assert rows(study["device_days"], "id", "myear_char", "bed_device_num") == [
        ("PT-020", "Jul", 0), ("PT-020", "Jul", 2), ("PT-023", "Sep", 1), ("PT-024", "Feb", 1),
    ]


def test_batteries(study):
    assert rows(study["batteries"], "battery", "n_comp", "n_elig", "pct_comp", "alert") == [
        ("caregiver", 1, 9, 11.0, "warn"), ("surrogate", 2, 9, 22.0, "warn"),
    ]
    got = {r.asmt_type: r for r in study["battery_instruments"].collect()}
    assert {k: (r.n_comp, r.n_elig) for k, r in got.items() if k in
            ("General", "BDI", "Zarit", "Mem/Behav")} == {
        "General": (2, 9), "BDI": (1, 8), "Zarit": (2, 9), "Mem/Behav": (1, 9),
    }
    assert {r.comp_ok for r in got.values()} == {"Uh-oh"}
    assert got["Mem/Behav"].x_sorted == 10 and got["BDI"].htext == "BDI: 12%"
    assert sorted(r.x_sorted for r in got.values()) == list(range(1, 11))


def test_followup_status(study):
    status = {
        (r.id, r.redcap_event_name): r.fu_status for r in study["fu_status"].collect()
    }
    expected = {
        "PT-001": (fup.NO_CONSENT, fup.ASSESSED, fup.ELIGIBLE),
        "PT-020": (fup.ASSESSED, fup.ASSESSED, fup.NOT_YET),
        "PT-021": (fup.DIED,) * 3,
        "PT-022": (fup.WITHDREW,) * 3,
        "PT-023": (fup.DIED,) * 3,
        "PT-024": (None,) * 3,
        "PT-026": (fup.ELIGIBLE, fup.NOT_YET, fup.NOT_YET),
        "PT-027": (fup.ELIGIBLE, fup.REFUSED, fup.NOT_YET),
        "PT-028": (fup.ELIGIBLE, fup.ELIGIBLE, fup.NOT_YET),
    }
    assert status == {
        (pid, visit): s
        for pid, labels in expected.items()
        for visit, s in zip((ONE, THREE, TWELVE), labels, strict=True)
    }


def test_followup_dates_and_windows(study):
    row = study["fu_status"].where(f"id = 'PT-001' and redcap_event_name = '{THREE}'").first()
    assert (row.first_asmt, row.last_asmt) == (d("2018-06-15"), d("2018-06-20"))
    assert row.enter_window == d("2018-03-20") + dt.timedelta(83)
    assert row.exit_window == row.enter_window + dt.timedelta(56)
    assert row.in_window and row.n_asmts_full == 1 and row.n_asmts_phone is None
    assert row.any_full and not row.all_full
    still_in = study["fu_status"].where("id = 'PT-024'").first()
    assert still_in.in_window is None and still_in.fu_elig is False and still_in.fu_comp is None


def test_missing_flags_become_not_done_where_due(study):
    def flag(pid, visit, stem):
        where = f"id = '{pid}' and redcap_event_name = '{visit}'"
        return study["fu_status"].where(where).first()[f"{stem}_complete"]

    assert flag("PT-028", THREE, "gq") is False
    assert flag("PT-028", THREE, "ph_biadl") is None  # not asked at this kind of visit
    assert flag("PT-026", ONE, "ls") is False
    assert flag("PT-026", TWELVE, "gq") is None  # not yet due


def test_followup_summaries(study):
    assert rows(study["fu_totals"], "redcap_event_name", "n_elig", "n_comp", "alert") == [
        (ONE, 4, 1, "warn"), (TWELVE, 1, 0, "warn"), (THREE, 4, 2, "warn"),
    ]
    one = study["fu_instruments"].where(f"redcap_event_name = '{ONE}'")
    assert rows(one, "x_sorted", "asmt_type", "htext", "comp_ok") == [
        (1, "ADL", "ADL: 0%", "Uh-oh"), (2, "LS", "LS: 100%", "Excellent"),
    ]
    three = study["fu_instruments"].where(f"redcap_event_name = '{THREE}'")
    assert three.count() == 16
    assert three.where("x_sorted = 1").first().asmt_type == "Gen."
    assert study["fu_instruments"].where(f"redcap_event_name = '{TWELVE}'").count() == 0
    assert rows(study["fu_not_assessed_text"], "redcap_event_name", "ids") == [
        (ONE, "PT-026; PT-027; PT-028"), (TWELVE, "PT-001"), (THREE, "PT-028"),
    ]


EDGES = [
    ("Enrolled", "Hospitalized", 1),
    ("Enrolled", "Discharged", 6),
    ("Enrolled", "Withdrew, hospital", 1),
    ("Enrolled", "Died, hospital", 1),
    ("Discharged", "Assessed, 3m", 2),
    ("Discharged", "Not assessed, 3m", 2),
    ("Discharged", "Not yet eligible, 3m", 1),
    ("Discharged", "Died, 3m", 1),
    ("Withdrew, hospital", "Withdrew, 3m", 1),
    ("Died, hospital", "Died, 3m", 1),
    ("Assessed, 3m", "Not assessed, 12m", 1),
    ("Assessed, 3m", "Not yet eligible, 12m", 1),
    ("Not assessed, 3m", "Not yet eligible, 12m", 2),
    ("Not yet eligible, 3m", "Not yet eligible, 12m", 1),
    ("Withdrew, 3m", "Withdrew, 12m", 1),
    ("Died, 3m", "Died, 12m", 2),
]


def test_flow(study):
    edges = study["flow_edges"].select("source", "target", "weight").collect()
    assert [tuple(e) for e in edges] == EDGES  # also in chart order
    text = {(e.source, e.target): e.flow_text for e in study["flow_edges"].collect()}
    assert text["Enrolled", "Discharged"] == (
        "<b>Enrolled -> Discharged:</b><br>N = 6<br>67% of 9 enrolled"
    )
    assert text["Died, hospital", "Died, 3m"] == (
        "<b>Died, hospital -> Died, 3m:</b><br>N = 1<br>50% of 2 died, 3m"
    )
    assert text["Discharged", "Died, 3m"].endswith("17% of 6 discharged<br>50% of 2 died, 3m")


def test_flow_is_conserved(study):
    into, out_of = {}, {}
    for source, target, weight in EDGES:
        out_of[source] = out_of.get(source, 0) + weight
        into[target] = into.get(target, 0) + weight
    for node in set(into) & set(out_of):
        assert into[node] == out_of[node], node
    for e in study["flow_edges"].collect():
        assert e.source_total == out_of[e.source] and e.target_total == into[e.target]


def test_visits_are_those_of_the_own_study(spark, tmp_path):
    """Study B has no late visit yet, so it has no rows for it."""
    from dataclasses import replace

    paths = mini_study.land(tmp_path, studies=("A", "B"), without_late_visit=("B",))
    cfg = replace(ICU_STUDY, by=("study_id",), merge_records=True)
    products = study_products(load_inputs(spark, paths), cfg, mini_study.AS_OF)
    per_study = products["fu_status"].groupBy("study_id", "redcap_event_name").count()
    assert rows(per_study) == [
        ("A", ONE, 9), ("A", TWELVE, 9), ("A", THREE, 9), ("B", ONE, 9), ("B", THREE, 9),
    ]
    flow = products["flow_edges"].where("study_id = 'B'")
    assert flow.where("target like '%12m'").count() == 0
    assert flow.where("target like '%3m'").agg(F.sum("weight")).first()[0] == 8


def test_two_studies_in_one_run_equal_two_runs(spark, study, tmp_path_factory):
    paths = mini_study.land(tmp_path_factory.mktemp("two"), studies=("A", "B"))
    from dataclasses import replace

    both = study_products(
        load_inputs(spark, paths), replace(ICU_STUDY, by=("study_id",)), mini_study.AS_OF
    )
    skip = {"inhosp", "exc", "fu", "input_checks"}
    assert set(both) == set(study) - skip
    for name in sorted(set(both)):
        single = study[name]
        cols = single.columns
        expected = rows(single.select(*cols))
        for s in ("A", "B"):
            assert rows(both[name].where(F.col("study_id") == s).select(*cols)) == expected, name


def test_job(spark, tmp_path):
    from tallyward.__main__ import main

    paths = mini_study.land(tmp_path / "in")
    args = [a for name, path in paths.items() for a in (f"--{name}", path)]
    names = main([*args, "--as-of", "2019-03-01", "--out", str(tmp_path / "out")])
    edges = read_product(spark, f"{tmp_path}/out/flow_edges", mini_study.AS_OF)
    assert len(names) == len(set(names)) and edges.count() == len(EDGES)
