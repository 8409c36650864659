"""From the three record tables of a study to all of its derived tables.

``study_products`` is lazy, but for the sorted lists of ids. ``run_study`` writes: first the cleaned inputs and the
entity-level tables, which several summaries read, then the summaries from those. A
written table prunes columns, and a lost executor does not cost a recompute.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import first_match, is_true, month_key, month_label, parse_date, recode
from tallyward.operators import battery, charts, checks, columns, device, expected, flow, followup
from tallyward.operators import funnel, reasons, status
from tallyward.plans.config import StudyConfig
from tallyward.sources.sinks import read_product, write_product

Stage = Callable[[str, DataFrame], DataFrame]

DATETIMES = ("enroll_dttm", "death_dttm", "hospdis_dttm")
COUNTS = ("blue_drawn", "purple_drawn", "bed_device_num")


def clean_inhosp(raw: DataFrame, cfg: StudyConfig) -> DataFrame:
    """In-hospital records: no test entities, times and dates parsed, counts as numbers."""
    df = columns.drop_test_entities(raw, "id")
    df = df.withColumn("studywd_date", parse_date(F.col("studywd_dttm"))).drop("studywd_dttm")
    df = columns.with_parsed_datetimes(df, DATETIMES)
    df = columns.with_parsed_dates(df, ["daily_date"])
    df = df.withColumns({c: F.col(c).try_cast("int") for c in COUNTS})
    return columns.unify_endings(df, cfg.record_endings)


def clean_exclusions(raw: DataFrame) -> DataFrame:
    """Exclusions: no test entities, date parsed."""
    return columns.with_parsed_dates(columns.drop_test_entities(raw, "exc_id"), ["exc_date"])


def clean_followup(raw: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Follow-up records: the columns of the instruments, names spelt one way, dates parsed."""
    ways = [way for spelt in cfg.followup_endings.values() for way in spelt]
    own = {f"{stem}{way}" for stem in cfg.instruments.all for way in ways}
    wanted = columns.matching(raw, any_of=(*cfg.ids, cfg.event_col, cfg.refusal_reason_col, *own))
    df = columns.unify_endings(raw.select(*wanted), cfg.followup_endings)
    return columns.with_parsed_dates(df, [f"{s}_date" for s in cfg.instruments.dated])


def _direct(_name: str, df: DataFrame) -> DataFrame:
    return df


def study_products(
    inputs: Mapping[str, DataFrame], cfg: StudyConfig, as_of: dt.date, *, stage: Stage = _direct
) -> dict[str, DataFrame]:
    """All derived tables of a study, from its inputs ``inhosp``, ``exc`` and ``fu``.

    ``stage`` gets each table that several others read and gives back what they read.
    """
    by = list(cfg.by)
    inhosp = stage("inhosp", clean_inhosp(inputs["inhosp"], cfg))
    exc = stage("exc", clean_exclusions(inputs["exc"]))
    fu = stage("fu", clean_followup(inputs["fu"], cfg))
    enrolment = inhosp.where(F.col(cfg.event_col) == cfg.enrol_event)
    enrolled = stage(
        "enrolled",
        status.terminal_status(
            enrolment.where(F.col("enroll_date").isNotNull()),
            cfg.terminal_rules, cfg.terminal_open, out="inhosp_status",
        ),
    )
    out = {"enrolled": enrolled}
    out |= _screening(exc, enrolment, cfg, as_of, stage)
    out |= _in_hospital(inhosp, enrolled, out["screening_kpis"], cfg, stage)
    fu_status = stage("fu_status", _followup_status(enrolled, fu, cfg, as_of))
    out["fu_status"] = fu_status
    visit = [cfg.event_col]
    out["fu_totals"] = followup.followup_totals(fu_status, visit_col=cfg.event_col, by=by)
    out["fu_instruments"] = followup.followup_instruments(
        fu_status, cfg.instruments, cfg.windows, visit_col=cfg.event_col,
        labels=cfg.instrument_labels, by=by,
    )
    out["fu_not_assessed"] = followup.not_yet_assessed(
        fu_status, id_cols=cfg.ids, visit_col=cfg.event_col, by=by
    )
    out["fu_not_assessed_text"] = funnel.id_lines(
        out["fu_not_assessed"].select(*by, *visit, "id").distinct(), by=[*by, *visit]
    )
    edges = flow.state_flow(
        flow_stages(enrolled, fu_status, cfg),
        source_rank=cfg.source_rank, target_rank=cfg.target_rank, by=by,
    )
    out["flow_edges"] = flow.with_flow_text(
        edges, one_source=cfg.one_source, one_target=cfg.one_target
    )
    return out


def _screening(
    exc: DataFrame, enrolment: DataFrame, cfg: StudyConfig, as_of: dt.date, stage: Stage
) -> dict[str, DataFrame]:
    by = list(cfg.by)
    monthly = stage(
        "screening_monthly",
        funnel.screening_funnel(exc, enrolment, refusal_col=cfg.refusal_col, by=by)[0],
    )
    kpis = stage("screening_kpis", funnel.funnel_kpis(monthly, goal=cfg.goal, by=by))
    undated = stage(
        "undated_ids",
        funnel.undated_ids(
            [(exc, "exc_id", "exc_date"), (enrolment, "id", "enroll_date")], by=by
        ),
    )
    totals = stage("reason_totals", reasons.reason_totals(exc, cfg.reason_dim, by=by))
    shares = stage(
        "reason_share", reasons.reason_share(exc, cfg.reason_dim, id_cols=cfg.exc_ids, by=by)
    )
    return {
        "screening_monthly": monthly,
        "screening_axis": charts.with_month_axis(monthly, by=by),
        "screening_kpis": kpis,
        "screening_statement": funnel.funnel_statement(kpis, as_of=as_of, by=by),
        "undated_ids": undated,
        "undated_text": funnel.undated_message(undated, by=by),
        "reason_share": shares,
        "reason_axis": charts.with_month_axis(shares, by=by),
        "reason_totals": totals,
        "reason_hierarchy": reasons.hierarchy_totals(
            totals, ["reason_type", "reason"], "n_reason", by=by
        ),
    }


def _in_hospital(
    inhosp: DataFrame, enrolled: DataFrame, kpis: DataFrame, cfg: StudyConfig, stage: Stage
) -> dict[str, DataFrame]:
    by, ids = list(cfg.by), cfg.ids
    still_in = enrolled.where(F.col("inhosp_status") == cfg.terminal_open)
    timeline = status.daily_status_timeline(
        enrolled.select(*ids, "enroll_date", *(c for c, _ in cfg.day_rules)),
        "enroll_date", range(1, cfg.n_days + 1), cfg.day_rules,
        {1: cfg.enrol_event, cfg.n_days: cfg.discharge_event}, default=cfg.day_default,
        event_col=cfg.event_col,
    )
    observations = expected.timed_observations(
        inhosp.select(*ids, cfg.event_col, *cfg.time_cols, *cfg.measures),
        cfg.time_cols, event_col=cfg.event_col, second_event=cfg.discharge_event,
        cut=cfg.time_cuts,
    )
    compliance = expected.expected_vs_observed(
        enrolled, observations, cfg.schedule, measures=cfg.measures, rules=cfg.day_rules,
        id_cols=ids, event_col=cfg.event_col, default_state=cfg.day_default,
        not_expected=cfg.not_expected, by=by,
    )
    wear, why, times = device.device_wear(
        inhosp, enrolled, cfg.slot_cols, worn=is_true(F.col("coord_ever") == "Yes"),
        permanent=cfg.permanent_reason, prep_label=cfg.prep_label, id_cols=ids,
        bins=cfg.removal_bins, by=by,
    )
    why = stage("removal_reasons", why)
    day = F.col("daily_date")
    removals = inhosp.where(day.isNotNull()).select(
        *ids, "daily_date", month_key(day).alias("myear"),
        month_label(day).alias("myear_char"), "bed_device_num",
    )
    batteries, instruments = battery.battery_completion(
        enrolled, cfg.battery_instruments, cfg.batteries, labels=cfg.battery_labels,
        ending=cfg.battery_ending, by=by,
    )
    return {
        "status_counts": status.status_counts(enrolled, status="inhosp_status", by=by),
        "still_in_text": funnel.id_lines(
            still_in.select(*ids).distinct(), by=by, empty=None if by else "None"
        ),
        "timeline": timeline,
        "visit_compliance": expected.compliance_text(compliance),
        "device_kpis": wear,
        "removal_reasons": why,
        "removal_histogram": times,
        "device_days": removals,
        "permanent_removal_kpis": device.permanent_removal_kpis(
            why, kpis, permanent=cfg.permanent_reason, by=by
        ),
        "batteries": batteries,
        "battery_instruments": instruments,
    }


def _followup_status(
    enrolled: DataFrame, fu: DataFrame, cfg: StudyConfig, as_of: dt.date
) -> DataFrame:
    entities = enrolled.select(
        *cfg.ids, "hospdis_date", "studywd_date", "death_date", "inhosp_status"
    )
    records = followup.slim_records(
        fu, cfg.instruments, id_cols=cfg.ids, visit_col=cfg.event_col,
        refusal=F.col(cfg.refusal_reason_col) == cfg.refusal_reason,
    )
    return followup.followup_status(
        entities, records, cfg.instruments,
        anchor_col="hospdis_date", window_dim=cfg.windows,
        visits=fu if cfg.visits is None else cfg.visits, as_of=as_of,
        no_consent_ids=cfg.no_consent_ids, merge=cfg.merge_records, id_cols=cfg.ids,
        visit_col=cfg.event_col, by=cfg.by,
    )


# Follow-up status -> node of the flow chart, without the visit.
NODES = {
    followup.DIED: "Died",
    followup.WITHDREW: "Withdrew",
    followup.ASSESSED: "Assessed",
    followup.ELIGIBLE: "Not assessed",
    followup.REFUSED: "Not assessed",
    followup.NOT_YET: "Not yet eligible",
}
NO_NODE = "Missing"


def _visit_nodes(suffix: str) -> dict[str, str]:
    return {status: f"{node}, {suffix}" for status, node in NODES.items()}


def flow_stages(enrolled: DataFrame, fu_status: DataFrame, cfg: StudyConfig) -> list[DataFrame]:
    """Enrolled -> end of stay -> early visit -> late visit.

    Those still in hospital take part in the first stage only. A death or withdrawal
    in hospital carries over to the early visit whatever its status there. All edges
    after the end of stay come from one pass over the status.
    """
    by, ids = list(cfg.by), cfg.ids
    in_hospital, state = F.col("inhosp_status"), F.col("fu_status")
    node = recode(in_hospital, cfg.hospital_states)

    stay = enrolled.select(*ids, "inhosp_status").distinct()
    first = stay.select(*by, F.lit("Enrolled").alias("source"), node.alias("target"))

    early_nodes, late_nodes = _visit_nodes("3m"), _visit_nodes("12m")
    died, withdrew = (in_hospital == s for s in ("Died in hospital", "Withdrew in hospital"))
    early_node = first_match(
        [
            (died | (state == followup.DIED), early_nodes[followup.DIED]),
            (withdrew, early_nodes[followup.WITHDREW]),
        ],
        recode(state, early_nodes, F.lit(NO_NODE)),
    )
    late_node = recode(state, late_nodes, F.lit(NO_NODE))

    early, late = (F.col(cfg.event_col) == v for v in (cfg.early_visit, cfg.late_visit))
    later = flow.stage_edges(
        fu_status.where(in_hospital != cfg.terminal_open),
        id_cols=ids,
        by=by,
        stages=((early, early_node), (late, late_node)),
        origin=node,
        weight=followup.N_RECORDS if followup.N_RECORDS in fu_status.columns else None,
    )
    return [first, later]


def input_rules(cfg: StudyConfig) -> dict[str, checks.Rules]:
    """What the staged tables of a study are taken to hold."""
    day = F.col("daily_date")
    return {
        "inhosp": {
            "id": F.col("id").isNotNull(),
            "event": F.col(cfg.event_col).isNotNull(),
            "day_not_before_enrolment": day.isNull() | (day >= F.coalesce("enroll_date", day)),
        },
        "exc": {"id": F.col("exc_id").isNotNull(), "date": F.col("exc_date").isNotNull()},
        "fu": {"id": F.col("id").isNotNull(), "event": F.col(cfg.event_col).isNotNull()},
        "enrolled": {
            "death_not_before_enrolment": F.col("death_date").isNull()
            | (F.col("death_date") >= F.col("enroll_date")),
        },
    }


def run_study(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    cfg: StudyConfig,
    as_of: dt.date,
    out: str,
    *,
    strict: bool = False,
) -> list[str]:
    """Write all derived tables under ``out``, one folder each; returns their names.

    Rows of the staged tables that break a rule of ``input_rules`` are counted as they are
    written, in the table ``input_checks``; with ``strict`` the job ends at the first such
    table.
    """
    written: list[str] = []
    found: list[tuple[str, str, int, int]] = []
    rules = input_rules(cfg)

    def stage(name: str, df: DataFrame) -> DataFrame:
        path = f"{out}/{name}"
        seen = None
        if name in rules:
            df, seen = checks.observed(df, rules[name])
        write_product(df, path, as_of)
        written.append(name)
        if seen is not None:
            found.extend((name, *row) for row in checks.broken_rules(seen))
            if strict:
                checks.assert_rules(name, seen)
        return read_product(spark, path, as_of)

    products = study_products(inputs, cfg, as_of, stage=stage)
    products["input_checks"] = spark.createDataFrame(
        found, "source string, rule string, n_broken long, n_rows long"
    )
    for name, df in products.items():
        if name not in written:
            write_product(df, f"{out}/{name}", as_of)
            written.append(name)
    return written
