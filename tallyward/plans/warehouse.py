"""The operators applied to the warehouse tables (orders, lineitem, events, ...).

Orders stand for the entities of a study, order lines for their records, ship dates
for visit dates, customers for entities that pass through several states. Every
query reads its whole tables.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward.functions import (
    alert_above,
    alert_below,
    as_text,
    count_done,
    date_parts,
    date_text,
    days_between,
    first_match,
    leading_integer,
    parse_date,
    parse_datetime,
    percent,
    percent_text,
    ratio,
    remove_first,
    replace_first,
    thousands,
)
from tallyward.operators import battery, charts, columns, device, dimensions, expected, flow
from tallyward.operators import followup, funnel, joins, reasons, reshape, status
from tallyward.plans.icu_study import ICU_STUDY
from tallyward.plans.study import flow_stages
from tallyward.sources import load_inputs, read_product, staging, write_product

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("order_date", F.to_date("o_orderdate"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("ship_date", F.to_date("l_shipdate"))


# -- Screening ---------------------------------------------------------------------


def _flagged_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders, state = _orders(spark, sf), F.col("o_orderstatus")
    return orders.withColumns(
        {
            "screened": F.lit(True),
            "approached": state.isin("F", "O"),
            "refused": state == "O",
            "enrolled": state == "F",
        }
    )


@query
def screening_funnel_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.monthly_funnel(_flagged_orders(spark, sf), date_col="order_date")


@query
def screening_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_kpis(screening_funnel_monthly(spark, sf), goal=312)


@query
def screening_statement(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_statement(screening_kpis(spark, sf), as_of=dt.date(2001, 8, 1))


@query
def screening_funnel_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    by = ["o_orderpriority"]
    return funnel.monthly_funnel(_flagged_orders(spark, sf), date_col="order_date", by=by)


@query
def screening_kpis_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_kpis(
        screening_funnel_by_priority(spark, sf), goal=312, by=["o_orderpriority"]
    )


def _excluded_and_enrolled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Returned lines as exclusions, undated if tax-free; orders, undated if pending."""
    excluded = (
        _lines(spark, sf)
        .where(F.col("l_returnflag") == "R")
        .select(
            F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("exc_id"),
            F.when(F.col("l_tax") > 0, F.col("ship_date")).alias("exc_date"),
            F.when(F.col("l_discount") >= 0.08, F.lit("Checked")).alias("refusal"),
        )
    )
    enrolled = _orders(spark, sf).select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("order_date")).alias("enroll_date"),
    )
    return excluded, enrolled


@query
def screening_two_sources(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.screening_funnel(*_excluded_and_enrolled(spark, sf), refusal_col="refusal")[0]


@query
def screening_two_sources_dated(spark: SparkSession, sf: str) -> DataFrame:
    """Key figures with undated enrolments left out."""
    return funnel.screening_funnel(
        *_excluded_and_enrolled(spark, sf), refusal_col="refusal", undated="drop", goal=312
    )[1]


@query
def undated_ids(spark: SparkSession, sf: str) -> DataFrame:
    excluded, enrolled = _excluded_and_enrolled(spark, sf)
    return funnel.undated_ids([(excluded, "exc_id", "exc_date"), (enrolled, "id", "enroll_date")])


@query
def undated_ids_message(spark: SparkSession, sf: str) -> DataFrame:
    excluded, enrolled = _excluded_and_enrolled(spark, sf)
    return funnel.missing_date_report(
        [(excluded, "exc_id", "exc_date"), (enrolled, "id", "enroll_date")]
    )[1]


@query
def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of orders without any line, as text per month."""
    with_lines = _lines(spark, sf).select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    missing = _orders(spark, sf).join(with_lines, "o_orderkey", "left_anti")
    ids = missing.select(
        F.date_format("order_date", "yyyy-MM").alias("myear"),
        F.col("o_orderkey").cast("string").alias("id"),
    )
    return funnel.id_lines(ids, by=["myear"])


@query
def screening_kpis_conditional(spark: SparkSession, sf: str) -> DataFrame:
    """Rates among the approached, where some refused and some enrolled were not approached."""
    state, urgency = F.col("o_orderstatus"), F.col("o_orderpriority")
    flagged = _orders(spark, sf).withColumns(
        {
            "screened": F.lit(True),
            "approached": urgency != "1-URGENT",
            "refused": state == "O",
            "enrolled": state == "F",
        }
    )
    return funnel.funnel_kpis(funnel.monthly_funnel(flagged, date_col="order_date"), goal=312)


@query
def screening_month_axis(spark: SparkSession, sf: str) -> DataFrame:
    return charts.with_month_axis(screening_funnel_monthly(spark, sf))


@query
def screening_bar_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the monthly bars."""
    bars = {"screened": "Screened", "approached": "Approached", "enrolled": "Enrolled"}
    out = charts.with_count_texts(screening_two_sources(spark, sf), "myear_char", bars)
    return out.select("myear", *(f"{b}_text" for b in bars))


# -- Reasons -----------------------------------------------------------------------

LINE_REASONS = {
    "discounted": ("Discount of 5% or more", "Price"),
    "bulk": ("Quantity over 40", "Volume"),
    "returned": ("Returned", None),
}


def _lines_with_reasons(spark: SparkSession, sf: str) -> DataFrame:
    def checked(cond):
        return F.when(cond, F.lit("Checked"))

    return _lines(spark, sf).withColumns(
        {
            "discounted": checked(F.col("l_discount") >= 0.05),
            "bulk": checked(F.col("l_quantity") > 40),
            "returned": checked(F.col("l_returnflag") == "R"),
        }
    )


@query
def reason_share(spark: SparkSession, sf: str) -> DataFrame:
    return reasons.reason_share(
        _lines_with_reasons(spark, sf), LINE_REASONS, id_cols=["l_orderkey"], date_col="ship_date"
    )


@query
def reason_share_by_line_status(spark: SparkSession, sf: str) -> DataFrame:
    return reasons.reason_share(
        _lines_with_reasons(spark, sf), LINE_REASONS, id_cols=["l_orderkey"],
        date_col="ship_date", by=["l_linestatus"],
    )


@query
def reason_totals(spark: SparkSession, sf: str) -> DataFrame:
    return reasons.reason_totals(_lines_with_reasons(spark, sf), LINE_REASONS)


@query
def reason_line_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of the points of the reasons' lines."""
    out = charts.with_share_text(reason_share(spark, sf), "myear_char", "reason", "percent")
    return out.select("myear", "reason", "share_text")


@query
def exclusions_title(spark: SparkSession, sf: str) -> DataFrame:
    """Number of excluded, with thousands separators, in a title."""
    total = thousands(F.max("n_patients_exc"))
    return reason_totals(spark, sf).agg(
        F.concat(F.lit("Cumulative Exclusions (Total: "), total, F.lit(")")).alias("title")
    )


@query
def reason_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return reasons.reason_hierarchy(_lines_with_reasons(spark, sf), LINE_REASONS)


@query
def status_priority_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    counts = (
        table(spark, sf, "orders")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count("*").alias("n_orders"))
    )
    return reasons.hierarchy_totals(counts, ["o_orderstatus", "o_orderpriority"], "n_orders")


def _nation_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as codes with a label, their regions as types."""
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return table(spark, sf, "nation").join(regions, "n_regionkey", "left").select(
        F.col("n_nationkey").alias("code"),
        F.col("n_name").alias("reason"),
        F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("reason_type"),
    )


@query
def coded_reason_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per nation and region, both from the tables; one region has no type."""
    dim = dimensions.checked_dimension(_nation_dim(spark, sf), ["code"])
    totals = reasons.coded_totals(table(spark, sf, "customer"), "c_nationkey", dim)
    return reasons.hierarchy_totals(totals, ["reason_type", "reason"], "n_reason")


@query
def unmatched_reason_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of customers that a dimension of some regions lacks, per segment."""
    dim = _nation_dim(spark, sf).where("reason_type is not null")
    return dimensions.unmatched_codes(
        table(spark, sf, "customer"), dim, {"c_nationkey": "code"}, by=["c_mktsegment"]
    )


@query
def reason_share_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of boxes whose labels come from a table: priorities, named by what they hold."""
    lines = _lines_with_reasons(spark, sf)
    label = F.concat(F.col("o_orderstatus"), F.lit(" of "), F.format_number(F.count("*"), 0))
    box = F.when(F.col("o_orderstatus") == "F", "discounted").when(
        F.col("o_orderstatus") == "O", "bulk"
    )
    dim = (
        table(spark, sf, "orders")
        .groupBy("o_orderstatus")
        .agg(label.alias("reason"))
        .select(box.alias("box"), "reason", F.lit("Status").alias("reason_type"))
        .where("box is not null")
    )
    return reasons.reason_share(
        lines, dimensions.checked_dimension(dim, ["box"]), boxes=list(LINE_REASONS),
        id_cols=["l_orderkey"], date_col="ship_date",
    )


# -- Status ------------------------------------------------------------------------

USER_RULES = [
    ("discharge_date", "Discharged alive"),
    ("death_date", "Died in hospital"),
    ("withdrawal_date", "Withdrew in hospital"),
]
DAY_RULES = [
    ("death_date", "Deceased"),
    ("discharge_date", "Discharged"),
    ("withdrawal_date", "Withdrawn"),
]


def _users(spark: SparkSession, sf: str, cutoff: dict[str, float]) -> DataFrame:
    """First event date per user, and first date of a large event of each kind."""
    day, kind, value = F.to_date("ts"), F.col("event_type"), F.col("value")

    def first_large(event: str):
        return F.min(F.when((kind == event) & (value > cutoff[event]), day))

    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            F.min(day).alias("start_date"),
            first_large("purchase").alias("discharge_date"),
            first_large("error").alias("death_date"),
            first_large("signup").alias("withdrawal_date"),
        )
    )


HIGH = {"purchase": 300.0, "error": 300.0, "signup": 300.0}
LOW = {"purchase": 100.0, "error": 150.0, "signup": 150.0}


@query
def terminal_status_rows(spark: SparkSession, sf: str) -> DataFrame:
    return status.terminal_status(_users(spark, sf, HIGH), USER_RULES, "Still in hospital")


@query
def terminal_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return status.status_counts(terminal_status_rows(spark, sf))


@query
def still_open_ids(spark: SparkSession, sf: str) -> DataFrame:
    still_in = terminal_status_rows(spark, sf).where(F.col("status") == "Still in hospital")
    return funnel.id_lines(still_in.select(F.col("user_id").alias("id")), empty="None")


@query
def still_open_sentence(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of open ids with their lead-in."""
    return still_open_ids(spark, sf).select(
        "line", F.concat(F.lit("Patients currently in hospital: "), "ids").alias("sentence")
    )


def _timeline(spark: SparkSession, sf: str, as_of: dt.date | None = None) -> DataFrame:
    return status.daily_status_timeline(
        _users(spark, sf, LOW), "start_date", range(1, 30), DAY_RULES,
        {1: "Enrollment /Trial Day 1", 29: "Discharge Day"}, as_of=as_of,
    )


def _timeline_counts(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy("study_day", "event", "study_status").agg(
        F.count("*").alias("n"), F.count_if("transition_day").alias("n_transition")
    )


@query
def daily_status_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline(spark, sf)


@query
def daily_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline_counts(_timeline(spark, sf))


@query
def daily_status_counts_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return _timeline_counts(_timeline(spark, sf, dt.date(2024, 1, 20)))


# -- Expected visits ---------------------------------------------------------------

LINE_VISITS = (
    expected.Visit(1, "Line 1", "Day 1", ("In hospital",), or_transition=True),
    expected.Visit(3, "Line 3", "Day 3", ("In hospital",), or_transition=True),
    expected.Visit(5, "Line 5", "Day 5", ("In hospital",), or_transition=True),
    expected.Visit(29, "Line 7", "Discharge", ("In hospital", "Discharged")),
)


def _stays(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders are discharged on day 4, pending ones die on day 3."""
    state, date = F.col("o_orderstatus"), F.col("order_date")
    return _orders(spark, sf).select(
        F.col("o_orderkey").alias("id"),
        "o_orderpriority",
        date.alias("enroll_date"),
        F.when(state == "P", F.date_add(date, 2)).alias("death_date"),
        F.when(state == "O", F.date_add(date, 3)).alias("discharge_date"),
    )


def _measured_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("Line "), F.col("l_linenumber").cast("string")).alias("event"),
        (F.col("l_quantity") - 10).alias("over_ten"),
        F.col("l_tax").alias("taxed"),
    )


def _compliance(spark: SparkSession, sf: str, **options) -> DataFrame:
    return expected.expected_vs_observed(
        _stays(spark, sf),
        _measured_lines(spark, sf),
        LINE_VISITS,
        measures={"over_ten": "purple", "taxed": "blue"},
        rules=[("death_date", "Deceased"), ("discharge_date", "Discharged")],
        event_col="event",
        not_expected=[("Day 3", "blue"), ("Day 5", "blue")],
        **options,
    )


@query
def visit_compliance(spark: SparkSession, sf: str) -> DataFrame:
    return expected.compliance_text(_compliance(spark, sf))


@query
def visit_compliance_once_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Each visit counted once, and none that is due after a date."""
    return _compliance(
        spark, sf, dedupe=True, as_of=dt.date(1998, 6, 30), by=["o_orderpriority"]
    )


@query
def timed_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Time labels merged from two columns; two-time labels give two rows."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("event"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Enrollment/")).alias("time_e"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Day 5 and Discharge"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Day 3 only"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Day 1"))
        .alias("time_5"),
        "o_totalprice",
    )
    rows = expected.timed_observations(
        orders, ["time_e", "time_5"], event_col="event", cut=["Enrollment/", " only"]
    )
    return rows.groupBy("event", "specimen_time").agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("max_price")
    )


# -- Device ------------------------------------------------------------------------


PERMANENT = "Permanent discontinuation"
BEFORE_DISCHARGE = "Removed within a day of hospital discharge"


def _device_days(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return _lines(spark, sf).select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_tax") > 0, F.col("ship_date")).alias("daily_date"),
        (flag != "R").alias("worn"),
        F.col("l_quantity").alias("removals"),
        "l_linestatus",
        F.when(flag == "R", F.lit(PERMANENT)).otherwise(flag).alias("why_1"),
        F.when(F.col("l_discount") >= 0.05, F.col("l_linestatus")).alias("why_2"),
    )


def _final_orders(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _orders(spark, sf)
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("id"), F.col("order_date").alias("hospdis_date"))
    )


@query
def removal_reasons(spark: SparkSession, sf: str) -> DataFrame:
    events = device.removal_events(
        _device_days(spark, sf), _final_orders(spark, sf), ["why_1", "why_2"],
        permanent=PERMANENT, prep_label=BEFORE_DISCHARGE, prep_days=range(60),
    )
    return device.removal_reasons(events)


@query
def permanent_removal_kpis(spark: SparkSession, sf: str) -> DataFrame:
    enrolled = _final_orders(spark, sf).agg(F.count("*").alias("n_enrolled"))
    return device.permanent_removal_kpis(
        removal_reasons(spark, sf), enrolled, permanent=PERMANENT
    )


@query
def device_wear_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return device.wear_kpis(_device_days(spark, sf), worn=F.col("worn"), removals_col="removals")


@query
def figure_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Texts and alerts of the boxes: full batteries, days worn, permanent removals."""
    worn = device_wear_kpis(spark, sf).select(
        F.lit("worn").alias("box"), F.col("pct_accel_worn").alias("pct"), F.col("accel_worn_alert").alias("alert")
    )
    full = battery_completion(spark, sf).select(F.col("battery").alias("box"), F.col("pct_comp").alias("pct"), "alert")
    return charts.with_box_text(worn.unionByName(full), "pct")


@query
def device_wear_kpis_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return device.wear_kpis(
        _device_days(spark, sf), worn=F.col("worn"), removals_col="removals", by=["l_linestatus"]
    )


@query
def removal_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return device.removal_histogram(
        _device_days(spark, sf), removals_col="removals", bins=(1, 60)
    )


# -- Batteries ---------------------------------------------------------------------

LINE_NUMBERS = range(1, 8)
LINE_INSTRUMENTS = {
    f"line_{k}_comp_ph": dt.date(1998, 1, 1) if k == 7 else None for k in LINE_NUMBERS
}
LINE_BATTERIES = {
    "all lines": tuple(LINE_INSTRUMENTS),
    "first two": ("line_1_comp_ph", "line_2_comp_ph"),
}


def _orders_with_batteries(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with one text per line number: ``Yes`` if the order has that line."""
    has_line = (
        _lines(spark, sf)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            *(
                F.when(F.bool_or(F.col("l_linenumber") == k), F.lit("Yes, fully")).alias(
                    f"line_{k}_comp_ph"
                )
                for k in LINE_NUMBERS
            )
        )
    )
    return _orders(spark, sf).join(has_line, "o_orderkey", "left")


def _battery(spark: SparkSession, sf: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    return battery.battery_completion(
        _orders_with_batteries(spark, sf), LINE_INSTRUMENTS, LINE_BATTERIES,
        date_col="order_date", labels={"line_1_comp_ph": "General"}, ending="_comp_ph", by=by,
    )


@query
def battery_completion(spark: SparkSession, sf: str) -> DataFrame:
    return _battery(spark, sf, [])[0]


@query
def battery_instruments(spark: SparkSession, sf: str) -> DataFrame:
    return _battery(spark, sf, [])[1]


@query
def battery_instruments_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return _battery(spark, sf, ["o_orderpriority"])[1]


@query
def completion_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Share of a part's lines over seven pieces, with its text, band and alerts."""
    share = ratio(F.col("n_comp"), F.col("n_elig"))
    parts = (
        table(spark, sf, "lineitem")
        .groupBy(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("part"))
        .agg(F.count("*").alias("n_elig"), F.count_if(F.col("l_quantity") > 7).alias("n_comp"))
        .withColumn("prop_comp", share)
    )
    pct = percent(F.col("n_comp"), F.col("n_elig"))
    return charts.with_completion_text(parts, "part").withColumns(
        {"low": alert_below(pct, 80), "high": alert_above(100 - pct, 20, 15)}
    )


# -- Follow-up ---------------------------------------------------------------------

WINDOWS = {
    1: followup.VisitWindow(30, 14, phone=True),
    2: followup.VisitWindow(60, 14, phone=True),
    3: followup.VisitWindow(83, 56, phone=False),
    6: followup.VisitWindow(180, 30, phone=True),
    12: followup.VisitWindow(335, 90, phone=False),
}
VISITS = {m: f"{m} Month {'Phone Call' if w.phone else 'Assessment'}" for m, w in WINDOWS.items()}
LINES = followup.Instruments(
    phone=("line1", "line2"),
    full=tuple(f"line{k}" for k in LINE_NUMBERS if k != 2),
    undated=("line7",),
)
FOLLOWUP_AS_OF = dt.date(2001, 6, 30)


def _order_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as entities: discharged on the order date, except the urgent pending ones.

    Open low-priority orders died and open high-priority ones withdrew, some time
    after discharge; urgent pending ones died in hospital, medium ones are still in.
    """
    state, urgency, date = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("order_date")
    late = (state == "P") & urgency.isin("1-URGENT", "3-MEDIUM")
    entities = _orders(spark, sf).select(
        F.col("o_orderkey").alias("id"),
        urgency,
        F.when(~late, date).alias("hospdis_date"),
        F.when((state == "P") & (urgency == "1-URGENT"), date)
        .when((state == "O") & (urgency == "5-LOW"), F.date_add(date, 100))
        .alias("death_date"),
        F.when((state == "O") & (urgency == "2-HIGH"), F.date_add(date, 50)).alias("studywd_date"),
    )
    return status.terminal_status(
        entities,
        [
            ("hospdis_date", "Discharged alive"),
            ("death_date", "Died in hospital"),
            ("studywd_date", "Withdrew in hospital"),
        ],
        "Still in hospital",
        out="inhosp_status",
    )


def _visit_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped within a visit window of their order, as visit records."""
    orders = _orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "order_date")
    after = days_between(F.col("ship_date"), F.col("order_date"))
    visit = first_match(
        [
            (after.between(w.enter_after, w.enter_after + w.exit_after), VISITS[m])
            for m, w in WINDOWS.items()
        ]
    )
    lines, orders = joins.dealt_alike(["l_orderkey"], _lines(spark, sf), orders)
    return (
        lines.join(orders, "l_orderkey")
        .select(
            F.col("l_orderkey").alias("id"),
            visit.alias("event"),
            "l_linenumber",
            "ship_date",
            "l_returnflag",
        )
        .where(F.col("event").isNotNull())
    )


def _line_records(spark: SparkSession, sf: str) -> DataFrame:
    """Visit records with one flag and one date per line number; returned is refused."""
    lines, number = _visit_lines(spark, sf), F.col("l_linenumber")
    done = F.col("l_returnflag") != "R"
    return lines.select(
        "id",
        "event",
        F.when(~done, F.lit("Patient refusal")).alias("gq_rsn"),
        *(
            F.when((number == k) & done, F.lit("Yes")).alias(f"line{k}_complete")
            for k in LINE_NUMBERS
        ),
        *(
            F.when((number == k) & done, F.col("ship_date")).alias(f"line{k}_date")
            for k in LINE_NUMBERS
        ),
    )


def _followup(
    spark: SparkSession, sf: str, merge: bool, visits: DataFrame | None = None, no_consent=range(1, 8)
) -> DataFrame:
    """Status with the records of a visit merged, or else counted by what they hold."""
    records = followup.slim_records(
        _line_records(spark, sf), LINES, refusal=F.col("gq_rsn") == "Patient refusal"
    )
    return followup.followup_status(
        _order_entities(spark, sf), records, LINES,
        anchor_col="hospdis_date", window_dim=WINDOWS,
        visits=list(VISITS.values()) if visits is None else visits,
        as_of=FOLLOWUP_AS_OF, merge=merge, counted=not merge, no_consent_ids=no_consent,
    )


@query
def followup_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders times the visits that occur in the records."""
    visits = _visit_lines(spark, sf)
    grid = followup.followup_windows(
        _order_entities(spark, sf), "hospdis_date", WINDOWS, visits
    )
    return grid.select(
        "id", "inhosp_status", "event", "phone_only", "enter_window", "exit_window"
    )


@query
def followup_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = _followup(spark, sf, merge=True)
    return rows.select(
        "id", "event", "fu_month", "enter_window", "exit_window", "in_window",
        "n_asmts_phone", "n_asmts_full", "any_phone", "any_full", "all_phone", "all_full",
        "first_asmt", "last_asmt", "fu_status", "fu_elig", "fu_comp", "line1_complete",
        "line7_complete",
    )


@query
def followup_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return followup.followup_counts(_followup(spark, sf, merge=True))


@query
def followup_status_counts_all_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of a visit counts on its own."""
    return followup.followup_counts(_followup(spark, sf, merge=False))


@query
def followup_totals(spark: SparkSession, sf: str) -> DataFrame:
    return followup.followup_totals(_followup(spark, sf, merge=True))


@query
def followup_totals_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return followup.followup_totals(_followup(spark, sf, merge=True), by=["o_orderpriority"])


@query
def followup_instruments(spark: SparkSession, sf: str) -> DataFrame:
    return followup.followup_instruments(
        _followup(spark, sf, merge=True), LINES, WINDOWS, labels={"line1": "First"}
    )


@query
def followup_totals_all_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each record counts, and the ids without phone consent are a table."""
    listed = _orders(spark, sf).where(F.col("o_orderkey").between(1, 7)).select(F.col("o_orderkey").alias("id"))
    return followup.followup_totals(_followup(spark, sf, merge=False, no_consent=listed))


@query
def followup_instruments_all_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each record counts; the visits are those that occur in the records."""
    visits = _visit_lines(spark, sf).select("event").distinct()
    return followup.followup_instruments(
        _followup(spark, sf, merge=False, visits=visits), LINES, WINDOWS, labels={"line1": "First"}
    )


def _group_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows by priority: the lower it is, the fewer visits and the later they are."""
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    rows = F.array(
        *(
            F.struct(
                F.lit(VISITS[m]).alias("event"),
                F.lit(m).alias("fu_month"),
                F.lit(w.phone).alias("phone_only"),
                F.lit(w.enter_after).alias("enter_after"),
                F.lit(w.exit_after).alias("exit_after"),
            )
            for m, w in WINDOWS.items()
        )
    )
    each = table(spark, sf, "orders").select("o_orderpriority").distinct()
    each = each.select("o_orderpriority", number.alias("number"), F.inline(rows))
    later = each.withColumn("enter_after", F.col("enter_after") + 5 * F.col("number"))
    return later.where(F.col("fu_month") <= 15 - 3 * F.col("number")).drop("number")


def _followup_by_group(spark: SparkSession, sf: str) -> DataFrame:
    records = followup.slim_records(
        _line_records(spark, sf), LINES, refusal=F.col("gq_rsn") == "Patient refusal"
    )
    windows = dimensions.checked_dimension(
        _group_windows(spark, sf), ["o_orderpriority", "event"]
    )
    return followup.followup_status(
        _order_entities(spark, sf), records, LINES, anchor_col="hospdis_date",
        window_dim=windows, as_of=FOLLOWUP_AS_OF, counted=True, no_consent_ids=range(1, 8),
        by=["o_orderpriority"],
    )


@query
def followup_totals_group_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Groups with visits and windows of their own, from a table."""
    return followup.followup_totals(_followup_by_group(spark, sf), by=["o_orderpriority"])


@query
def followup_instruments_group_windows(spark: SparkSession, sf: str) -> DataFrame:
    return followup.followup_instruments(
        _followup_by_group(spark, sf), LINES, _group_windows(spark, sf),
        labels={"line1": "First"}, by=["o_orderpriority"],
    )


@query
def followup_not_yet_text(spark: SparkSession, sf: str) -> DataFrame:
    """Ids due but not yet assessed, as text per visit."""
    ids = followup.not_yet_assessed(_followup(spark, sf, merge=False))
    # Distinct before they are text: the rows are dealt by the id as it is.
    ids = ids.select("event", "id").distinct()
    return funnel.id_lines(ids, by=["event"])


@query
def followup_not_yet_assessed(spark: SparkSession, sf: str) -> DataFrame:
    return followup.not_yet_assessed(_followup(spark, sf, merge=True))


@query
def first_last_dates(spark: SparkSession, sf: str) -> DataFrame:
    """First and last ship date of an order over all dates of its line numbers, across columns."""
    number = F.col("l_linenumber")
    folds = {"a": F.min, "z": F.max}
    dates = (
        _lines(spark, sf)
        .groupBy("l_orderkey")
        .agg(
            *(
                fold(F.when(number == k, F.col("ship_date"))).alias(f"{end}{k}")
                for end, fold in folds.items()
                for k in LINE_NUMBERS
            )
        )
    )
    first, last = ([F.col(f"{end}{k}") for k in LINE_NUMBERS] for end in folds)
    return dates.select(
        "l_orderkey",
        F.least(*first).alias("first_asmt"),
        F.greatest(*last).alias("last_asmt"),
        count_done(c.isNotNull() for c in first).alias("n_dates"),
    )


# -- Flow --------------------------------------------------------------------------

ORDER_STATES = ("F", "O", "P")
NODE_RANK = {
    "Start": 0,
    **{f"{s}, {k}": 3 * k + i for k in (1, 2, 3) for i, s in enumerate(ORDER_STATES)},
}


def _period() -> Column:
    """1 before 1997, 2 up to 1999, 3 from 2000 on."""
    year = F.year("o_orderdate")
    return F.when(year < 1997, 1).when(year < 2000, 2).otherwise(3)


def _order_flow(
    spark: SparkSession, sf: str, by: list[str], ranks: flow.Ranks = NODE_RANK
) -> DataFrame:
    """Order states over three periods: each order counts, against all of the period before."""
    orders = table(spark, sf, "orders").withColumn("period", _period())
    if by:
        customers = table(spark, sf, "customer").select(
            F.col("c_custkey").alias("o_custkey"), *by
        )
        orders = orders.join(customers, "o_custkey")

    def stage(k: int) -> tuple[Column, Column]:
        return F.col("period") == k, F.concat(F.col("o_orderstatus"), F.lit(f", {k}"))

    edges = flow.stage_edges(
        orders, id_cols=["o_custkey"], stages=[stage(k) for k in (1, 2, 3)], origin=F.lit("Start"), by=by
    )
    return flow.state_flow([edges], source_rank=ranks, target_rank=ranks, by=by)


@query
def state_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's last state in every period; a path ends at a period without orders."""
    last = F.struct("o_orderdate", "o_orderkey")
    paths = (
        table(spark, sf, "orders")
        .withColumn("period", _period())
        .groupBy("o_custkey")
        .agg(
            *(
                F.max_by(
                    F.when(F.col("period") == k, F.concat(F.col("o_orderstatus"), F.lit(f", {k}"))),
                    F.when(F.col("period") == k, last),
                ).alias(f"state_{k}")
                for k in (1, 2, 3)
            )
        )
    )
    edges = flow.path_edges(paths, ["state_1", "state_2", "state_3"], start="Start")
    return flow.state_flow([edges], source_rank=NODE_RANK, target_rank=NODE_RANK)


@query
def state_flow(spark: SparkSession, sf: str) -> DataFrame:
    return _order_flow(spark, sf, [])


@query
def state_flow_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return _order_flow(spark, sf, ["c_mktsegment"])


@query
def state_flow_text(spark: SparkSession, sf: str) -> DataFrame:
    return flow.with_flow_text(
        _order_flow(spark, sf, []),
        one_source=["F, 1", "O, 1", "P, 1"],
        one_target=["O, 2"],
    )


@query
def state_flow_by_rank_table(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes ranked by a table made from the orders: period, then the number of orders."""
    node = F.concat("o_orderstatus", F.lit(", "), "period")
    counts = (
        table(spark, sf, "orders")
        .withColumn("period", _period())
        .groupBy("period", node.alias("node"))
        .agg(F.count("*").alias("n"))
    )
    # One row per node.
    rank = F.row_number().over(Window.orderBy("period", F.desc("n"), "node"))
    ranks = dimensions.checked_dimension(counts.select("node", rank.alias("rank")), ["node"])
    return _order_flow(spark, sf, [], ranks)


@query
def study_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Enrolled, end of stay, 3-month and 12-month status of all orders, every record counted."""
    return _study_flow(spark, sf)


@query
def study_flow_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return _study_flow(spark, sf, "o_orderpriority")


def _study_flow(spark: SparkSession, sf: str, *by: str) -> DataFrame:
    cfg = dataclasses.replace(ICU_STUDY, event_col="event", by=by)
    stages = flow_stages(_order_entities(spark, sf), _followup(spark, sf, merge=False), cfg)
    edges = flow.state_flow(stages, source_rank=cfg.source_rank, target_rank=cfg.target_rank, by=by)
    return flow.with_flow_text(edges, one_source=cfg.one_source, one_target=cfg.one_target)


@query
def linked_state_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' order states before 1998 against those from 1998 on, all pairs counted."""
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    edges = flow.link_states(
        table(spark, sf, "orders"),
        id_cols=["o_custkey"],
        first=(early, F.col("o_orderstatus")),
        second=(~early, F.col("o_orderstatus")),
    )
    return flow.state_flow([edges])


# -- Columns, text and dates -------------------------------------------------------


@query
def drop_test_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Parts without the marker in their name, in any case; columns chosen by pattern."""
    parts = table(spark, sf, "part").withColumn("p_name", F.initcap("p_name"))
    kept = columns.drop_test_entities(parts, "p_name", marker="WIDGET")
    return kept.select(
        *columns.matching(kept, suffix=("key", "name"), any_of=["p_size"], pattern="brand")
    )


RECORD_ENDINGS = {"_complete": ("_complete", "_complete_yn"), "_date": ("_date", "_datecomp")}


@query
def landed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents landed as CSV and read through the import: quoted breaks and quotes, the text
    NA, empty fields, names with runs of underscores and several endings, dates as text."""
    number = F.col("doc_id") % 10
    text = F.when(number == 0, "NA").when(number == 1, "").when(number == 2, 'a "b", c')
    day = F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("doc_id") % 400).cast("int"))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc___id"),
        text.otherwise(F.concat("text", F.lit('\n"'), "source", F.lit('"'))).alias("note"),
        F.when(number != 3, F.col("lang")).alias("lang__complete_yn"),
        F.date_format(day, "y-M-d").alias("lang_datecomp"),
        F.lit("x").alias("spare"),
    )
    folder = f"{staging.shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    write_product(docs, f"{folder}/csv", FOLLOWUP_AS_OF, fmt="csv")
    landed = {"records": f"{folder}/csv/as_of={FOLLOWUP_AS_OF}"}
    records = load_inputs(spark, landed)["records"].drop("spare")
    records = columns.with_parsed_dates(
        columns.unify_endings(records, RECORD_ENDINGS), ["lang_date"]
    )
    write_product(records, f"{folder}/parquet", FOLLOWUP_AS_OF)
    return read_product(spark, f"{folder}/parquet", FOLLOWUP_AS_OF).select(
        F.col("doc_id").alias("id"), F.md5("note").alias("note_md5"), "lang_complete", "lang_date"
    )


@query
def text_merge_split(spark: SparkSession, sf: str) -> DataFrame:
    """Status and priority merged into one text, split again, and cut apart."""
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    label = reshape.merge_text([state, F.col("o_orderpriority")], sep=" and ")
    first, double = reshape.split_pair(F.col("label"), " and ")
    number = leading_integer(
        F.regexp_replace("o_orderpriority", "-", " ")
    )
    return (
        table(spark, sf, "orders")
        .select(label.alias("label"), number.alias("number"))
        .groupBy(
            "label",
            "number",
            first.alias("first_part"),
            double.alias("double_duty"),
            remove_first(F.col("label"), "[0-9]|-").alias("cut_once"),
        )
        .agg(F.count("*").alias("n"))
    )


@query
def text_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Missing values, counts and dates as text; the first match of a pattern replaced."""
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return (
        _orders(spark, sf)
        .groupBy(
            as_text(state).alias("state"),
            replace_first(F.col("o_orderpriority"), "[A-Z]|-", ", $1").alias("priority"),
        )
        .agg(
            thousands(F.count("*")).alias("n"),
            date_text(F.max("order_date")).alias("last_order"),
        )
    )


@query
def parsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates written as text in several forms and read back; unreadable text is null."""
    date, state = F.col("order_date"), F.col("o_orderstatus")
    padded, plain = F.date_format(date, "yyyy-MM-dd"), F.date_format(date, "y-M-d")
    text = F.when(state == "F", padded).when(state == "O", plain).otherwise(
        F.date_format(date, "MM/dd/yyyy")
    )
    stamp = F.when(state != "O", F.concat(padded, F.lit(" 09:30"))).otherwise(plain)
    parsed = _orders(spark, sf).select(
        "o_orderstatus",
        parse_date(text).alias("day"),
        F.to_date(parse_datetime(stamp)).alias("stamp_day"),
    )
    return parsed.groupBy(
        "o_orderstatus",
        *(date_parts(F.col("day"))[p].alias(p) for p in ("year", "month")),
    ).agg(
        F.count("*").alias("n"),
        F.count("day").alias("n_day"),
        F.count("stamp_day").alias("n_stamp"),
        F.min("stamp_day").alias("first_stamp"),
    )


@query
def reasons_unpivoted(spark: SparkSession, sf: str) -> DataFrame:
    """Reason boxes in long form, one row per checked box, counted with their share."""
    boxed = _lines_with_reasons(spark, sf)
    long = reshape.to_long(boxed, ["l_linestatus"], list(LINE_REASONS), "box", "checked")
    counts = long.groupBy("l_linestatus", "box").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("l_linestatus"))
    return counts.withColumn("share_text", percent_text(F.col("n") / total))
