"""The warehouse queries in plain SQL.

Joins, grids and unions are spelled out in the simplest way here; the operators reach
the same tables by counting first and joining less.
"""

from __future__ import annotations

from tallyward.plans.icu_study import ICU_STUDY

ORACLE: dict[str, str] = {}

def _month(col: str) -> str:
    return f"coalesce(strftime({col}, '%Y-%m'), 'NA-NA')"


def _label(col: str) -> str:
    return (
        f"CASE WHEN month({col}) = 3 THEN strftime({col}, '%b %Y') "
        f"ELSE strftime({col}, '%b') END"
    )


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def _pct_text(expr: str) -> str:
    return f"CAST(CAST(round_even(({expr}) * 100, 0) AS BIGINT) AS VARCHAR) || '%'"


# -- Screening ---------------------------------------------------------------------

_FLAGGED = """
flagged AS (
  SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d,
         true AS screened, o_orderstatus IN ('F', 'O') AS approached,
         o_orderstatus = 'O' AS refused, o_orderstatus = 'F' AS enrolled
  FROM orders)"""

_SUMS = ", ".join(
    f"CAST(sum(CAST({f} AS INT)) AS BIGINT) AS {{p}}{f}"
    for f in ("screened", "approached", "refused", "enrolled")
)
_AMONG = ", ".join(
    f"count(*) FILTER ({f} AND approached) AS approached_{f}" for f in ("refused", "enrolled")
)


def _monthly(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return (
        f"SELECT {lead}{_month('d')} AS myear, {_label('d')} AS myear_char, "
        f"{_SUMS.format(p='')}, {_AMONG} FROM flagged GROUP BY ALL"
    )


def _kpis(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return f"""
    SELECT {lead}n_screened, n_approached, n_refused, n_enrolled,
           n_approached / n_screened AS pct_approached,
           1 - n_approached / n_screened AS pct_excluded,
           approached_refused / n_approached AS pct_refused,
           approached_enrolled / n_approached AS pct_enrolled,
           CAST(312 AS BIGINT) AS n_goal,
           round_even(n_enrolled / CAST(312 AS DOUBLE) * 100, 0) AS pct_of_goal
    FROM (SELECT {lead}{_SUMS.format(p='n_')}, {_AMONG} FROM {source}{group})"""


ORACLE["screening_funnel_monthly"] = f"WITH {_FLAGGED} {_monthly()}"
ORACLE["screening_funnel_by_priority"] = f"WITH {_FLAGGED} {_monthly('o_orderpriority')}"
ORACLE["screening_kpis"] = f"WITH {_FLAGGED} {_kpis('flagged')}"
ORACLE["screening_kpis_by_priority"] = f"WITH {_FLAGGED} {_kpis('flagged', 'o_orderpriority')}"
ORACLE["screening_kpis_conditional"] = f"""
WITH flagged AS (
  SELECT true AS screened, o_orderpriority <> '1-URGENT' AS approached,
         o_orderstatus = 'O' AS refused, o_orderstatus = 'F' AS enrolled
  FROM orders)
{_kpis('flagged')}"""
ORACLE["screening_statement"] = f"""
WITH {_FLAGGED}, k AS ({_kpis('flagged')})
SELECT 'August 01, 2001' AS as_of_text,
    'We have screened ' || format('{{:,}}', n_screened) || ' patients; '
    || {_pct_text('pct_excluded')} || ' were excluded and '
    || {_pct_text('pct_approached')} || ' approached. Of those approached, '
    || {_pct_text('pct_refused')} || ' refused consent and '
    || {_pct_text('pct_enrolled')} || ' were enrolled.' AS statement
FROM k"""
ORACLE["screening_month_axis"] = f"""
WITH {_FLAGGED}, m AS ({_monthly()})
SELECT *, CAST(dense_rank() OVER (ORDER BY myear) AS INT) AS myear_num,
       dense_rank() OVER (ORDER BY myear) % 2 = 1 AS show_label
FROM m"""

_TWO = """
excluded AS (
  SELECT 'L' || CAST(l_orderkey AS VARCHAR) AS id,
         CASE WHEN l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS d,
         l_discount >= 0.08 AS refusal
  FROM lineitem WHERE l_returnflag = 'R'),
enrolled_rows AS (
  SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d
  FROM orders),
flagged AS (
  SELECT d, true AS screened, refusal AS approached, refusal AS refused, false AS enrolled
  FROM excluded WHERE d IS NOT NULL
  UNION ALL
  SELECT d, true, true, false, true FROM enrolled_rows)"""

ORACLE["screening_two_sources"] = f"WITH {_TWO} {_monthly()}"
ORACLE["screening_two_sources_dated"] = (
    f"WITH {_TWO}, dated AS (SELECT * FROM flagged WHERE d IS NOT NULL) {_kpis('dated')}"
)
_UNDATED = """
undated AS (
  SELECT id FROM excluded WHERE d IS NULL UNION SELECT id FROM enrolled_rows WHERE d IS NULL)"""
ORACLE["undated_ids"] = f"WITH {_TWO}, {_UNDATED} SELECT id FROM undated"


def _lines_of(ids: str, by: str = "") -> str:
    """Ids in sorted order as text lines of 1000 ids."""
    lead = f"{by}, " if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return f"""
    SELECT {lead}line, n_ids, string_agg(id, '; ' ORDER BY id) AS ids
    FROM (SELECT {lead}id, count(*) OVER ({over}) AS n_ids,
                 CAST((row_number() OVER ({over} ORDER BY id) - 1) // 1000 AS INT) AS line
          FROM {ids})
    GROUP BY {lead}line, n_ids"""


ORACLE["undated_ids_message"] = f"""
WITH {_TWO}, {_UNDATED}, t AS ({_lines_of('undated')})
SELECT *, 'These IDs have no exclusion/enrollment date entered and are not included: ' || ids
       AS message
FROM t"""
ORACLE["orders_without_lines"] = f"""
WITH missing AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS myear, CAST(o_orderkey AS VARCHAR) AS id
  FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
{_lines_of('missing', 'myear')}"""

# -- Reasons -----------------------------------------------------------------------

_BOXED = """
boxed AS (
  SELECT l_orderkey, l_linestatus, CAST(l_shipdate AS DATE) AS d,
         unnest([
           CASE WHEN l_discount >= 0.05 THEN 'Discount of 5% or more' END,
           CASE WHEN l_quantity > 40 THEN 'Quantity over 40' END,
           CASE WHEN l_returnflag = 'R' THEN 'Returned' END]) AS reason
  FROM lineitem),
checked AS (SELECT * FROM boxed WHERE reason IS NOT NULL)"""


def _share(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    using = f"({lead}myear)"
    return f"""
    WITH {_BOXED},
    n AS (SELECT {lead}{_month('d')} AS myear, {_label('d')} AS myear_char, reason,
                 count(*) AS n_this_exclusion
          FROM checked GROUP BY ALL),
    a AS (SELECT {lead}{_month('d')} AS myear, count(DISTINCT l_orderkey) AS n_all_exclusions
          FROM checked GROUP BY ALL)
    SELECT n.*, n_all_exclusions,
           round_even(n_this_exclusion / n_all_exclusions * 100, 0) AS percent
    FROM n JOIN a USING {using}"""


ORACLE["reason_share"] = _share()
ORACLE["reason_share_by_line_status"] = _share("l_linestatus")
_TOTALS = f"""
WITH {_BOXED},
totals AS (
  SELECT CASE reason WHEN 'Discount of 5% or more' THEN 'Price'
                     WHEN 'Quantity over 40' THEN 'Volume'
                     ELSE 'Other exclusions' END AS reason_type,
         reason, (SELECT count(*) FROM lineitem) AS n_patients_exc, count(*) AS n_reason
  FROM checked GROUP BY ALL)"""
ORACLE["reason_totals"] = f"{_TOTALS} SELECT * FROM totals"
ORACLE["reason_hierarchy"] = f"""{_TOTALS}
SELECT reason_type, reason, CAST(2 - grouping(reason_type) - grouping(reason) AS INT) AS level,
       CAST(sum(n_reason) AS BIGINT) AS n_reason
FROM totals GROUP BY ROLLUP (reason_type, reason)"""
ORACLE["status_priority_hierarchy"] = """
SELECT o_orderstatus, o_orderpriority,
       CAST(2 - grouping(o_orderstatus) - grouping(o_orderpriority) AS INT) AS level,
       count(*) AS n_orders
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"""
ORACLE["reasons_unpivoted"] = f"""
WITH b AS (
  SELECT l_linestatus, unnest([
    CASE WHEN l_discount >= 0.05 THEN 'discounted' END,
    CASE WHEN l_quantity > 40 THEN 'bulk' END,
    CASE WHEN l_returnflag = 'R' THEN 'returned' END]) AS box
  FROM lineitem),
c AS (SELECT l_linestatus, box, count(*) AS n FROM b WHERE box IS NOT NULL GROUP BY ALL)
SELECT *, {_pct_text('n / sum(n) OVER (PARTITION BY l_linestatus)')} AS share_text FROM c"""

# -- Status ------------------------------------------------------------------------


def _users(purchase: int, error: int, signup: int) -> str:
    return f"""
users AS (
  SELECT user_id, min(CAST(ts AS DATE)) AS start_date,
         min(CAST(ts AS DATE)) FILTER (event_type = 'purchase' AND value > {purchase})
           AS discharge_date,
         min(CAST(ts AS DATE)) FILTER (event_type = 'error' AND value > {error}) AS death_date,
         min(CAST(ts AS DATE)) FILTER (event_type = 'signup' AND value > {signup})
           AS withdrawal_date
  FROM events GROUP BY user_id)"""


_ENDED = f"""
WITH {_users(300, 300, 300)},
ended AS (
  SELECT *, CASE WHEN discharge_date IS NOT NULL THEN 'Discharged alive'
                 WHEN death_date IS NOT NULL THEN 'Died in hospital'
                 WHEN withdrawal_date IS NOT NULL THEN 'Withdrew in hospital'
                 ELSE 'Still in hospital' END AS status,
         CASE WHEN discharge_date IS NOT NULL THEN 1 WHEN death_date IS NOT NULL THEN 2
              WHEN withdrawal_date IS NOT NULL THEN 3 ELSE 4 END AS status_ord
  FROM users)"""
ORACLE["terminal_status_rows"] = f"{_ENDED} SELECT * FROM ended"
ORACLE["terminal_status_counts"] = f"""{_ENDED}
SELECT status, status_ord, count(*) AS n_status FROM ended GROUP BY ALL"""
ORACLE["still_open_ids"] = f"""{_ENDED},
still_in AS (
  SELECT CAST(user_id AS VARCHAR) AS id FROM ended WHERE status = 'Still in hospital'),
t AS ({_lines_of('still_in')})
SELECT * FROM t
UNION ALL
SELECT 0, 0, 'None' WHERE NOT EXISTS (SELECT 1 FROM still_in)"""

_TIMELINE = f"""
WITH {_users(100, 150, 150)},
grid AS (
  SELECT users.*, CAST(g.day AS INT) AS study_day,
         users.start_date + CAST(g.day - 1 AS INT) AS study_date
  FROM users, range(1, 30) AS g(day)),
timeline AS (
  SELECT *,
    CASE study_day WHEN 1 THEN 'Enrollment /Trial Day 1' WHEN 29 THEN 'Discharge Day'
         ELSE 'Trial Day ' || CAST(study_day AS VARCHAR) END AS event,
    CASE WHEN study_date >= death_date THEN 'Deceased'
         WHEN study_date >= discharge_date THEN 'Discharged'
         WHEN study_date >= withdrawal_date THEN 'Withdrawn'
         ELSE 'In hospital' END AS study_status,
    coalesce(study_date = death_date, false) OR coalesce(study_date = withdrawal_date, false)
      OR coalesce(study_date = discharge_date, false) AS transition_day
  FROM grid)"""
_TIMELINE_COUNTS = """
SELECT study_day, event, study_status, count(*) AS n,
       count(*) FILTER (transition_day) AS n_transition
FROM timeline {where} GROUP BY ALL"""
ORACLE["daily_status_timeline"] = f"{_TIMELINE} SELECT * FROM timeline"
ORACLE["daily_status_counts"] = _TIMELINE + _TIMELINE_COUNTS.format(where="")
ORACLE["daily_status_counts_as_of"] = _TIMELINE + _TIMELINE_COUNTS.format(
    where="WHERE study_date <= DATE '2024-01-20'"
)

# -- Expected visits ---------------------------------------------------------------


def _compliance(by: str = "", once: bool = False, as_of: str | None = None) -> str:
    lead = f"{by}, " if by else ""
    cut = f"AND study_date <= DATE '{as_of}'" if as_of else ""
    source = "observed"
    if once:
        source = """(SELECT id, event, max(over_ten) AS over_ten, max(taxed) AS taxed
                     FROM observed GROUP BY ALL)"""
    return f"""
    WITH stays AS (
      SELECT o_orderkey AS id, o_orderpriority, CAST(o_orderdate AS DATE) AS enroll_date,
             CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + 2 END AS death_date,
             CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) + 3 END
               AS discharge_date
      FROM orders),
    schedule(study_day, event, day, day_ord) AS (
      VALUES (1, 'Line 1', 'Day 1', 1), (3, 'Line 3', 'Day 3', 2),
             (5, 'Line 5', 'Day 5', 3), (29, 'Line 7', 'Discharge', 4)),
    grid AS (SELECT *, enroll_date + (study_day - 1) AS study_date FROM stays, schedule),
    expected AS (
      SELECT * FROM grid
      WHERE CASE WHEN study_day = 29
                 THEN coalesce(study_date < death_date, true)
                 ELSE (coalesce(study_date < death_date, true)
                       AND coalesce(study_date < discharge_date, true))
                      OR coalesce(study_date = death_date, false)
                      OR coalesce(study_date = discharge_date, false) END {cut}),
    observed AS (
      SELECT l_orderkey AS id, 'Line ' || CAST(l_linenumber AS VARCHAR) AS event,
             l_quantity - 10 AS over_ten, l_tax AS taxed
      FROM lineitem),
    rows AS (
      SELECT {lead}day, day_ord, o.over_ten, o.taxed
      FROM expected LEFT JOIN {source} o USING (id, event)),
    long AS (
      SELECT {lead}day, day_ord, 'purple' AS measure, over_ten AS drawn FROM rows
      UNION ALL SELECT {lead}day, day_ord, 'blue', taxed FROM rows),
    sums AS (
      SELECT {lead}day, day_ord, measure, count(*) AS n_expected,
             count(*) FILTER (drawn > 0) AS n_done
      FROM long WHERE NOT (measure = 'blue' AND day IN ('Day 3', 'Day 5')) GROUP BY ALL)
    SELECT *, n_done / n_expected AS compliance FROM sums"""


ORACLE["visit_compliance"] = f"""
SELECT *, day || ', ' || measure || ': ' || {_pct_text('compliance')} AS htext
FROM ({_compliance()})"""
ORACLE["visit_compliance_once_by_priority"] = _compliance(
    "o_orderpriority", once=True, as_of="1998-06-30"
)
ORACLE["timed_observations"] = """
WITH labelled AS (
  SELECT o_orderstatus AS event, o_totalprice,
         CASE WHEN o_orderstatus = 'F' THEN 'Enrollment/' ELSE '' END
         || CASE o_orderpriority WHEN '1-URGENT' THEN 'Day 5 and Discharge'
                                 WHEN '2-HIGH' THEN 'Day 3 only'
                                 WHEN '3-MEDIUM' THEN 'Day 1' ELSE '' END AS merged
  FROM orders),
cut AS (
  SELECT event, o_totalprice, regexp_replace(merged, 'Enrollment/| only', '') AS label
  FROM labelled WHERE merged <> ''),
rows AS (
  SELECT event, split_part(label, ' and ', 1) AS specimen_time, o_totalprice FROM cut
  UNION ALL
  SELECT 'Discharge Day', 'Discharge', o_totalprice FROM cut WHERE label LIKE '% and %')
SELECT event, specimen_time, count(*) AS n, max(o_totalprice) AS max_price
FROM rows GROUP BY ALL"""

# -- Device ------------------------------------------------------------------------

_DAYS = """
days AS (
  SELECT l_orderkey AS id, CASE WHEN l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS daily_date,
         l_returnflag <> 'R' AS worn, l_quantity AS removals, l_linestatus,
         CASE WHEN l_returnflag = 'R' THEN 'Permanent discontinuation' ELSE l_returnflag END
           AS why_1,
         CASE WHEN l_discount >= 0.05 THEN l_linestatus END AS why_2
  FROM lineitem)"""
_REMOVALS = f"""
WITH {_DAYS},
slots AS (
  SELECT id, daily_date, 'why_1' AS slot, why_1 AS reason FROM days
  UNION ALL SELECT id, daily_date, 'why_2', why_2 FROM days),
removed AS (
  SELECT DISTINCT s.*, CAST(o_orderdate AS DATE) AS hospdis_date,
    CASE WHEN reason = 'Permanent discontinuation'
          AND CAST(o_orderdate AS DATE) - daily_date BETWEEN 0 AND 59
         THEN 'Removed within a day of hospital discharge' ELSE reason END AS reason_mod
  FROM slots s JOIN orders ON o_orderkey = id AND o_orderstatus = 'F'
  WHERE reason IS NOT NULL)"""
ORACLE["removal_reasons"] = f"""{_REMOVALS}
SELECT reason_mod, count(*) AS n_events, count(DISTINCT id) AS n_entities
FROM removed GROUP BY reason_mod"""
ORACLE["permanent_removal_kpis"] = f"""{_REMOVALS},
k AS (
  SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_enrolled,
         count(*) FILTER (reason_mod = 'Permanent discontinuation') AS n_accel_permrm
  FROM removed)
SELECT *, round_even(n_accel_permrm / n_enrolled * 100, 0) AS pct_accel_permrm,
       CASE WHEN round_even(n_accel_permrm / n_enrolled * 100, 0) > 20 THEN 'bad'
            WHEN round_even(n_accel_permrm / n_enrolled * 100, 0) > 15 THEN 'warn'
            ELSE 'ok' END AS accel_permrm_alert
FROM k"""


def _wear(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""
    WITH {_DAYS},
    k AS (SELECT {lead}count(daily_date) AS n_hosp_days, count(*) FILTER (worn) AS n_accel_days,
                 count(*) FILTER (removals > 0) AS n_accel_rm
          FROM days GROUP BY ALL),
    p AS (SELECT *, round_even(n_accel_days / n_hosp_days * 100, 0) AS pct_accel_worn FROM k)
    SELECT *, CASE WHEN pct_accel_worn < 80 THEN 'warn' ELSE 'ok' END AS accel_worn_alert FROM p"""


ORACLE["device_wear_kpis"] = _wear()
_BOXES = "box, pct, alert, CAST(CAST(pct AS BIGINT) AS VARCHAR) || '%' AS value_text"
ORACLE["device_wear_kpis_by_status"] = _wear("l_linestatus")
ORACLE["reason_line_texts"] = f"""
SELECT myear, reason, coalesce(myear_char, 'NA') || ', ' || reason || ': '
       || CAST(CAST(percent AS BIGINT) AS VARCHAR) || '%' AS share_text
FROM ({ORACLE['reason_share']})"""
ORACLE["exclusions_title"] = """
SELECT 'Cumulative Exclusions (Total: ' || format('{:,}', count(*)) || ')' AS title FROM lineitem"""
ORACLE["screening_bar_texts"] = f"""
SELECT myear, coalesce(myear_char, 'NA') || ', Screened: ' || screened AS screened_text,
       coalesce(myear_char, 'NA') || ', Approached: ' || approached AS approached_text,
       coalesce(myear_char, 'NA') || ', Enrolled: ' || enrolled AS enrolled_text
FROM ({ORACLE['screening_two_sources']})"""
ORACLE["still_open_sentence"] = f"""
SELECT line, 'Patients currently in hospital: ' || ids AS sentence FROM ({ORACLE['still_open_ids']})"""
ORACLE["removal_histogram"] = f"""
WITH {_DAYS},
counts AS (
  SELECT CAST(removals AS BIGINT) AS bin, count(*) AS n FROM days
  WHERE daily_date IS NOT NULL AND removals > 0 GROUP BY ALL),
axis AS (SELECT range AS bin FROM range(1, 61))
SELECT bin, coalesce(n, 0) AS n FROM axis FULL JOIN counts USING (bin)"""

# -- Batteries ---------------------------------------------------------------------

_HAS = ", ".join(
    f"coalesce(bool_or(l_linenumber = {k}), false) AS line_{k}" for k in range(1, 8)
)
_PRESENCE = f"""
WITH present AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d, {_HAS}
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_orderpriority, o_orderdate),
flags AS (
  SELECT * REPLACE (CASE WHEN d < DATE '1998-01-01' THEN NULL ELSE line_7 END AS line_7)
  FROM present)"""
_FIRST_SIX = " AND ".join(f"line_{k}" for k in range(1, 7))
ORACLE["battery_completion"] = f"""{_PRESENCE},
b AS (
  SELECT 'all lines' AS battery,
         CASE WHEN d < DATE '1998-01-01' THEN {_FIRST_SIX} ELSE {_FIRST_SIX} AND line_7 END AS ok
  FROM flags
  UNION ALL SELECT 'first two', line_1 AND line_2 FROM flags),
s AS (SELECT battery, count(ok) AS n_elig, count(*) FILTER (ok) AS n_comp FROM b GROUP BY battery)
SELECT *, n_comp / n_elig AS prop_comp, round_even(n_comp / n_elig * 100, 0) AS pct_comp,
       CASE WHEN round_even(n_comp / n_elig * 100, 0) < 80 THEN 'warn' ELSE 'ok' END AS alert
FROM s"""
ORACLE["figure_boxes"] = f"""
SELECT {_BOXES} FROM (
  SELECT 'worn' AS box, pct_accel_worn AS pct, accel_worn_alert AS alert
  FROM ({ORACLE['device_wear_kpis']})
  UNION ALL SELECT battery, pct_comp, alert FROM ({ORACLE['battery_completion']}))"""

_BAND = (
    "CASE WHEN prop_comp > 0.90 THEN 'Excellent' WHEN prop_comp > 0.80 THEN 'Okay' "
    "ELSE 'Uh-oh' END"
)


def _instruments(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    long = " UNION ALL ".join(
        f"SELECT {lead}'line_{k}_comp_ph' AS instrument, 'LINE_{k}' AS stem, line_{k} AS ok "
        "FROM flags"
        for k in range(1, 8)
    )
    return f"""{_PRESENCE},
    s AS (SELECT {lead}instrument, CASE stem WHEN 'LINE_1' THEN 'General' ELSE stem END
                   AS asmt_type,
                 count(ok) AS n_elig, count(*) FILTER (ok) AS n_comp
          FROM ({long}) GROUP BY ALL),
    p AS (SELECT *, n_comp / n_elig AS prop_comp FROM s)
    SELECT *, CAST(row_number() OVER ({part} ORDER BY prop_comp DESC, instrument) AS INT)
             AS x_sorted,
           asmt_type || ': ' || {_pct_text('prop_comp')} AS htext, {_BAND} AS comp_ok
    FROM p"""


ORACLE["battery_instruments"] = _instruments()
ORACLE["battery_instruments_by_priority"] = _instruments("o_orderpriority")

ORACLE["completion_bands"] = f"""
WITH s AS (
  SELECT 'P' || l_partkey AS part, count(*) AS n_elig,
         count(*) FILTER (l_quantity > 7) AS n_comp
  FROM lineitem GROUP BY ALL),
p AS (SELECT *, n_comp / n_elig AS prop_comp FROM s),
r AS (SELECT *, round_even(prop_comp * 100, 0) AS pct FROM p)
SELECT part, n_elig, n_comp, prop_comp,
       part || ': ' || {_pct_text('prop_comp')} AS htext, {_BAND} AS comp_ok,
       CASE WHEN pct < 80 THEN 'warn' ELSE 'ok' END AS low,
       CASE WHEN 100 - pct > 20 THEN 'bad' WHEN 100 - pct > 15 THEN 'warn' ELSE 'ok' END AS high
FROM r"""

# -- Follow-up ---------------------------------------------------------------------

_PHONE, _FULL = (1, 2), (1, 3, 4, 5, 6, 7)
_FLAGS = ", ".join(f"r.line{k}" for k in range(1, 8))


def _n(lines: tuple[int, ...]) -> str:
    return " + ".join(f"coalesce(CAST(line{k} AS INT), 0)" for k in lines)


def _filled(k: int) -> str:
    kinds = []
    if k in _PHONE:
        kinds.append("phone_only")
    if k in _FULL:
        kinds.append("NOT phone_only")
    return (
        f"CASE WHEN line{k} IS NULL AND fu_elig AND ({' OR '.join(kinds)}) THEN false "
        f"ELSE line{k} END AS line{k}"
    )


def _followup(merge: bool = True) -> str:
    agg = (lambda fn, e: f"{fn}({e})") if merge else (lambda fn, e: e)
    group = "GROUP BY l.l_orderkey, v.visit" if merge else ""
    flags = ", ".join(
        agg("bool_or", f"CASE WHEN l_returnflag <> 'R' AND l_linenumber = {k} THEN true END")
        + f" AS line{k}"
        for k in range(1, 8)
    )
    dated = "CASE WHEN l_returnflag <> 'R' AND l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END"
    return f"""
WITH windows(fu_month, visit, enter_after, exit_after, phone_only) AS (
  VALUES (1, '1 Month Phone Call', 30, 14, true), (2, '2 Month Phone Call', 60, 14, true),
         (3, '3 Month Assessment', 83, 56, false), (6, '6 Month Phone Call', 180, 30, true),
         (12, '12 Month Assessment', 335, 90, false)),
base AS (
  SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS hospdis_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
              THEN CAST(o_orderdate AS DATE)
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW'
              THEN CAST(o_orderdate AS DATE) + 100 END AS death_date,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'
              THEN CAST(o_orderdate AS DATE) + 50 END AS studywd_date
  FROM orders),
entities AS (
  SELECT *, CASE WHEN hospdis_date IS NOT NULL THEN 'Discharged alive'
                 WHEN death_date IS NOT NULL THEN 'Died in hospital'
                 WHEN studywd_date IS NOT NULL THEN 'Withdrew in hospital'
                 ELSE 'Still in hospital' END AS inhosp_status
  FROM base),
records AS (
  SELECT l.l_orderkey, v.visit, {flags},
         {agg('bool_or', "l_returnflag = 'R'")} AS refused,
         {agg('min', dated)} AS first_asmt, {agg('max', dated)} AS last_asmt
  FROM lineitem l JOIN base b ON b.o_orderkey = l.l_orderkey
  JOIN windows v ON CAST(l_shipdate AS DATE) - b.d
                    BETWEEN v.enter_after AND v.enter_after + v.exit_after
  {group}),
joined AS (
  SELECT e.o_orderkey AS id, e.o_orderpriority, v.visit AS event,
         v.fu_month, v.phone_only, e.inhosp_status, e.death_date, e.studywd_date,
         e.hospdis_date + v.enter_after AS enter_window,
         e.hospdis_date + v.enter_after + v.exit_after AS exit_window,
         coalesce(r.refused, false) AS refused, r.first_asmt, r.last_asmt, {_FLAGS}
  FROM entities e CROSS JOIN windows v
  LEFT JOIN records r ON r.l_orderkey = e.o_orderkey AND r.visit = v.visit),
counted AS (
  SELECT *, enter_window <= DATE '2001-06-30' AS in_window,
         CASE WHEN phone_only THEN {_n(_PHONE)} END AS n_asmts_phone,
         CASE WHEN NOT phone_only THEN {_n(_FULL)} END AS n_asmts_full
  FROM joined),
judged AS (
  SELECT *, n_asmts_phone > 0 AS any_phone, n_asmts_full > 0 AS any_full,
         n_asmts_phone = 2 AS all_phone, n_asmts_full = 6 AS all_full,
    CASE WHEN n_asmts_phone > 0 OR n_asmts_full > 0
           THEN 'Assessment fully or partially completed'
         WHEN death_date IS NOT NULL
              AND (inhosp_status = 'Died in hospital' OR death_date < exit_window)
           THEN 'Died before follow-up window ended'
         WHEN studywd_date IS NOT NULL
              AND (inhosp_status = 'Withdrew in hospital' OR studywd_date < exit_window)
           THEN 'Withdrew before follow-up window ended'
         WHEN DATE '2001-06-30' < enter_window THEN 'Not yet eligible for follow-up'
         WHEN inhosp_status = 'Still in hospital' THEN NULL
         WHEN phone_only AND id IN (1, 2, 3, 4, 5, 6, 7)
           THEN 'Consent did not include phone assessment'
         WHEN refused THEN 'Refused assessment (but did not withdraw)'
         ELSE 'Eligible, but not yet assessed' END AS fu_status
  FROM counted),
eligible AS (
  SELECT *, coalesce(fu_status IN ('Assessment fully or partially completed',
                                   'Refused assessment (but did not withdraw)',
                                   'Eligible, but not yet assessed'), false) AS fu_elig
  FROM judged),
status AS (
  SELECT * REPLACE ({", ".join(_filled(k) for k in range(1, 8))}),
         CASE WHEN fu_elig THEN fu_status = 'Assessment fully or partially completed' END
           AS fu_comp,
         CASE fu_status WHEN 'Assessment fully or partially completed' THEN 1
                        WHEN 'Died before follow-up window ended' THEN 2
                        WHEN 'Withdrew before follow-up window ended' THEN 3
                        WHEN 'Not yet eligible for follow-up' THEN 4
                        WHEN 'Consent did not include phone assessment' THEN 5
                        WHEN 'Refused assessment (but did not withdraw)' THEN 6
                        WHEN 'Eligible, but not yet assessed' THEN 7 END AS fu_status_ord
  FROM eligible)"""


ORACLE["followup_windows"] = f"""{_followup()}
SELECT o_orderkey AS id, inhosp_status, visit AS event, phone_only,
       hospdis_date + enter_after AS enter_window,
       hospdis_date + enter_after + exit_after AS exit_window
FROM entities CROSS JOIN windows
WHERE visit IN (SELECT visit FROM records)"""
ORACLE["followup_rows"] = f"""{_followup()}
SELECT id, event, fu_month, enter_window, exit_window, in_window, n_asmts_phone,
       n_asmts_full, any_phone, any_full, all_phone, all_full, first_asmt, last_asmt, fu_status,
       fu_elig, fu_comp, line1 AS line1_complete, line7 AS line7_complete
FROM status"""
_COUNTS = """
SELECT event, fu_status, fu_status_ord, count(*) AS n FROM status GROUP BY ALL"""
ORACLE["followup_status_counts"] = _followup() + _COUNTS
ORACLE["followup_status_counts_all_records"] = _followup(merge=False) + _COUNTS


def _totals(by: str = "", merge: bool = True) -> str:
    lead = f"{by}, " if by else ""
    return f"""{_followup(merge)},
    t AS (SELECT {lead}event, count(*) AS n_elig,
                 count(*) FILTER (fu_comp) AS n_comp
          FROM status WHERE fu_elig GROUP BY ALL),
    p AS (SELECT *, n_comp / n_elig AS prop_comp FROM t),
    r AS (SELECT *, CAST(round_even(prop_comp, 2) AS DOUBLE) AS prop_rounded FROM p)
    SELECT *, {_pct_text('prop_rounded')} AS value_text,
           CASE WHEN prop_rounded < 0.9 THEN 'warn' ELSE 'ok' END AS alert
    FROM r"""


ORACLE["followup_totals"] = _totals()
ORACLE["followup_totals_by_priority"] = _totals("o_orderpriority")
ORACLE["followup_totals_all_records"] = _totals(merge=False)
_INSTRUMENTS_LONG = " UNION ALL ".join(
    f"SELECT event, fu_month, 'line{k}' AS instrument, line{k} AS done "
    f"FROM status WHERE fu_comp AND ({' OR '.join(kinds)})"
    for k, kinds in (
        (
            k,
            [t for t, lines in (("phone_only", _PHONE), ("NOT phone_only", _FULL)) if k in lines],
        )
        for k in range(1, 8)
    )
)
_INSTRUMENT_ROWS = f"""
t AS (SELECT event, fu_month, instrument, count(*) AS n_elig,
             count(*) FILTER (done) AS n_comp
      FROM ({_INSTRUMENTS_LONG}) GROUP BY ALL),
p AS (SELECT *, CASE instrument WHEN 'line1' THEN 'First' ELSE upper(instrument) END AS asmt_type,
             n_comp / n_elig AS prop_comp FROM t)
SELECT *, asmt_type || ': ' || {_pct_text('round_even(prop_comp, 2)')} AS htext,
       {_BAND} AS comp_ok,
       CAST(row_number() OVER (
         PARTITION BY event
         ORDER BY CASE WHEN fu_month IN (3, 12) THEN prop_comp END DESC, asmt_type) AS INT)
         AS x_sorted
FROM p"""
ORACLE["followup_instruments"] = f"{_followup()}, {_INSTRUMENT_ROWS}"
ORACLE["followup_instruments_all_records"] = f"{_followup(merge=False)}, {_INSTRUMENT_ROWS}"


def _by_group(sql: str) -> str:
    """The same, with the visits and windows that each priority has of its own."""
    grid = "FROM entities e CROSS JOIN windows v"
    assert grid in sql
    return sql.replace(grid, "FROM entities e JOIN group_windows v USING (o_orderpriority)").replace(
        "\nbase AS (",
        """
group_windows AS (
  SELECT o_orderpriority, fu_month, visit, phone_only, exit_after,
         enter_after + 5 * CAST(left(o_orderpriority, 1) AS INT) AS enter_after
  FROM (SELECT DISTINCT o_orderpriority FROM orders) CROSS JOIN windows
  WHERE fu_month <= 15 - 3 * CAST(left(o_orderpriority, 1) AS INT)),
base AS (""",
        1,
    )


ORACLE["followup_totals_group_windows"] = _by_group(_totals("o_orderpriority", merge=False))
ORACLE["followup_instruments_group_windows"] = _by_group(
    ORACLE["followup_instruments_all_records"]
    .replace("SELECT event, fu_month,", "SELECT o_orderpriority, event, fu_month,")
    .replace("PARTITION BY event", "PARTITION BY o_orderpriority, event")
)
ORACLE["followup_not_yet_text"] = f"""{_followup(merge=False)},
due AS (
  SELECT DISTINCT event, CAST(id AS VARCHAR) AS id FROM status
  WHERE fu_status = 'Eligible, but not yet assessed')
{_lines_of('due', 'event')}"""
ORACLE["followup_not_yet_assessed"] = f"""{_followup()}
SELECT id, event, enter_window, exit_window
FROM status WHERE fu_status = 'Eligible, but not yet assessed'"""
ORACLE["first_last_dates"] = """
SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_asmt,
       max(CAST(l_shipdate AS DATE)) AS last_asmt,
       CAST(count(DISTINCT l_linenumber) AS INT) AS n_dates
FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7 GROUP BY l_orderkey"""

# -- Flow --------------------------------------------------------------------------


def _flow(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    join = "JOIN customer ON c_custkey = o_custkey" if by else ""
    rank = "CASE {0} WHEN 'Start' THEN 0 " + " ".join(
        f"WHEN '{s}, {k}' THEN {3 * k + i}" for k in (1, 2, 3) for i, s in enumerate("FOP")
    ) + " END"
    return f"""
WITH nth AS (
  SELECT *, CASE WHEN year(o_orderdate) < 1997 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2
                 ELSE 3 END AS n
  FROM orders),
steps AS (
  SELECT {lead}CASE WHEN b.n = 1 THEN 'Start' ELSE a.o_orderstatus || ', ' || a.n END AS source,
         b.o_orderstatus || ', ' || b.n AS target
  FROM nth b LEFT JOIN nth a ON a.o_custkey = b.o_custkey AND a.n = b.n - 1
  {join.replace('o_custkey', 'b.o_custkey')}),
edges AS (SELECT {lead}source, target, count(*) AS weight FROM steps GROUP BY ALL),
flow AS (
  SELECT *, {_big(f'sum(weight) OVER (PARTITION BY {lead}source)')} AS source_total,
         {_big(f'sum(weight) OVER (PARTITION BY {lead}target)')} AS target_total,
         CAST({rank.format('source')} AS INT) AS source_rank,
         CAST({rank.format('target')} AS INT) AS target_rank
  FROM edges)"""


_OF_SOURCE = (
    f"{_pct_text('weight / source_total')} || ' of ' || source_total || ' ' || lower(source)"
)
_OF_TARGET = (
    f"{_pct_text('weight / target_total')} || ' of ' || target_total || ' ' || lower(target)"
)
ORACLE["state_flow"] = f"{_flow()} SELECT * FROM flow"
ORACLE["state_flow_by_segment"] = f"{_flow('c_mktsegment')} SELECT * FROM flow"
ORACLE["state_flow_text"] = f"""{_flow()}
SELECT *, '<b>' || source || ' -> ' || target || ':</b><br>N = ' || weight || '<br>'
  || CASE WHEN target IN ('F, 1', 'O, 1', 'P, 1') THEN {_OF_SOURCE}
          WHEN source IN ('O, 2') THEN {_OF_TARGET}
          ELSE {_OF_SOURCE} || '<br>' || {_OF_TARGET} END AS flow_text
FROM flow"""
_RANK = "CASE {0} WHEN 'Start' THEN 0 " + " ".join(
    f"WHEN '{s}, {k}' THEN {3 * k + i}" for k in (1, 2, 3) for i, s in enumerate("FOP")
) + " END"
ORACLE["state_paths"] = f"""
WITH nth AS (
  SELECT *, CASE WHEN year(o_orderdate) < 1997 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2
                 ELSE 3 END AS n
  FROM orders),
ends AS (
  SELECT o_custkey, n, o_orderstatus || ', ' || n AS state FROM nth
  QUALIFY row_number() OVER (PARTITION BY o_custkey, n ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
steps AS (
  SELECT 'Start' AS source, state AS target FROM ends WHERE n = 1
  UNION ALL
  SELECT a.state, b.state FROM ends a JOIN ends b ON a.o_custkey = b.o_custkey AND a.n = b.n - 1
  WHERE a.n = 1 OR EXISTS (SELECT 1 FROM ends c WHERE c.o_custkey = a.o_custkey AND c.n = 1)),
edges AS (SELECT source, target, count(*) AS weight FROM steps GROUP BY ALL)
SELECT *, {_big('sum(weight) OVER (PARTITION BY source)')} AS source_total,
       {_big('sum(weight) OVER (PARTITION BY target)')} AS target_total,
       CAST({_RANK.format('source')} AS INT) AS source_rank,
       CAST({_RANK.format('target')} AS INT) AS target_rank
FROM edges"""


def _study_flow(by: str = "") -> str:
    """Three stages in plain joins over every record of the follow-up."""
    lead = f"{by}, " if by else ""
    nodes = """CASE fu_status WHEN 'Died before follow-up window ended' THEN 'Died'
        WHEN 'Withdrew before follow-up window ended' THEN 'Withdrew'
        WHEN 'Assessment fully or partially completed' THEN 'Assessed'
        WHEN 'Eligible, but not yet assessed' THEN 'Not assessed'
        WHEN 'Refused assessment (but did not withdraw)' THEN 'Not assessed'
        WHEN 'Not yet eligible for follow-up' THEN 'Not yet eligible' END"""
    stay = """CASE inhosp_status WHEN 'Discharged alive' THEN 'Discharged'
        WHEN 'Died in hospital' THEN 'Died, hospital'
        WHEN 'Withdrew in hospital' THEN 'Withdrew, hospital'
        WHEN 'Still in hospital' THEN 'Hospitalized' END"""

    def rank(col: str, names: str) -> str:
        listed = names.split("; ")
        return "CASE " + col + " " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(listed)) + " END"

    sources = (
        "Enrolled; Discharged; Withdrew, hospital; Died, hospital; Assessed, 3m; Not assessed, 3m; "
        "Not yet eligible, 3m; Withdrew, 3m; Died, 3m"
    )
    targets = (
        "Hospitalized; Discharged; Withdrew, hospital; Died, hospital; Assessed, 3m; Not assessed, 3m; "
        "Not yet eligible, 3m; Withdrew, 3m; Died, 3m; Assessed, 12m; Not assessed, 12m; "
        "Not yet eligible, 12m; Withdrew, 12m; Died, 12m"
    )
    return f"""{_followup(merge=False)},
early AS (
  SELECT {lead}id, {stay} AS stay,
         CASE WHEN inhosp_status = 'Died in hospital'
                OR fu_status = 'Died before follow-up window ended' THEN 'Died, 3m'
              WHEN inhosp_status = 'Withdrew in hospital' THEN 'Withdrew, 3m'
              ELSE coalesce({nodes} || ', 3m', 'Missing') END AS node
  FROM status WHERE event = '3 Month Assessment' AND inhosp_status <> 'Still in hospital'),
late AS (
  SELECT {lead}id, coalesce({nodes} || ', 12m', 'Missing') AS node
  FROM status WHERE event = '12 Month Assessment' AND inhosp_status <> 'Still in hospital'),
steps AS (
  SELECT {lead}'Enrolled' AS source, {stay} AS target FROM entities
  UNION ALL SELECT {lead}stay, node FROM early
  UNION ALL SELECT {'late.' + lead if lead else ''}early.node, late.node FROM late LEFT JOIN early USING (id)),
edges AS (SELECT {lead}source, target, count(*) AS weight FROM steps GROUP BY ALL),
flow AS (
  SELECT *, {_big(f'sum(weight) OVER (PARTITION BY {lead}source)')} AS source_total,
         {_big(f'sum(weight) OVER (PARTITION BY {lead}target)')} AS target_total,
         CAST({rank('source', sources)} AS INT) AS source_rank,
         CAST({rank('target', targets)} AS INT) AS target_rank
  FROM edges)
SELECT *, '<b>' || source || ' -> ' || target || ':</b><br>N = ' || weight || '<br>'
  || CASE WHEN target IN ({_in(ICU_STUDY.one_source)}) THEN {_OF_SOURCE}
          WHEN source IN ({_in(ICU_STUDY.one_target)}) THEN {_OF_TARGET}
          ELSE {_OF_SOURCE} || '<br>' || {_OF_TARGET} END AS flow_text
FROM flow"""


def _in(names) -> str:
    return ", ".join(f"'{n}'" for n in names) or "NULL"


ORACLE["study_flow"] = _study_flow()
ORACLE["study_flow_by_priority"] = _study_flow("o_orderpriority")
ORACLE["linked_state_flow"] = """
WITH edges AS (
  SELECT a.o_orderstatus AS source, b.o_orderstatus AS target, count(*) AS weight
  FROM (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') b
  LEFT JOIN (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01') a
    ON a.o_custkey = b.o_custkey
  GROUP BY ALL)
SELECT *, CAST(sum(weight) OVER (PARTITION BY source) AS BIGINT) AS source_total,
       CAST(sum(weight) OVER (PARTITION BY target) AS BIGINT) AS target_total,
       CAST(NULL AS INT) AS source_rank, CAST(NULL AS INT) AS target_rank
FROM edges"""

# -- Columns, text and dates -------------------------------------------------------

ORACLE["drop_test_entities"] = """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS p_name, p_brand, p_size
FROM part WHERE p_name NOT ILIKE '%widget%'"""
ORACLE["text_merge_split"] = """
WITH m AS (
  SELECT o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                               ELSE o_orderstatus || ' and ' || o_orderpriority END AS label
  FROM orders)
SELECT label, CAST(left(o_orderpriority, 1) AS INT) AS number,
       CASE WHEN label LIKE '% and %' THEN left(label, 1) ELSE label END AS first_part,
       label LIKE '% and %' AS double_duty,
       regexp_replace(label, '[0-9]|-', '') AS cut_once, count(*) AS n
FROM m GROUP BY ALL"""
ORACLE["text_forms"] = """
SELECT CASE o_orderstatus WHEN 'P' THEN 'NA' ELSE o_orderstatus END AS state,
       left(o_orderpriority, 1) || ', $1' || substr(o_orderpriority, 3) AS priority,
       format('{:,}', count(*)) AS n, strftime(max(o_orderdate), '%B %d, %Y') AS last_order
FROM orders GROUP BY ALL"""
ORACLE["parsed_dates"] = """
WITH p AS (
  SELECT o_orderstatus,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS day,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN CAST(o_orderdate AS DATE) END AS stamp_day
  FROM orders)
SELECT o_orderstatus, strftime(day, '%Y') AS year, strftime(day, '%m') AS month, count(*) AS n,
       count(day) AS n_day, count(stamp_day) AS n_stamp, min(stamp_day) AS first_stamp
FROM p GROUP BY ALL"""
ORACLE["landed_records"] = """
SELECT CAST(doc_id AS VARCHAR) AS id,
       md5(CASE doc_id % 10 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN 'a "b", c'
           ELSE text || chr(10) || '"' || source || '"' END) AS note_md5,
       CASE WHEN doc_id % 10 <> 3 THEN lang END AS lang_complete,
       DATE '2018-01-01' + CAST(doc_id % 400 AS INT) AS lang_date
FROM documents"""

# -- Dimensions given as tables ----------------------------------------------------

_NATIONS = """
dim AS (
  SELECT n_nationkey AS code, n_name AS reason,
         CASE WHEN r_name <> 'ASIA' THEN r_name END AS reason_type
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey)"""
ORACLE["coded_reason_hierarchy"] = f"""
WITH {_NATIONS},
totals AS (
  SELECT coalesce(reason_type, 'Other exclusions') AS reason_type, reason, count(*) AS n_reason
  FROM customer LEFT JOIN dim ON code = c_nationkey GROUP BY ALL)
SELECT reason_type, reason, CAST(2 - grouping(reason_type) - grouping(reason) AS INT) AS level,
       CAST(sum(n_reason) AS BIGINT) AS n_reason
FROM totals GROUP BY ROLLUP (reason_type, reason)"""
ORACLE["unmatched_reason_codes"] = f"""
WITH {_NATIONS}
SELECT c_mktsegment, c_nationkey, count(*) AS n_rows FROM customer
WHERE c_nationkey NOT IN (SELECT code FROM dim WHERE reason_type IS NOT NULL) GROUP BY ALL"""
ORACLE["reason_share_by_table"] = f"""
WITH {_BOXED},
dim AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'Discount of 5% or more' ELSE 'Quantity over 40' END AS box,
         o_orderstatus || ' of ' || format('{{:,}}', count(*)) AS reason
  FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_orderstatus),
n AS (SELECT {_month('d')} AS myear, {_label('d')} AS myear_char, dim.reason,
             count(*) AS n_this_exclusion
      FROM checked LEFT JOIN dim ON box = checked.reason GROUP BY ALL),
a AS (SELECT {_month('d')} AS myear, count(DISTINCT l_orderkey) AS n_all_exclusions
      FROM checked GROUP BY ALL)
SELECT n.*, n_all_exclusions, round_even(n_this_exclusion / n_all_exclusions * 100, 0) AS percent
FROM n JOIN a USING (myear)"""
ORACLE["state_flow_by_rank_table"] = f"""{_flow()},
nodes AS (
  SELECT period, o_orderstatus || ', ' || period AS node, count(*) AS n
  FROM (SELECT o_orderstatus, CASE WHEN year(o_orderdate) < 1997 THEN 1
               WHEN year(o_orderdate) < 2000 THEN 2 ELSE 3 END AS period FROM orders)
  GROUP BY ALL),
ranks AS (
  SELECT node, CAST(row_number() OVER (ORDER BY period, n DESC, node) AS INT) AS rank FROM nodes)
SELECT flow.* EXCLUDE (source_rank, target_rank), s.rank AS source_rank, t.rank AS target_rank
FROM flow LEFT JOIN ranks s ON s.node = source LEFT JOIN ranks t ON t.node = target"""
