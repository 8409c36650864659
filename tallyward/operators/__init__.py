"""Table operators: DataFrames in, DataFrames out."""

from tallyward.operators.battery import battery_completion
from tallyward.operators.charts import with_chart_order, with_completion_text, with_month_axis
from tallyward.operators.device import device_wear
from tallyward.operators.expected import expected_vs_observed
from tallyward.operators.flow import state_flow
from tallyward.operators.followup import (
    followup_instruments,
    followup_status,
    followup_totals,
    followup_windows,
)
from tallyward.operators.funnel import missing_date_report, screening_funnel
from tallyward.operators.reasons import reason_hierarchy, reason_share
from tallyward.operators.status import daily_status_timeline, terminal_status

__all__ = [
    "battery_completion", "daily_status_timeline", "device_wear", "expected_vs_observed",
    "followup_instruments", "followup_status", "followup_totals", "followup_windows",
    "missing_date_report", "reason_hierarchy", "reason_share", "screening_funnel", "state_flow",
    "terminal_status", "with_chart_order", "with_completion_text", "with_month_axis",
]
