"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from webevents.functions.channels import channel5, channel7
from webevents.functions.dates import days_between, event_day, week_of, weeks_between
from webevents.functions.params import event_param
from webevents.functions.ratios import (
    money,
    money_sum,
    pct,
    pct_nullif,
    rounded_money_sum,
    safe_pct,
    safe_ratio,
)
from webevents.functions.stages import funnel_stage

__all__ = [
    "channel5",
    "channel7",
    "days_between",
    "event_day",
    "event_param",
    "funnel_stage",
    "money",
    "money_sum",
    "pct",
    "pct_nullif",
    "rounded_money_sum",
    "safe_pct",
    "safe_ratio",
    "week_of",
    "weeks_between",
]
