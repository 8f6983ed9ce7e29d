"""The sixteen analyses (A1-A16), each ``f(events, ...) -> DataFrame``."""

from webevents.plans.acquisition import channel_performance, new_vs_returning, top_sources
from webevents.plans.explore import (
    daily_activity,
    event_inventory,
    event_preview,
    page_view_params,
    session_conversion,
)
from webevents.plans.funnel import funnel_by_channel, funnel_by_device, funnel_overall
from webevents.plans.playbook import funnel_stage_dropoff, ltv_by_channel, weekly_growth
from webevents.plans.retention import purchase_cohorts, retention_cohorts

__all__ = [
    "channel_performance",
    "daily_activity",
    "event_inventory",
    "event_preview",
    "funnel_by_channel",
    "funnel_by_device",
    "funnel_overall",
    "funnel_stage_dropoff",
    "ltv_by_channel",
    "new_vs_returning",
    "page_view_params",
    "purchase_cohorts",
    "retention_cohorts",
    "session_conversion",
    "top_sources",
    "weekly_growth",
]
