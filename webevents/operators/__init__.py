"""DataFrame-level operators shared by the analyses."""

from webevents.operators.cohorts import cohort_activity
from webevents.operators.funnel import (
    did_step,
    event_is,
    funnel_counts,
    has_step,
    step_mask,
    step_masks,
    user_step_flags,
)
from webevents.operators.sessions import sessions
from webevents.operators.users import (
    first_touch,
    first_touch_label,
    first_touch_value,
    user_event_counts,
    user_value,
)
from webevents.operators.window import date_window, single_day

__all__ = [
    "cohort_activity",
    "date_window",
    "did_step",
    "event_is",
    "first_touch",
    "first_touch_label",
    "first_touch_value",
    "funnel_counts",
    "has_step",
    "sessions",
    "single_day",
    "step_mask",
    "step_masks",
    "user_event_counts",
    "user_step_flags",
    "user_value",
]
