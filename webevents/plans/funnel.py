"""Conversion funnel overall, by channel and by device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.functions.channels import channel5
from webevents.functions.ratios import pct, pct_nullif
from webevents.operators.funnel import event_is, funnel_counts
from webevents.operators.window import date_window
from webevents.plans.defaults import DEFAULT_END, DEFAULT_START

# --- fixed values: the funnel steps of the source, in order ---------------------------
FUNNEL_EVENTS = ["session_start", "view_item", "add_to_cart", "begin_checkout", "purchase"]
# --------------------------------------------------------------------------------------


def funnel_overall(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """One row -- distinct users per step and step-to-step rates."""
    steps = dict(zip(
        ["step_1_sessions", "step_2_view_item", "step_3_add_to_cart", "step_4_checkout", "step_5_purchase"],
        [event_is(e) for e in FUNNEL_EVENTS],
    ))
    counts = funnel_counts(date_window(events, start, end), steps)
    s1, s2, s3, s4, s5 = (F.col(c) for c in steps)
    return counts.select(
        *steps,
        pct_nullif(s2, s1, 1).alias("pct_to_view_item"),
        pct_nullif(s3, s2, 1).alias("pct_view_to_cart"),
        pct_nullif(s4, s3, 1).alias("pct_cart_to_checkout"),
        pct_nullif(s5, s4, 1).alias("pct_checkout_to_purchase"),
        pct(s5, s1, 2).alias("overall_conversion_rate_pct"),
    )


def funnel_by_channel(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """A10: per five-way channel of the event -- distinct users per step."""
    steps = dict(zip(
        ["sessions", "viewed_item", "added_to_cart", "started_checkout", "purchased"],
        [event_is(e) for e in FUNNEL_EVENTS],
    ))
    counts = funnel_counts(date_window(events, start, end), steps, {"channel": channel5()})
    return counts.select(
        "channel",
        *steps,
        pct_nullif("purchased", "sessions", 2).alias("end_to_end_cvr_pct"),
    ).orderBy(F.desc("sessions"), F.asc_nulls_first("channel"))


def funnel_by_device(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """Per device category -- session_start, add_to_cart and purchase users."""
    steps = {
        "sessions": event_is("session_start"),
        "add_to_cart": event_is("add_to_cart"),
        "purchases": event_is("purchase"),
    }
    counts = funnel_counts(
        date_window(events, start, end), steps, {"device_category": F.col("device.category")}
    )
    return counts.select(
        "device_category",
        *steps,
        pct_nullif("purchases", "sessions", 2).alias("conversion_rate_pct"),
    ).orderBy(F.desc("sessions"), F.asc_nulls_first("device_category"))
