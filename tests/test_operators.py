"""Shared operators on literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventrows import event, events_df
from webevents.functions import channel5
from webevents.functions.channels import CHANNEL5_LABELS
from webevents.operators import first_touch, first_touch_label, funnel_counts, user_event_counts
from webevents.operators.funnel import event_is


def test_first_touch_forms_agree_on_nulls_and_ties(spark):
    rows = [
        event(name="first_visit", user="a", ts=5, medium="cpc"),
        event(name="first_visit", user="a", ts=5, medium="organic"),  # tie: smaller label wins
        event(name="first_visit", user="b", ts=9, medium="organic"),
        event(name="first_visit", user="b", medium="(none)")[:1] + (None,)
        + event(name="first_visit", user="b", medium="(none)")[2:],  # NULL timestamp first
        event(name="page_view", user="c", ts=1, medium="cpc"),  # no first_visit
        event(name="first_visit", user=None, ts=3, medium="referral"),
    ]
    df = events_df(spark, rows)
    is_fv = event_is("first_visit")
    generic = {r["user_pseudo_id"]: r["ch"] for r in first_touch(df, is_fv, channel5(), name="ch").collect()}
    packed = {
        r["user_pseudo_id"]: r["ch"]
        for r in df.groupBy("user_pseudo_id")
        .agg(first_touch_label(is_fv, channel5(), CHANNEL5_LABELS).alias("ch"))
        .collect()
    }
    assert generic == {"a": "Organic Search", "b": "Direct", None: "Referral"}
    assert packed == {**generic, "c": None}


def test_user_event_counts_and_global_funnel(spark):
    rows = [
        event(name="purchase", user="a", date="20240103"),
        event(name="purchase", user="a", date="20240105"),
        event(name="view_item", user="b", date="20240102"),
        event(name="view_item", user=None, date="20240104"),
    ]
    df = events_df(spark, rows)
    counts = {r["user_pseudo_id"]: r for r in user_event_counts(df, {"buys": "purchase", "views": "view_item"}).collect()}
    assert counts["a"]["buys"] == 2 and str(counts["a"]["last_seen_date"]) == "2024-01-05"
    assert counts[None]["views"] == 1  # the NULL user is a group of its own
    funnel = funnel_counts(df, {"viewed": event_is("view_item"), "bought": event_is("purchase")}).first()
    assert (funnel["viewed"], funnel["bought"]) == (1, 1)
    empty = funnel_counts(df.filter(F.lit(False)), {"viewed": event_is("view_item")}).first()
    assert empty["viewed"] == 0  # a global funnel over no rows is one row of zeros
