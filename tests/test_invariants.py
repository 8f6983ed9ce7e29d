
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from webevents import plans
from webevents.functions import event_day, event_param
from webevents.operators import sessions
from webevents.sources.fixtures import FIXTURE_AS_OF, FIXTURE_END, FIXTURE_START, fixture_table

S, E = FIXTURE_START, FIXTURE_END


@pytest.fixture(scope="module")
def events(spark):
    return fixture_table(spark, SF01, S, E)


def test_stage_shares_cover_every_user(events):
    rows = plans.funnel_stage_dropoff(events, S, E, FIXTURE_AS_OF).collect()
    assert abs(sum(r.share_pct for r in rows) - 100) <= 0.5
    users = events.select("user_pseudo_id").distinct().count()  # NULL is one group
    assert sum(r.user_count for r in rows) == users


def test_week0_retention_is_full(events):
    rows = plans.retention_cohorts(events, S, E, min_cohort=1).collect()
    assert rows and all(r.w0_pct == 100.0 for r in rows)


def test_channel_sessions_sum_to_session_rows(events):
    rows = plans.channel_performance(events, S, E).collect()
    session_rows = sessions(
        events,
        {
            "user_pseudo_id": F.col("user_pseudo_id"),
            "session_id": event_param("ga_session_id", "int_value"),
            "session_date": event_day("event_date"),
            "source": F.col("traffic_source.source"),
            "medium": F.col("traffic_source.medium"),
            "is_engaged": event_param("session_engaged", "int_value"),
        },
    ).count()
    assert sum(r.total_sessions for r in rows) == session_rows


def test_channel_funnel_covers_overall(events):
    overall = plans.funnel_overall(events, S, E).first()
    by_channel = plans.funnel_by_channel(events, S, E).collect()
    assert sum(r.sessions for r in by_channel) >= overall.step_1_sessions
    assert sum(r.purchased for r in by_channel) >= overall.step_5_purchase
    assert max(r.sessions for r in by_channel) <= overall.step_1_sessions


def test_inventory_and_daily_totals_agree(events):
    inventory = {r.event_name: r.event_count for r in plans.event_inventory(events, S, E).collect()}
    daily = plans.daily_activity(events, S, E).collect()
    assert sum(inventory.values()) == sum(r.total_events for r in daily) == events.count()
    assert inventory.get("session_start", 0) == sum(r.sessions for r in daily)
    assert inventory.get("purchase", 0) == sum(r.purchases for r in daily)


def test_weekly_revenue_equals_session_revenue_total(events):
    weekly = sum(r.revenue or 0 for r in plans.weekly_growth(events, S, E).collect())
    channels = sum(r.total_revenue or 0 for r in plans.channel_performance(events, S, E).collect())
    # one rounds every week, the other every session row, to cents: half a cent each at most
    rounded = events.where("ecommerce.purchase_revenue IS NOT NULL").count() + 5
    assert abs(weekly - channels) <= 0.005 * rounded
