"""Channel performance, top sources, new vs returning users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.functions.channels import channel5, channel7
from webevents.functions.dates import event_day
from webevents.functions.params import event_param
from webevents.functions.ratios import money_sum, money, pct, safe_pct, safe_ratio
from webevents.operators.sessions import sessions
from webevents.operators.window import date_window
from webevents.plans.defaults import DEFAULT_END, DEFAULT_START


def channel_performance(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, strict: bool = False
) -> DataFrame:
    """Session rows at grain (user, session, date, channel, source, medium,
    is_engaged), then per channel: sessions, users, conversions and rates.
    ``strict=True`` raises on a repeated parameter."""
    rows = sessions(
        date_window(events, start, end),
        {
            "user_pseudo_id": F.col("user_pseudo_id"),
            "session_id": event_param("ga_session_id", "int_value", strict),
            "session_date": event_day("event_date"),
            "source": F.col("traffic_source.source"),
            "medium": F.col("traffic_source.medium"),
            "is_engaged": event_param("session_engaged", "int_value", strict),
        },
    )
    # the channel is a function of (source, medium), both already in the grain, so it
    # is labelled once per session row instead of being a grouping key per event
    rows = rows.withColumn("channel", channel7("source", "medium"))
    total = F.count(F.lit(1))
    conversions = F.count_if("converted")
    revenue = money_sum("session_revenue")
    return (
        rows.groupBy("channel")
        .agg(
            total.alias("total_sessions"),
            F.count_distinct("user_pseudo_id").alias("unique_users"),
            conversions.alias("conversions"),
            pct(conversions, total, 2).alias("conversion_rate_pct"),
            money(revenue).alias("total_revenue"),
            safe_ratio(money(revenue), conversions, 2).alias("avg_order_value"),
            pct(F.count_if(F.col("is_engaged") == 1), total, 1).alias("engagement_rate_pct"),
        )
        .orderBy(F.desc("total_sessions"), F.asc_nulls_first("channel"))
    )


def top_sources(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, min_sessions: int = 50, n: int = 20,
    strict: bool = False,
) -> DataFrame:
    """Session rows at grain (user, session, source, medium), then per
    (source, medium) with at least ``min_sessions`` rows; the ``n`` best by
    conversion rate (source, medium break ties)."""
    rows = sessions(
        date_window(events, start, end),
        {
            "user_pseudo_id": F.col("user_pseudo_id"),
            "session_id": event_param("ga_session_id", "int_value", strict),
            "source": F.col("traffic_source.source"),
            "medium": F.col("traffic_source.medium"),
        },
    )
    total = F.count(F.lit(1))
    conversions = F.count_if("converted")
    return (
        rows.groupBy("source", "medium")
        .agg(
            total.alias("sessions"),
            F.count_distinct("user_pseudo_id").alias("unique_users"),
            conversions.alias("conversions"),
            safe_pct(conversions, total, 2).alias("conversion_rate_pct"),
            money(money_sum("session_revenue")).alias("revenue"),
        )
        .filter(F.col("sessions") >= min_sessions)
        .orderBy(
            F.desc_nulls_last("conversion_rate_pct"),
            F.asc_nulls_first("source"),
            F.asc_nulls_first("medium"),
        )
        .limit(n)
    )


def new_vs_returning(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, strict: bool = False
) -> DataFrame:
    """Per five-way channel -- first_visit events carrying a 'medium' parameter,
    distinct users, distinct purchasing users and their rate."""
    windowed = date_window(events, start, end)
    new_user_event = event_param("medium", "string_value", strict).isNotNull() & (F.col("event_name") == "first_visit")
    per_user = windowed.select(
        channel5().alias("channel"),
        "user_pseudo_id",
        new_user_event.alias("_new"),
        (F.col("event_name") == "purchase").alias("_purchase"),
    ).groupBy("channel", "user_pseudo_id").agg(
        F.count_if("_new").alias("_new_events"),
        F.bool_or("_purchase").alias("_purchased"),
    )
    total_users = F.count("user_pseudo_id")
    converting = F.count_if(F.col("user_pseudo_id").isNotNull() & F.col("_purchased"))
    return (
        per_user.groupBy("channel")
        .agg(
            F.sum("_new_events").alias("new_user_events"),
            total_users.alias("total_users"),
            converting.alias("converting_users"),
            pct(converting, total_users, 2).alias("user_conversion_rate_pct"),
        )
        .orderBy(F.desc("total_users"), F.asc_nulls_first("channel"))
    )


__all__ = ["channel_performance", "new_vs_returning", "top_sources"]
