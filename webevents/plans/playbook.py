"""Weekly growth, first-touch LTV by channel, funnel drop-off stages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webevents.functions.channels import CHANNEL5_LABELS, channel5
from webevents.functions.dates import days_between, event_day, week_of
from webevents.functions.ratios import money, money_sum, safe_pct, safe_ratio
from webevents.functions.stages import funnel_stage
from webevents.operators.funnel import event_is, has_step, step_mask
from webevents.operators.users import first_label, label_code, user_event_counts
from webevents.operators.window import date_window
from webevents.plans.defaults import DEFAULT_AS_OF, DEFAULT_END, DEFAULT_START

USER = "user_pseudo_id"


def weekly_growth(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """Per Monday week -- distinct users with session_start / first_visit /
    purchase, revenue, and week-over-week growth against the previous row."""
    mask = step_mask([event_is("session_start"), event_is("first_visit"), event_is("purchase")])
    weekly_user = (
        date_window(events, start, end)
        .select(
            week_of(event_day("event_date")).alias("week"),
            # events of none of the three kinds only add revenue: one NULL-user row
            # per week and task carries it instead of one row per user
            F.when(mask != 0, F.col(USER)).alias(USER),
            mask.alias("_mask"),
            F.col("ecommerce.purchase_revenue").alias("_rev"),
        )
        .groupBy("week", USER)
        .agg(F.bit_or("_mask").alias("_steps"), money_sum("_rev").alias("_rev"))
    )
    has_user = F.col(USER).isNotNull()
    weekly = weekly_user.groupBy("week").agg(
        F.count_if(has_user & has_step("_steps", 0)).alias("new_sessions"),
        F.count_if(has_user & has_step("_steps", 1)).alias("new_users"),
        F.count_if(has_user & has_step("_steps", 2)).alias("converting_users"),
        money(money_sum("_rev")).alias("revenue"),
    )
    # one row per week: an unpartitioned window over a result bounded by the
    # number of weeks in the window
    by_week = Window.orderBy("week")
    prev_users = F.lag("new_users").over(by_week)
    prev_revenue = F.lag("revenue").over(by_week)
    return weekly.select(
        "week",
        "new_sessions",
        "new_users",
        "converting_users",
        "revenue",
        safe_pct("converting_users", "new_users", 2).alias("user_cvr_pct"),
        safe_ratio("revenue", "converting_users", 2).alias("avg_revenue_per_converter"),
        prev_users.alias("prev_week_users"),
        F.round(F.try_divide(F.col("new_users") - prev_users, prev_users) * 100, 1).alias("user_growth_wow_pct"),
        prev_revenue.alias("prev_week_revenue"),
        F.round(F.try_divide(F.col("revenue") - prev_revenue, prev_revenue) * 100, 1).alias("revenue_growth_wow_pct"),
    ).orderBy("week")


def ltv_by_channel(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """Users with a first_visit in the window, by the five-way channel of their
    earliest first_visit; paying share, revenue per paying user, channel revenue.

    The source ranks first_visit events per user and LEFT JOINs per-user revenue.
    Both come from one per-user aggregate here (no join, one shuffle). The NULL user
    keeps its channel row but contributes no user and no revenue, as the unmatched
    join row does in the source.
    """
    code = label_code(event_is("first_visit"), channel5(), CHANNEL5_LABELS)
    per_user = (
        date_window(events, start, end)
        .select(
            USER, "event_timestamp", code.alias("_code"), event_is("purchase").alias("_bought"),
            F.col("ecommerce.purchase_revenue").alias("_revenue"),
        )
        # an event that is no first visit, no purchase and earns nothing adds nothing
        .filter(F.col("_code").isNotNull() | F.col("_bought") | F.col("_revenue").isNotNull())
        .groupBy(USER)
        .agg(
            first_label(F.col("_code"), CHANNEL5_LABELS).alias("first_channel"),
            F.count("_code").alias("_visits"),
            money(money_sum("_revenue")).alias("total_revenue"),
            F.count_if("_bought").alias("total_purchases"),
        )
        .filter(F.col("_visits") > 0)
    )
    has_user = F.col(USER).isNotNull()
    paying = F.count_if(has_user & (F.col("total_purchases") > 0))
    users = F.count(USER)
    channel_revenue = money_sum("_of_user")
    return (
        per_user.withColumn("_of_user", F.when(has_user, F.col("total_revenue")))
        .groupBy("first_channel")
        .agg(
            users.alias("total_users"),
            paying.alias("paying_users"),
            safe_pct(paying, users, 1).alias("paying_rate_pct"),
            safe_ratio(money(channel_revenue), F.nullif(paying, F.lit(0)), 2).alias("avg_ltv_proxy"),
            money(channel_revenue).alias("channel_total_revenue"),
        )
        .orderBy(F.desc_nulls_last("channel_total_revenue"), F.asc_nulls_first("first_channel"))
    )


def funnel_stage_dropoff(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, as_of: str = DEFAULT_AS_OF
) -> DataFrame:
    """Users by the deepest funnel stage they reached, with their share and the
    average days between their last activity and ``as_of`` ('YYYY-MM-DD')."""
    per_user = user_event_counts(
        date_window(events, start, end),
        {
            "sessions": "session_start",
            "item_views": "view_item",
            "cart_adds": "add_to_cart",
            "checkouts_started": "begin_checkout",
            "purchases": "purchase",
        },
    )
    as_of_date = F.lit(dt.date.fromisoformat(as_of))
    per_stage = per_user.groupBy(funnel_stage().alias("funnel_stage")).agg(
        F.count(F.lit(1)).alias("user_count"),
        F.avg(days_between(as_of_date, "last_seen_date")).alias("_avg_days"),
    )
    # a handful of stage rows: the unpartitioned total is a one-task window by design
    total = F.sum("user_count").over(Window.partitionBy())
    return per_stage.select(
        "funnel_stage",
        "user_count",
        F.round(F.col("user_count") / total * 100, 1).alias("share_pct"),
        F.round("_avg_days", 0).alias("avg_days_since_last_visit"),
    ).orderBy("funnel_stage")
