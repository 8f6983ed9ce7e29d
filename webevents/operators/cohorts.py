"""Cohort activity -- each user's anchor week and the weeks they were active.

The source joins an anchor table (first week per user) to a de-duplicated activity
table on user with ``activity_week >= cohort_week`` (or ``>``). Here both come from a
single scan: events are reduced to distinct (user, week) rows that remember whether
the anchor event happened that week; the anchor is the minimum such week over a
window partitioned by user, and the offset is the week difference. The window only
sees (user, week) rows, so its per-user partition is bounded by the number of weeks
in the window even for a user holding a large share of all events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webevents.functions.dates import event_day, week_of, weeks_between

USER = "user_pseudo_id"


def cohort_activity(
    events: DataFrame,
    anchor: Column,
    activity: Column | None = None,
    user: str = USER,
) -> DataFrame:
    """Rows (user, cohort_week, activity_week, weeks_since) for non-NULL users.

    ``anchor``: events that define the cohort (first such week). ``activity``: events
    that count as activity (all events when None). The cohort
    week itself is offset 0; callers that want later weeks only filter on the offset.
    Users with no anchor event do not appear.
    """
    source = events if activity is None else events.filter(activity | anchor)
    weekly = (
        source.select(
            F.col(user).alias(user),
            week_of(event_day("event_date")).alias("activity_week"),
            anchor.alias("_anchor"),
            (activity if activity is not None else F.lit(True)).alias("_active"),
        )
        .filter(F.col(user).isNotNull())
        .groupBy(user, "activity_week")
        .agg(F.bool_or("_anchor").alias("_anchor"), F.bool_or("_active").alias("_active"))
    )
    by_user = Window.partitionBy(user)
    anchored = weekly.withColumn(
        "cohort_week", F.min(F.when(F.col("_anchor"), F.col("activity_week"))).over(by_user)
    ).filter(F.col("cohort_week").isNotNull() & F.col("_active"))
    return anchored.filter(F.col("activity_week") >= F.col("cohort_week")).select(
        user,
        "cohort_week",
        "activity_week",
        weeks_between("activity_week", "cohort_week").alias("weeks_since"),
    )

