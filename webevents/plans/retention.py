"""Weekly visit-retention cohorts and purchase cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.functions.ratios import pct_nullif
from webevents.operators.cohorts import cohort_activity
from webevents.operators.funnel import event_is
from webevents.operators.window import date_window
from webevents.plans.defaults import DEFAULT_END, DEFAULT_START


def retention_cohorts(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, min_cohort: int = 20, weeks: int = 4
) -> DataFrame:
    """cohort = Monday week of a user's first session_start; active = any event.
    Per cohort week: cohort size and the share active in weeks 0..``weeks``."""
    activity = cohort_activity(date_window(events, start, end), anchor=event_is("session_start"))

    # (user, activity_week) is unique, so counting rows at an offset counts distinct
    # users; an offset nobody reached is NULL (as a MAX over no rows is), not 0
    def at(k: int):
        n = F.count_if(F.col("weeks_since") == k)
        return F.when(n > 0, n)

    size = at(0)
    return (
        activity.groupBy("cohort_week")
        .agg(
            size.alias("cohort_size"),
            *[pct_nullif(at(k), size, 1).alias(f"w{k}_pct") for k in range(weeks + 1)],
        )
        .filter(F.col("cohort_size") >= min_cohort)
        .orderBy("cohort_week")
    )


def purchase_cohorts(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, min_cohort: int = 10
) -> DataFrame:
    """cohort = Monday week of a user's first purchase; retained = purchased
    again 1 week, 2 weeks, or 1-4 weeks later. Every first purchaser counts in the
    cohort size, repeat buyer or not."""
    purchases = event_is("purchase")
    later = cohort_activity(
        date_window(events, start, end), anchor=purchases, activity=purchases
    )
    per_user = later.groupBy("user_pseudo_id", "cohort_week").agg(
        F.bool_or(F.col("weeks_since") == 1).alias("_w1"),
        F.bool_or(F.col("weeks_since") == 2).alias("_w2"),
        F.bool_or(F.col("weeks_since").between(1, 4)).alias("_m1"),
    )
    size = F.count(F.lit(1))
    w1, w2, m1 = F.count_if("_w1"), F.count_if("_w2"), F.count_if("_m1")
    return (
        per_user.groupBy(F.col("cohort_week").alias("first_purchase_week"))
        .agg(
            size.alias("cohort_size"),
            w1.alias("retained_w1"),
            pct_nullif(w1, size, 1).alias("w1_pct"),
            w2.alias("retained_w2"),
            pct_nullif(w2, size, 1).alias("w2_pct"),
            m1.alias("retained_month1"),
            pct_nullif(m1, size, 1).alias("month1_retention_pct"),
        )
        .filter(F.col("cohort_size") >= min_cohort)
        .orderBy("first_purchase_week")
    )
