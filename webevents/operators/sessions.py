"""O3: session roll-up.

One output row per distinct combination of the caller's keys (which must include
``session_id``); rows without a session id are dropped before grouping. The grain is
whatever keys the caller passes -- it is not "one row per session" when a key such as
``is_engaged`` varies inside a session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.functions.ratios import rounded_money_sum


def sessions(events: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Group events by ``keys`` (name -> expression) into session rows with
    events_in_session, converted (a purchase happened) and session_revenue."""
    if "session_id" not in keys:
        raise ValueError("session keys must include 'session_id'")
    projected = events.select(
        *[expr.alias(name) for name, expr in keys.items()],
        F.col("event_name"),
        F.col("ecommerce.purchase_revenue").alias("_revenue"),
    ).filter(F.col("session_id").isNotNull())
    return projected.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events_in_session"),
        (F.count_if(F.col("event_name") == "purchase") > 0).alias("converted"),
        rounded_money_sum("_revenue").alias("session_revenue"),
    )
