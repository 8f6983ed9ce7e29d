"""A1-A5: schema exploration, event inventory, daily activity, session conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.functions.dates import event_day
from webevents.functions.params import event_param
from webevents.operators.sessions import sessions
from webevents.operators.window import date_window, single_day
from webevents.plans.defaults import DEFAULT_DAY, DEFAULT_END, DEFAULT_START

def _preview_columns() -> list:
    return [
        F.col("event_date"),
        F.col("event_timestamp"),
        F.col("event_name"),
        F.col("user_pseudo_id"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        F.col("traffic_source.name").alias("traffic_campaign"),
        F.col("geo.country").alias("country"),
        F.col("geo.city").alias("city"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("os"),
        F.col("event_params"),
    ]


def event_preview(events: DataFrame, day: str = DEFAULT_DAY, n: int | None = 10, ordered: bool = False) -> DataFrame:
    """A1: ``n`` raw events of one day shard with their nested fields flattened.

    Any ``n`` rows, as in the source: the read stops as soon as it has them. ``ordered=True``
    reads the whole day for a reproducible preview, the smallest rows over all columns
    (the parameters as JSON text). ``n=None``: every row of the day.
    """
    rows = single_day(events, day).select(*_preview_columns())
    if ordered:
        params = F.to_json("event_params", {"ignoreNullFields": "false"})
        rows = rows.orderBy(*[F.asc_nulls_first(c) for c in rows.columns if c != "event_params"], params.asc_nulls_first())
    return rows if n is None else rows.limit(n)


def page_view_params(
    events: DataFrame, day: str = DEFAULT_DAY, n: int | None = 20, ordered: bool = False, strict: bool = False
) -> DataFrame:
    """A2: page_view events of one day with three parameters pulled out of the array; any
    ``n`` of them (``None``: all), or with ``ordered=True`` the smallest. ``strict=True`` raises on a
    repeated parameter."""
    rows = (
        single_day(events, day)
        .filter(F.col("event_name") == "page_view")
        .select(
            "event_timestamp",
            "event_date",
            "event_name",
            "user_pseudo_id",
            event_param("page_location", "string_value", strict).alias("page_location"),
            event_param("ga_session_id", "int_value", strict).alias("session_id"),
            event_param("engagement_time_msec", "int_value", strict).alias("engagement_time_msec"),
        )
    )
    if ordered:
        rows = rows.orderBy(*[F.asc_nulls_first(c) for c in rows.columns])
    rows = rows if n is None else rows.limit(n)
    return rows.drop("event_timestamp")


def event_inventory(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """A3: per event name -- events, distinct users, first and last date."""
    day = event_day("event_date")
    return (
        date_window(events, start, end)
        .groupBy("event_name")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("user_pseudo_id").alias("unique_users"),
            F.min(day).alias("first_seen"),
            F.max(day).alias("last_seen"),
        )
        .orderBy(F.desc("event_count"), F.asc_nulls_first("event_name"))
    )


def daily_activity(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END
) -> DataFrame:
    """A4: per date -- events, active users, session_start events, purchase events."""
    # grouped on the raw text and parsed once per group: every distinct value is still
    # parsed (malformed text still raises), but not once per event
    return (
        date_window(events, start, end)
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_distinct("user_pseudo_id").alias("daily_active_users"),
            F.count_if(F.col("event_name") == "session_start").alias("sessions"),
            F.count_if(F.col("event_name") == "purchase").alias("purchases"),
        )
        .select(event_day("event_date").alias("date"), "total_events", "daily_active_users", "sessions", "purchases")
        .orderBy("date")
    )


def session_conversion(
    events: DataFrame, start: str = DEFAULT_START, end: str = DEFAULT_END, n: int = 100, strict: bool = False
) -> DataFrame:
    """A5: sessions (user, session id, date, source, medium, device, country) with
    event count, conversion flag and revenue; the first ``n`` by date, then revenue
    descending (remaining keys break ties). Top-n plans as TakeOrderedAndProject. ``strict=True``
    raises on a repeated parameter."""
    rows = sessions(
        date_window(events, start, end),
        {
            "user_pseudo_id": F.col("user_pseudo_id"),
            "session_id": event_param("ga_session_id", "int_value", strict),
            "session_date": F.col("event_date"),  # parsed per session row below
            "source": F.col("traffic_source.source"),
            "medium": F.col("traffic_source.medium"),
            # the category, under a new name: grouping by the struct column 'device'
            # would split sessions by operating system
            "device": F.col("device.category"),
            "country": F.col("geo.country"),
        },
    )
    rows = rows.withColumn("session_date", event_day("session_date"))
    return rows.orderBy(
        F.asc_nulls_first("session_date"),
        F.desc_nulls_last("session_revenue"),
        *[F.asc_nulls_first(c) for c in ("user_pseudo_id", "session_id", "source", "medium", "device", "country")],
        F.asc_nulls_first("events_in_session"),
        F.asc_nulls_first("converted"),
    ).limit(n)
