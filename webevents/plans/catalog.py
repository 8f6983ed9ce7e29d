"""Registry: every analysis as a callable ``(spark, sf_dir) -> DataFrame`` over the
driver's test tables, with the fixture windows as parameters.

Each callable reads the nested day-sharded table that Spark derives from the
driver's ``events``/``customer``/``nation`` (written once per input into the shared
checkpoint folder, see ``nested_event_batches``), so every analysis runs over the
whole input through the same read path as production data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webevents.operators.user_bitmaps import (
    activity_of_bitmaps,
    day_bitmaps,
    inventory_of_bitmaps,
    number_users,
    read_bitmaps,
    write_bitmaps,
)
from webevents.operators.users import user_value
from webevents.plans import acquisition, explore, funnel, playbook, retention
from webevents.sources.fixtures import (
    FIXTURE_AS_OF,
    FIXTURE_DAY,
    FIXTURE_END,
    FIXTURE_START,
    derived_once,
    fixture_table,
    nested_event_batches,
)

Query = Callable[[SparkSession, str], DataFrame]


def _window_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_table(spark, sf_dir, FIXTURE_START, FIXTURE_END)


def _day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_table(spark, sf_dir, FIXTURE_DAY, FIXTURE_DAY)


def _windowed(analysis: Callable[..., DataFrame], **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return analysis(_window_events(spark, sf_dir), FIXTURE_START, FIXTURE_END, **params)

    run.__name__ = analysis.__name__
    run.__doc__ = analysis.__doc__
    return run


def event_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 as registered for comparison: the parameter array is carried as JSON text
    (all fields, NULLs included) so that an SQL engine can state the same value."""
    rows = explore.event_preview(_day_events(spark, sf_dir), FIXTURE_DAY, ordered=True)
    return rows.withColumn(
        "event_params", F.to_json("event_params", {"ignoreNullFields": "false"})
    )


def page_view_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.page_view_params(_day_events(spark, sf_dir), FIXTURE_DAY, ordered=True)


def _any_rows(preview: DataFrame, day: DataFrame) -> DataFrame:
    """How many rows an un-ordered preview has, and how many of them are rows of the day: what every
    choice of rows must satisfy, whichever the read finds first."""
    def hashed(rows: DataFrame) -> DataFrame:
        text = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
        return rows.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))

    there = hashed(day).distinct().withColumn("there", F.lit(True))
    return hashed(preview).join(there, ["h1", "h2"], "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("there").alias("n_rows_of_the_day")
    )


def event_preview_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 as written, any rows: checked by count and membership."""
    day = _day_events(spark, sf_dir)
    whole = explore.event_preview(day, FIXTURE_DAY, n=None)
    return _any_rows(explore.event_preview(day, FIXTURE_DAY), whole)


def page_view_params_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 as written, any rows: checked by count and membership."""
    day = _day_events(spark, sf_dir)
    whole = explore.page_view_params(day, FIXTURE_DAY, n=None)
    return _any_rows(explore.page_view_params(day, FIXTURE_DAY), whole)


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day bitmaps of the derived table, written once per state of its batches."""
    folder, batches = nested_event_batches(spark, sf_dir, FIXTURE_START, FIXTURE_END)

    def write(path: str) -> None:
        events = _window_events(spark, sf_dir)
        write_bitmaps(day_bitmaps(events, number_users(events, f"{path}/numbers")), f"{path}/days")

    path = derived_once(spark, f"{folder}/user-bitmaps/{'-'.join(batches)}", write)
    return read_bitmaps(spark, f"{path}/days")


def event_inventory_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 from day bitmaps of numbered users."""
    return inventory_of_bitmaps(_bitmaps(spark, sf_dir), FIXTURE_START, FIXTURE_END)


def daily_activity_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 from day bitmaps of numbered users."""
    return activity_of_bitmaps(_bitmaps(spark, sf_dir), FIXTURE_START, FIXTURE_END)


def user_value_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, active days and purchases of every user."""
    return user_value(_window_events(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "event_preview": event_preview,
    "page_view_params": page_view_params,
    "event_preview_any": event_preview_any,
    "page_view_params_any": page_view_params_any,
    "event_inventory": _windowed(explore.event_inventory),
    "daily_activity": _windowed(explore.daily_activity),
    "event_inventory_bitmaps": event_inventory_bitmaps,
    "daily_activity_bitmaps": daily_activity_bitmaps,
    "session_conversion": _windowed(explore.session_conversion),
    "channel_performance": _windowed(acquisition.channel_performance),
    "top_sources": _windowed(acquisition.top_sources),
    "top_sources_best5": _windowed(acquisition.top_sources, n=5),
    "top_sources_min860": _windowed(acquisition.top_sources, min_sessions=860),
    "new_vs_returning": _windowed(acquisition.new_vs_returning),
    "funnel_overall": _windowed(funnel.funnel_overall),
    "funnel_by_channel": _windowed(funnel.funnel_by_channel),
    "funnel_by_device": _windowed(funnel.funnel_by_device),
    "retention_cohorts": _windowed(retention.retention_cohorts),
    "retention_cohorts_min100": _windowed(retention.retention_cohorts, min_cohort=100),
    "purchase_cohorts": _windowed(retention.purchase_cohorts),
    "purchase_cohorts_min250": _windowed(retention.purchase_cohorts, min_cohort=250),
    "weekly_growth": _windowed(playbook.weekly_growth),
    "ltv_by_channel": _windowed(playbook.ltv_by_channel),
    "funnel_stage_dropoff": _windowed(playbook.funnel_stage_dropoff, as_of=FIXTURE_AS_OF),
    "user_value_rollup": user_value_rollup,
}
