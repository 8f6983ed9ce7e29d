"""The column building blocks as Spark SQL functions, for users who write SQL.

``register_functions(spark)`` creates temporary SQL functions (``CREATE TEMPORARY
FUNCTION ... RETURN <expression>``). They are SQL expressions, not Python: the
analyzer inlines them into the plan, so they run in generated code like the
DataFrame versions in this package (and are tested equal to them).

    register_functions(spark)
    register_events(spark, "s3://bucket/events", "20201101", "20210131")
    spark.sql(\"\"\"
        SELECT channel5(traffic_source.source, traffic_source.medium) AS channel,
               count(DISTINCT user_pseudo_id) AS users
        FROM events
        WHERE event_param_int(event_params, 'ga_session_id') IS NOT NULL
        GROUP BY 1\"\"\")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webevents.functions import channels as ch
from webevents.functions import stages as st
from webevents.sources.events import read_events

PARAMS_TYPE = "ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING, int_value: BIGINT>>>"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _channel_sql(with_email_social: bool) -> str:
    media = ", ".join(_q(m) for m in ch.REFERRAL_MEDIA)
    arms = [
        f"WHEN medium = {_q(ch.ORGANIC_MEDIUM)} THEN {_q(ch.ORGANIC_SEARCH)}",
        f"WHEN medium = {_q(ch.PAID_MEDIUM)} THEN {_q(ch.PAID_SEARCH)}",
        f"WHEN medium IN ({media}) THEN {_q(ch.REFERRAL)}",
    ]
    if with_email_social:
        arms += [
            f"WHEN medium = {_q(ch.EMAIL_MEDIUM)} THEN {_q(ch.EMAIL)}",
            f"WHEN medium = {_q(ch.SOCIAL_MEDIUM)} THEN {_q(ch.SOCIAL)}",
        ]
    arms.append(f"WHEN source = {_q(ch.DIRECT_SOURCE)} OR medium = {_q(ch.NONE_MEDIUM)} THEN {_q(ch.DIRECT)}")
    return "CASE " + " ".join(arms) + f" ELSE {_q(ch.OTHER)} END"


def _definitions() -> dict[str, str]:
    lookup = "get(params.value.{slot}, array_position(params.key, k) - 1)"
    stage = (
        f"CASE WHEN purchases > 0 THEN {_q(st.STAGE_CONVERTED)} "
        f"WHEN checkouts_started > 0 THEN {_q(st.STAGE_CHECKOUT)} "
        f"WHEN cart_adds > 0 THEN {_q(st.STAGE_CART)} "
        f"WHEN item_views > 0 THEN {_q(st.STAGE_BROWSE)} "
        f"ELSE {_q(st.STAGE_BOUNCED)} END"
    )
    sunday = "date_sub({d}, dayofweek({d}) - 1)"
    return {
        "event_param_int": f"(params {PARAMS_TYPE}, k STRING) RETURNS BIGINT "
        f"RETURN {lookup.format(slot='int_value')}",
        "event_param_string": f"(params {PARAMS_TYPE}, k STRING) RETURNS STRING "
        f"RETURN {lookup.format(slot='string_value')}",
        "channel7": f"(source STRING, medium STRING) RETURNS STRING RETURN {_channel_sql(True)}",
        "channel5": f"(source STRING, medium STRING) RETURNS STRING RETURN {_channel_sql(False)}",
        "event_day": "(s STRING) RETURNS DATE RETURN to_date(s, 'yyyyMMdd')",
        "week_of": "(d DATE) RETURNS DATE RETURN trunc(d, 'week')",
        "weeks_between": "(later DATE, earlier DATE) RETURNS BIGINT RETURN "
        f"CAST(datediff({sunday.format(d='later')}, {sunday.format(d='earlier')}) / 7 AS BIGINT)",
        "funnel_stage": "(purchases BIGINT, checkouts_started BIGINT, cart_adds BIGINT, "
        f"item_views BIGINT) RETURNS STRING RETURN {stage}",
    }


def register_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in ``spark``; returns their names."""
    for name, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(_definitions())


def register_events(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, name: str = "events"
) -> DataFrame:
    """A temporary view over the day-sharded event table (partition-pruned window)."""
    events = read_events(spark, path, start, end)
    events.createOrReplaceTempView(name)
    return events
