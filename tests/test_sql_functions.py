"""The SQL functions equal their DataFrame counterparts on the derived sf0.01 table."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF01
from webevents.functions import (
    channel5,
    channel7,
    event_day,
    event_param,
    funnel_stage,
    week_of,
    weeks_between,
)
from webevents.functions.sql import register_events, register_functions
from webevents.sources.fixtures import fixture_table, nested_event_table


def test_sql_functions_equal_dataframe_columns(spark):
    register_functions(spark)
    events = fixture_table(spark, SF01)
    events.createOrReplaceTempView("fx_events")
    day = event_day("event_date")
    by_df = events.select(
        channel7().alias("c7"),
        channel5().alias("c5"),
        event_param("ga_session_id", "int_value").alias("sid"),
        event_param("page_location", "string_value").alias("page"),
        day.alias("d"),
        week_of(day).alias("w"),
        weeks_between(day, F.lit("2024-01-01").cast("date")).alias("k"),
    )
    by_sql = spark.sql("""
        SELECT channel7(traffic_source.source, traffic_source.medium) AS c7,
               channel5(traffic_source.source, traffic_source.medium) AS c5,
               event_param_int(event_params, 'ga_session_id') AS sid,
               event_param_string(event_params, 'page_location') AS page,
               event_day(event_date) AS d,
               week_of(event_day(event_date)) AS w,
               weeks_between(event_day(event_date), DATE'2024-01-01') AS k
        FROM fx_events""")
    assert by_df.exceptAll(by_sql).count() == 0 and by_sql.exceptAll(by_df).count() == 0
    # inlined: no function call survives into the physical plan
    assert "channel7" not in by_sql._jdf.queryExecution().executedPlan().toString()


def test_sql_funnel_stage_and_view(spark):
    register_functions(spark)
    register_events(spark, nested_event_table(spark, SF01), "20240101", "20240131", name="ev_window")
    counts = spark.createDataFrame(
        [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0)],
        "purchases long, checkouts_started long, cart_adds long, item_views long",
    )
    counts.createOrReplaceTempView("stage_counts")
    via_sql = [r[0] for r in spark.sql(
        "SELECT funnel_stage(purchases, checkouts_started, cart_adds, item_views) FROM stage_counts"
    ).collect()]
    via_df = [r[0] for r in counts.select(funnel_stage()).collect()]
    assert via_sql == via_df
    assert spark.sql("SELECT count(*) FROM ev_window").first()[0] == fixture_table(spark, SF01).count()
