"""Day bitmaps of numbered users equal the distinct counts over events, for any window and after refreshes."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF01
from eventrows import event, events_df
from webevents import plans
from webevents.operators.user_bitmaps import (
    activity_of_bitmaps,
    day_bitmaps,
    inventory_of_bitmaps,
    number_users,
    read_bitmaps,
    read_numbers,
    write_bitmaps,
)
from webevents.sources import write_events
from webevents.sources.fixtures import fixture_table
from webevents.streaming.daily import start_daily_refresh, user_bitmaps_by_day


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_windows_equal_distinct_counts(spark, tmp_path):
    events = fixture_table(spark, SF01, "20240101", "20240131")
    write_bitmaps(day_bitmaps(events, number_users(events, f"{tmp_path}/numbers")), f"{tmp_path}/days")
    bitmaps = read_bitmaps(spark, f"{tmp_path}/days")
    for start, end in (("20240101", "20240131"), ("20240105", "20240111"), ("20240103", "20240103"), ("20250101", "20250102")):
        assert rows(inventory_of_bitmaps(bitmaps, start, end)) == rows(plans.event_inventory(events, start, end))
        assert rows(activity_of_bitmaps(bitmaps, start, end)) == rows(plans.daily_activity(events, start, end))


def test_numbers_are_dense_and_never_change(spark, tmp_path):
    def users(*names):
        return spark.createDataFrame([(n,) for n in names], "user_pseudo_id string").repartition(3)

    assert read_numbers(spark, f"{tmp_path}/n").collect() == []
    first = dict(rows(number_users(users("b", "a", None, "b", "z"), f"{tmp_path}/n")))
    assert sorted(first) == ["a", "b", "z"] and sorted(first.values()) == [1, 2, 3]
    again = dict(rows(number_users(users("a", "z"), f"{tmp_path}/n")))
    more = dict(rows(number_users(users("m", "a", "c"), f"{tmp_path}/n")))
    assert again == first and {k: more[k] for k in first} == first and sorted(more.values()) == [1, 2, 3, 4, 5]


def test_blocks_null_users_and_users_without_a_number(spark, tmp_path):
    # users of two blocks, a hot user and events without one
    many = spark.range(40_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_pseudo_id"))
    base = events_df(spark, [event(name="view_item", user="x", date="20240102")]).drop("user_pseudo_id")
    hot = spark.createDataFrame([("hot",)] * 500 + [(None,)] * 7, "user_pseudo_id string")
    events = base.crossJoin(many.unionByName(hot)).select(events_df(spark, []).columns)
    numbers = number_users(events, f"{tmp_path}/n")
    bitmaps = day_bitmaps(events, numbers)
    assert {r["block"] for r in bitmaps.select("block").collect()} == {None, 1, 2}
    assert rows(inventory_of_bitmaps(bitmaps, None, None))[0][1:3] == (40_507, 40_001)
    with pytest.raises(PySparkException):
        day_bitmaps(events, numbers.where("number > 1")).collect()


def test_the_daily_refresh_keeps_bitmaps(spark, tmp_path):
    source, out = f"{tmp_path}/events", f"{tmp_path}/bitmaps"
    events = fixture_table(spark, SF01, "20240101", "20240131")
    refresh = user_bitmaps_by_day(f"{tmp_path}/numbers")
    for start, end in (("20240101", "20240104"), ("20240104", "20240106")):  # one day gets more events
        part = events.where(F.col("table_suffix").between(start, end))
        write_events(part, source, mode="append")
        start_daily_refresh(spark, source, out, refresh, checkpoint_location=f"{tmp_path}/state").awaitTermination()
    table = spark.read.schema(events.schema).parquet(source)
    bitmaps = read_bitmaps(spark, out)
    assert rows(inventory_of_bitmaps(bitmaps, "20240102", "20240106")) == rows(plans.event_inventory(table, "20240102", "20240106"))
    assert rows(activity_of_bitmaps(bitmaps, "20240101", "20240106")) == rows(plans.daily_activity(table, "20240101", "20240106"))
