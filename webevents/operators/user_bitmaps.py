"""Exact distinct users by bitmaps that merge over days.

COUNT(DISTINCT user) over a window reads every event of the window. Here each user has a number
that never changes, and each day holds, per event name and block of 32,768 numbers, a bitmap of
the users seen and the number of events. A window's distinct users are the bits of its days' bitmaps
put together, so it costs its days' bitmaps, not its events, and a day that changes is written again alone.

Numbers are dense, so a bitmap's 4 KB are shared by as many users as the day has of its block. One writer at a time
gives numbers (a scheduled job, or the daily stream, whose batches follow one another); readers
need no numbers at all.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webevents.functions.dates import event_day
from webevents.operators.window import date_window
from webevents.sources.schema import SUFFIX_COLUMN

USER = "user_pseudo_id"
NUMBERS = "user string, number long"
BITMAPS = "event_date string, event_name string, block long, events long, users binary, table_suffix string"


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """(user, number) given so far, 1 and up; none before the first call of ``number_users``."""
    try:
        return spark.read.schema(NUMBERS).parquet(f"{path}/given")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], NUMBERS)


def number_users(events: DataFrame, path: str, user: str = USER) -> DataFrame:
    """Give every user of ``events`` that has none a number, append these below ``path`` and return all.

    New users are stored in ranges; a range's users are numbered among themselves after all users of the ranges
    before it, so no task sees more than one range."""
    spark = events.sparkSession
    known = read_numbers(spark, path)
    users = events.where(F.col(user).isNotNull()).select(F.col(user).alias("user")).distinct()
    new = users.join(known, "user", "left_anti")
    staged = f"{path}/new/{uuid.uuid4().hex}"
    new.repartitionByRange("user").withColumn("_range", F.spark_partition_id()).write.parquet(staged)
    new = spark.read.schema("user string, _range int").parquet(staged)
    last = known.agg(F.max("number")).first()[0] or 0
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = new.groupBy("_range").agg(F.count("*").alias("n")).select(
        F.col("_range").alias("_of"), (F.coalesce(F.sum("n").over(before), F.lit(0)) + last).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("user"))
    numbered = new.withColumn("_n", inside).join(starts, F.col("_range") == F.col("_of"))
    numbered.select("user", (F.col("_start") + F.col("_n")).alias("number")).write.mode("append").parquet(f"{path}/given")
    return read_numbers(spark, path)


def day_bitmaps(events: DataFrame, numbers: DataFrame, user: str = USER) -> DataFrame:
    """``BITMAPS`` rows: per shard, event date and name, a row per block of users with their events and bitmap, and one
    without a block for events without a user.

    Events are first combined per (day, name, user), so a user with a third of them is a row per day and
    name when it meets its number and its bitmap."""
    key = [SUFFIX_COLUMN, "event_date", "event_name"]
    per_user = events.groupBy(*key, F.col(user).alias("user")).agg(F.count(F.lit(1)).alias("events"))
    numbered = per_user.join(numbers, "user", "left")
    lost = F.col("user").isNotNull() & F.col("number").isNull()
    number = F.when(lost, F.raise_error(F.lit("a user has no number; call number_users first")).cast("long")).otherwise(F.col("number"))
    return (
        numbered.withColumn("number", number)
        .groupBy(*key, F.bitmap_bucket_number("number").alias("block"))
        .agg(F.sum("events").alias("events"), F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))
        .select("event_date", "event_name", "block", "events", "users", SUFFIX_COLUMN)
    )


def write_bitmaps(bitmaps: DataFrame, path: str, mode: str = "overwrite") -> None:
    bitmaps.write.mode(mode).partitionBy(SUFFIX_COLUMN).parquet(path)


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BITMAPS).parquet(path)


def inventory_of_bitmaps(bitmaps: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """A3 from day bitmaps: per event name -- events, distinct users, first and last date."""
    day = event_day("event_date")
    blocks = (
        date_window(bitmaps, start, end)
        .groupBy("event_name", "block")
        .agg(
            F.sum("events").alias("events"), F.bitmap_or_agg("users").alias("users"),
            F.min(day).alias("first_seen"), F.max(day).alias("last_seen"),
        )
    )
    return (
        blocks.groupBy("event_name")
        .agg(
            F.sum("events").alias("event_count"), F.sum(F.bitmap_count("users")).alias("unique_users"),
            F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        )
        .orderBy(F.desc("event_count"), F.asc_nulls_first("event_name"))
    )


def activity_of_bitmaps(bitmaps: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """A4 from day bitmaps: per date -- events, active users, session_start events, purchase events."""
    def of(name: str):
        return F.sum(F.when(F.col("event_name") == name, F.col("events")).otherwise(0))

    blocks = (
        date_window(bitmaps, start, end)
        .groupBy("event_date", "block")
        .agg(
            F.sum("events").alias("events"), F.bitmap_or_agg("users").alias("users"),
            of("session_start").alias("sessions"), of("purchase").alias("purchases"),
        )
    )
    return (
        blocks.groupBy(event_day("event_date").alias("date"))
        .agg(
            F.sum("events").alias("total_events"), F.sum(F.bitmap_count("users")).alias("daily_active_users"),
            F.sum("sessions").alias("sessions"), F.sum("purchases").alias("purchases"),
        )
        .orderBy("date")
    )
