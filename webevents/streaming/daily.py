"""Keep the per-day roll-up (A4, daily activity) current as day shards arrive.

The event table only ever grows by whole or partial day shards. A file stream over
the shard directory notices new files; each micro-batch only says *which days*
changed. Those days are then recomputed exactly from the table -- a semi-join on the
changed suffixes, which dynamic partition pruning turns into a read of just those
shards -- and written over the same day partitions of the output (dynamic partition
overwrite). Distinct-user counts therefore stay exact even when a day arrives in
several pieces, a rerun of a batch after a failure rewrites the same rows, and the
stream's checkpoint (in the shared checkpoint folder) records which files were done.

The roll-up is keyed by the shard (``table_suffix``), as the output's partitions are. An
event whose date is not its shard's day counts in its shard, so recomputing one shard
never touches what another one holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webevents.operators.user_bitmaps import day_bitmaps, number_users
from webevents.plans.explore import daily_activity
from webevents.session import ensure_checkpoint_dir
from webevents.sources.events import read_events
from webevents.sources.schema import EVENT_SCHEMA, SUFFIX_COLUMN

DayAnalysis = Callable[[DataFrame], DataFrame]


def daily_activity_by_day(events: DataFrame) -> DataFrame:
    """A4 per shard of ``events``: ``date`` is the shard's day."""
    by_shard = events.withColumn("event_date", F.col(SUFFIX_COLUMN))
    return daily_activity(by_shard, "00000000", "99999999").withColumn(
        SUFFIX_COLUMN, F.date_format("date", "yyyyMMdd")
    )


def user_bitmaps_by_day(numbers_path: str) -> DayAnalysis:
    """A refresh that keeps day bitmaps of users: new users of the changed days get their numbers first, below
    ``numbers_path``. Its output is read with ``read_bitmaps`` and answers A3 and A4 for any window of days."""

    def analysis(events: DataFrame) -> DataFrame:
        return day_bitmaps(events, number_users(events, numbers_path))

    return analysis


def refresh_days(
    spark: SparkSession,
    events_path: str,
    out_path: str,
    changed: DataFrame,
    analysis: DayAnalysis = daily_activity_by_day,
) -> None:
    """Recompute ``analysis`` for the suffixes listed in ``changed`` and overwrite
    exactly those day partitions of ``out_path``."""
    days = changed.select(SUFFIX_COLUMN).distinct()
    table = read_events(spark, events_path).join(days, SUFFIX_COLUMN, "left_semi")
    (
        analysis(table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SUFFIX_COLUMN)
        .parquet(out_path)
    )


def start_daily_refresh(
    spark: SparkSession,
    events_path: str,
    out_path: str,
    analysis: DayAnalysis = daily_activity_by_day,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops (the
    scheduled-job mode); otherwise it keeps watching for new shards."""
    if checkpoint_location is None:
        # one stream state per (source, output) pair
        pair = hashlib.sha1(f"{events_path}|{out_path}".encode()).hexdigest()[:16]
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/webevents-daily-refresh/{pair}"
    location = checkpoint_location
    stream = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(events_path)
        .select(SUFFIX_COLUMN)
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        refresh_days(batch.sparkSession, events_path, out_path, batch, analysis)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
