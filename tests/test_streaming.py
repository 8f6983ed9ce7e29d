"""The incremental daily roll-up equals the batch analysis after every arrival."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF001
from tools.check import digest
from webevents.plans import daily_activity
from webevents.sources import SUFFIX_COLUMN, read_events, write_events
from webevents.sources.fixtures import fixture_table
from webevents.streaming import start_daily_refresh


def _rows(df, cols):
    return digest(cols, [tuple(r[c] for c in cols) for r in df.collect()])[0]


def test_daily_refresh_tracks_arriving_shards(spark, tmp_path):
    source, out, ckpt = str(tmp_path / "events"), str(tmp_path / "daily"), str(tmp_path / "ckpt")
    events = fixture_table(spark, SF001)
    suffix = F.col(SUFFIX_COLUMN)
    cols = ["date", "total_events", "daily_active_users", "sessions", "purchases"]

    # first arrival: three days; then the rest of the month plus more rows of a day
    # that was already processed (a day that arrives in two pieces)
    first = events.filter(suffix <= "20240103")
    late = events.filter(suffix > "20240103")
    write_events(first.filter(F.col("event_timestamp") % 2 == 0), source, mode="append")
    start_daily_refresh(spark, source, out, checkpoint_location=ckpt).awaitTermination()
    got = spark.read.parquet(out).select(*cols)
    want = daily_activity(read_events(spark, source), "20240101", "20240131").select(*cols)
    assert got.count() == 3 and _rows(got, cols) == _rows(want, cols)

    write_events(first.filter(F.col("event_timestamp") % 2 == 1).unionByName(late), source, mode="append")
    start_daily_refresh(spark, source, out, checkpoint_location=ckpt).awaitTermination()
    got = spark.read.parquet(out).select(*cols)
    want = daily_activity(events, "20240101", "20240131").select(*cols)
    assert got.count() == want.count() == 23
    assert _rows(got, cols) == _rows(want, cols)


def test_an_event_dated_another_day_counts_in_its_shard(spark, tmp_path):
    source, out, ckpt = str(tmp_path / "events"), str(tmp_path / "daily"), str(tmp_path / "ckpt")
    events = fixture_table(spark, SF001)
    first = events.filter(f"{SUFFIX_COLUMN} = '20240102'")
    stray = events.filter(f"{SUFFIX_COLUMN} = '20240103'").withColumn("event_date", F.lit("20240102"))
    for arrival in (first, stray):
        write_events(arrival, source, mode="append")
        start_daily_refresh(spark, source, out, checkpoint_location=ckpt).awaitTermination()
    got = {str(r["date"]): r["total_events"] for r in spark.read.parquet(out).collect()}
    assert got == {"2024-01-02": first.count(), "2024-01-03": stray.count()}
