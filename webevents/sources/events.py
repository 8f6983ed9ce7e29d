"""Read and write the day-sharded event table.

Layout: Parquet under one directory, partitioned by ``table_suffix=YYYYMMDD`` -- the
Spark form of a wildcard over daily shards. Reading always passes the explicit
schema, so the suffix stays a string and a window on it is a partition filter that
prunes whole directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webevents.sources.schema import EVENT_SCHEMA, SUFFIX_COLUMN


def read_events(
    spark: SparkSession,
    path: str | list[str],
    start: str | None = None,
    end: str | None = None,
    base: str | None = None,
) -> DataFrame:
    """Event table at ``path``, optionally narrowed to suffixes ``start..end``.

    A table of several folders of day shards (batches) names them all, and the folder
    ``base`` above them."""
    reader = spark.read.schema(EVENT_SCHEMA)
    if base is not None:
        reader = reader.option("basePath", base)
    events = reader.parquet(*([path] if isinstance(path, str) else path)).select(*EVENT_SCHEMA.names)
    if start is not None:
        events = events.filter(F.col(SUFFIX_COLUMN) >= F.lit(start))
    if end is not None:
        events = events.filter(F.col(SUFFIX_COLUMN) <= F.lit(end))
    return events


def write_events(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write events as day shards under ``path`` (shared storage on a cluster).

    Rows are rebalanced on the day (``rebalance`` hint): hash-partitioned by suffix, with
    adaptive execution splitting any partition larger than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` -- a day holding a large share of
    all events is cut into several similar-sized tasks -- and merging small ones, so each
    day lands in few files. Unlike a range partitioning it needs no sampling pass over
    the input. Inside each task rows are sorted by time, so row groups carry tight
    ``event_timestamp`` statistics (and the writer's per-day ordering is already met).
    """
    (
        events.hint("rebalance", SUFFIX_COLUMN)
        .sortWithinPartitions(SUFFIX_COLUMN, "event_timestamp")
        .write.mode(mode)
        .partitionBy(SUFFIX_COLUMN)
        .parquet(path)
    )
