"""Narrow the event table to a window of day shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webevents.sources.schema import SUFFIX_COLUMN


def date_window(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Inclusive string range on ``table_suffix`` ('YYYYMMDD'); either end may be open."""
    suffix = F.col(SUFFIX_COLUMN)
    if start is not None and end is not None:
        return events.filter(suffix.between(F.lit(start), F.lit(end)))
    if start is not None:
        return events.filter(suffix >= F.lit(start))
    if end is not None:
        return events.filter(suffix <= F.lit(end))
    return events


def single_day(events: DataFrame, day: str) -> DataFrame:
    """Equality on one shard suffix."""
    return events.filter(F.col(SUFFIX_COLUMN) == F.lit(day))
