"""Event table schema, Parquet reader/writer and the test-fixture mapping."""

from webevents.sources.events import read_events, write_events
from webevents.sources.fixtures import fixture_events
from webevents.sources.schema import EVENT_SCHEMA, SUFFIX_COLUMN

__all__ = ["EVENT_SCHEMA", "SUFFIX_COLUMN", "fixture_events", "read_events", "write_events"]
