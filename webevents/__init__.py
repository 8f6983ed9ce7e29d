"""webevents: analytics over nested, day-sharded web/e-commerce event data on Spark.

Layers:
  sources    -- event schema, partitioned Parquet reader/writer, test-fixture mapping
  functions  -- column expressions: parameter lookup, channel grouping, weeks, rates
  operators  -- DataFrame operators: sessions, funnels, cohorts, first touch, windows
  plans      -- the sixteen analyses built from them
  streaming  -- incremental maintenance of the daily roll-ups over arriving shards

    import webevents as we
    events = we.read_events(spark, path, "20201101", "20210131")
    we.plans.channel_performance(events).show()
"""

from webevents import functions, operators, plans, sources, streaming
from webevents.functions.sql import register_events, register_functions
from webevents.session import ensure_checkpoint_dir, local_session
from webevents.sources import EVENT_SCHEMA, read_events, write_events

__version__ = "0.1.0"

__all__ = [
    "EVENT_SCHEMA",
    "ensure_checkpoint_dir",
    "functions",
    "local_session",
    "operators",
    "plans",
    "read_events",
    "register_events",
    "register_functions",
    "sources",
    "streaming",
    "write_events",
]
