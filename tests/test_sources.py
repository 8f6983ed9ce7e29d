"""The day-sharded writer and reader."""

from __future__ import annotations

import glob
import os
import re

import pyarrow.parquet as pq

from conftest import SF001
from webevents.operators import date_window, single_day
from webevents.sources import SUFFIX_COLUMN, read_events, write_events
from webevents.sources.fixtures import (
    DEVICE_CATEGORIES,
    FIXTURE_END,
    FIXTURE_START,
    MEDIUM_BY_MI,
    fixture_events,
    fixture_table,
    nested_event_table,
)


def test_writer_makes_time_sorted_day_shards(spark, tmp_path):
    events = fixture_table(spark, SF001)
    path = str(tmp_path / "events")
    write_events(events, path)
    days = sorted(os.listdir(path))
    assert all(d.startswith(f"{SUFFIX_COLUMN}=") for d in days if not d.startswith(("_", ".")))
    for day in [d for d in days if d.startswith(SUFFIX_COLUMN)]:
        files = glob.glob(os.path.join(path, day, "*.parquet"))
        assert 1 <= len(files) <= 8  # a handful of files per day, not one per task
        for f in files:
            ts = pq.read_table(f, columns=["event_timestamp"]).column(0).to_pylist()
            assert ts == sorted(ts)  # time order inside each file
    assert read_events(spark, path).count() == events.count()


def test_open_ended_windows(spark):
    events = fixture_table(spark, SF001)
    total = events.count()
    first = events.filter(f"{SUFFIX_COLUMN} <= '20240110'").count()
    assert date_window(events, None, "20240110").count() == first
    assert date_window(events, "20240111", None).count() == total - first
    assert date_window(events, None, None).count() == total
    assert single_day(events, "20240103").count() == events.filter(f"{SUFFIX_COLUMN} = '20240103'").count()
    path = nested_event_table(spark, SF001)
    assert read_events(spark, path, None, "20240110").count() == first
    assert read_events(spark, path, "20240111").count() == total - first


def test_the_derivation_is_code_that_the_jvm_compiles(spark):
    # a generated method of more than 8,000 bytes is interpreted, which took most of the derivation's time
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the generated code is known before a run
    try:
        for window in ((None, None), (FIXTURE_START, FIXTURE_END)):
            rows = fixture_events(spark, SF001, *window).hint("rebalance", SUFFIX_COLUMN).sortWithinPartitions(SUFFIX_COLUMN)
            code = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert sizes and max(sizes) < 6000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_parameters_and_labels_by_position(spark):
    rows = fixture_events(spark, SF001).select("event_name", "event_params", "traffic_source", "device", "ecommerce").collect()
    keys = {tuple(p["key"] for p in r["event_params"]) for r in rows}
    order = ["ga_session_id", "session_engaged", "page_location", "engagement_time_msec", "medium"]
    assert () in keys and any(k[:2] == ("ga_session_id",) * 2 for k in keys)
    assert all([order.index(x) for x in k] == sorted(order.index(x) for x in k) for k in keys)
    assert {r["traffic_source"]["medium"] for r in rows} == set(MEDIUM_BY_MI)
    assert {r["device"]["category"] for r in rows} == set(DEVICE_CATEGORIES)
