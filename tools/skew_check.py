"""Measure shuffle balance when one user holds a third of all events.

Usage: python tools/skew_check.py [sf_dir]

Derives a skewed copy of the nested table (every third event, by hash, re-assigned to
one user; then the same third with a NULL user, then from one traffic source), runs
every analysis on it with Spark's event log written to a fresh scratch
folder, and reads the per-task shuffle records back from that log. Partition
coalescing is off so the raw hash distribution is visible. For contrast it also runs a
plain ``repartition(user)`` of the events, which has no map-side aggregation.

The geo join of the derivation has its own test with the same kind of user
(``tests/test_skew.py``): sort-merge with the hot user split, none of its tasks above 15 %.

The same is done for the day-sharded writer with one day holding a third of all events:
``write_events`` (rebalance on the day, with a small advisory partition size so that
splitting happens at this scale) against a plain hash repartition on the day.

Prints one JSON object: per analysis, the worst shuffle stage's largest task share of
the stage's records and its max/mean ratio.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from webevents import plans  # noqa: E402
from webevents.sources import read_events, write_events  # noqa: E402
from webevents.sources.fixtures import fixture_table  # noqa: E402
from webevents.session import local_session  # noqa: E402

S, E, DAY, AS_OF = "20240101", "20240131", "20240103", "2024-02-01"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir)
    spark = local_session(
        app_name="webevents-skew",
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    base = fixture_table(spark, sf_dir)
    hot = F.pmod(F.xxhash64("event_timestamp", "user_pseudo_id", "event_name"), F.lit(3)) == 0
    skewed = base.withColumn("user_pseudo_id", F.when(hot, F.lit("hot-user")).otherwise(F.col("user_pseudo_id")))
    path = os.path.join(scratch, "events")
    write_events(skewed, path)
    events = read_events(spark, path)
    share = events.select(F.avg((F.col("user_pseudo_id") == "hot-user").cast("double"))).first()[0]

    runs = {
        "event_preview": lambda: plans.event_preview(events, DAY),
        "page_view_params": lambda: plans.page_view_params(events, DAY),
        "event_inventory": lambda: plans.event_inventory(events, S, E),
        "daily_activity": lambda: plans.daily_activity(events, S, E),
        "session_conversion": lambda: plans.session_conversion(events, S, E),
        "channel_performance": lambda: plans.channel_performance(events, S, E),
        "top_sources": lambda: plans.top_sources(events, S, E),
        "new_vs_returning": lambda: plans.new_vs_returning(events, S, E),
        "funnel_overall": lambda: plans.funnel_overall(events, S, E),
        "funnel_by_channel": lambda: plans.funnel_by_channel(events, S, E),
        "funnel_by_device": lambda: plans.funnel_by_device(events, S, E),
        "retention_cohorts": lambda: plans.retention_cohorts(events, S, E),
        "purchase_cohorts": lambda: plans.purchase_cohorts(events, S, E),
        "weekly_growth": lambda: plans.weekly_growth(events, S, E),
        "ltv_by_channel": lambda: plans.ltv_by_channel(events, S, E),
        "funnel_stage_dropoff": lambda: plans.funnel_stage_dropoff(events, S, E, AS_OF),
        "contrast: repartition(user), no map-side aggregation": lambda: events.repartition(
            8, "user_pseudo_id"
        ).groupBy(F.spark_partition_id()).count(),
    }
    for name, make in runs.items():
        spark.sparkContext.setJobDescription(name)
        make().collect()

    # a third of all events without a user id (NULL is a group of its own in GROUP BY)
    nulls = read_events(spark, path).withColumn(
        "user_pseudo_id", F.when(F.col("user_pseudo_id") == "hot-user", F.lit(None).cast("string"))
        .otherwise(F.col("user_pseudo_id"))
    )
    null_runs = {
        "NULL user: funnel_overall": lambda: plans.funnel_overall(nulls, S, E),
        "NULL user: retention_cohorts": lambda: plans.retention_cohorts(nulls, S, E),
        "NULL user: ltv_by_channel": lambda: plans.ltv_by_channel(nulls, S, E),
        "NULL user: funnel_stage_dropoff": lambda: plans.funnel_stage_dropoff(nulls, S, E, AS_OF),
        "NULL user: weekly_growth": lambda: plans.weekly_growth(nulls, S, E),
        "NULL user: channel_performance": lambda: plans.channel_performance(nulls, S, E),
    }
    for name, make in null_runs.items():
        spark.sparkContext.setJobDescription(name)
        make().collect()

    # a third of all events from one traffic source / medium
    hot_src = base.withColumn(
        "traffic_source",
        F.when(
            hot,
            F.col("traffic_source").withField("source", F.lit("hot-src")).withField("medium", F.lit("cpc")),
        ).otherwise(F.col("traffic_source")),
    )
    src_runs = {
        "hot source: top_sources": lambda: plans.top_sources(hot_src, S, E),
        "hot source: channel_performance": lambda: plans.channel_performance(hot_src, S, E),
        "hot source: funnel_by_channel": lambda: plans.funnel_by_channel(hot_src, S, E),
        "hot source: new_vs_returning": lambda: plans.new_vs_returning(hot_src, S, E),
    }
    for name, make in src_runs.items():
        spark.sparkContext.setJobDescription(name)
        make().collect()

    # the writer: a third of all events moved onto one day
    hot_day = F.pmod(F.xxhash64("event_timestamp", "user_pseudo_id"), F.lit(3)) == 0
    crowded = base.withColumn(
        "table_suffix", F.when(hot_day, F.lit(DAY)).otherwise(F.col("table_suffix"))
    ).withColumn("event_date", F.col("table_suffix"))
    # the rebalance splits partitions above the advisory size; lower it so that a
    # 100k-event test behaves like a large table does at the default size
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.sparkContext.setJobDescription("write_events with a hot day (rebalance on day)")
    write_events(crowded, os.path.join(scratch, "crowded"))
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.sparkContext.setJobDescription("contrast: write after repartition(day)")
    crowded.repartition(8, "table_suffix").write.partitionBy("table_suffix").parquet(
        os.path.join(scratch, "crowded-hash")
    )
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_job, job_name = {}, {}
    records = defaultdict(list)
    logs = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for log in sorted(logs):
        if "appstatus" in os.path.basename(log):
            continue
        with open(log) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    name = (ev.get("Properties") or {}).get("spark.job.description")
                    job_name[ev["Job ID"]] = name
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    metrics = ev.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    records[ev["Stage ID"]].append(read)

    worst: dict[str, dict] = {}
    for sid, per_task in records.items():
        total = sum(per_task)
        name = job_name.get(stage_job.get(sid))
        if not name or total < 100 or len(per_task) < 2:
            continue
        top = max(per_task)
        entry = {
            "stage_records": total,
            "max_task_share": round(top / total, 3),
            "max_over_mean": round(top / (total / len(per_task)), 2),
            "tasks": len(per_task),
        }
        if name not in worst or entry["max_over_mean"] > worst[name]["max_over_mean"]:
            worst[name] = entry
    print(json.dumps({"hot_user_share_of_events": round(share, 3), "sf_dir": sf_dir, "worst_stage": worst}))


if __name__ == "__main__":
    main()
