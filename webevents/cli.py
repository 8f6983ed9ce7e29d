"""Run one analysis over a stored event table.

    python -m webevents channel_performance --events s3://bucket/events \\
        --start 20201101 --end 20210131 --out s3://bucket/reports/channels

Without ``--out`` the first rows are printed. The output is written by Spark
(Parquet, CSV or JSON), so a report is as large as it needs to be.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import functions as F
from pyspark.sql import types as T

from webevents import plans
from webevents.session import local_session
from webevents.sources import read_events

ANALYSES = {name: getattr(plans, name) for name in plans.__all__}


def run(spark, name: str, events_path: str, start: str | None, end: str | None, **params):
    """The DataFrame of analysis ``name`` over the table at ``events_path``."""
    fn = ANALYSES[name]
    accepted = inspect.signature(fn).parameters
    if "day" in accepted:
        day = params.pop("day", None) or start or accepted["day"].default
        events = read_events(spark, events_path, day, day)
        return fn(events, day, **{k: v for k, v in params.items() if k in accepted and v is not None})
    # an omitted bound is the analysis's default, not an open window
    start, end = start or accepted["start"].default, end or accepted["end"].default
    events = read_events(spark, events_path, start, end)
    return fn(events, start, end, **{k: v for k, v in params.items() if k in accepted and v is not None})


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="webevents", description=__doc__.split("\n")[0])
    parser.add_argument("analysis", choices=sorted(ANALYSES))
    parser.add_argument("--events", required=True, help="root of the day-sharded event table")
    parser.add_argument("--start", help="first day shard, YYYYMMDD")
    parser.add_argument("--end", help="last day shard, YYYYMMDD")
    parser.add_argument("--day", help="the day shard of the previews, YYYYMMDD")
    parser.add_argument("--as-of", dest="as_of", help="reference date of funnel_stage_dropoff, YYYY-MM-DD")
    parser.add_argument("--min-sessions", dest="min_sessions", type=int)
    parser.add_argument("--min-cohort", dest="min_cohort", type=int)
    parser.add_argument("--out", help="write the result here instead of printing it")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    parser.add_argument("--show", type=int, default=50, help="rows to print without --out")
    parser.add_argument("--master", help="Spark master for a local run (default: local[BENCH_CPUS or 8])")
    args = parser.parse_args(argv)

    spark = local_session(master=args.master) if args.master or not _active() else _active()
    params = {k: getattr(args, k) for k in ("day", "as_of", "min_sessions", "min_cohort")}
    df = run(spark, args.analysis, args.events, args.start, args.end, **params)
    if args.out:
        if args.format == "csv":
            # CSV holds no arrays or structs: such columns are written as JSON text
            df = df.select(*[
                F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
                else F.col(f.name)
                for f in df.schema.fields
            ])
        writer = df.write.mode("overwrite")
        if args.format == "csv":
            writer = writer.option("header", "true")
        writer.format(args.format).save(args.out)
    else:
        df.show(args.show, truncate=False)


def _active():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


if __name__ == "__main__":
    main()
